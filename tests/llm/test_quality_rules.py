import random
import re
from collections import Counter

import numpy as np
import zstandard

from mercato.llm import quality_rules

from .util import docs, edge_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def more_rows():
    rng = random.Random(7)
    line = prose(rng, 9)
    return [(20, "\n".join([line, "", line, " ", " ", line + " ", line])), (21, "a\r\na\r\na\n"), (22, "\n\n"), (23, "é|é é|é é|é é|é"),
            (24, "x y z x y z"), (25, "a b a b a"), (26, "# $ <b> &amp; 100% | *" * 3), (27, (prose(rng, 60) + "\n") * 2),
            (28, prose(rng, 200) + "\n" + line + "\nend\n" + line), (29, "x y"), (30, "z x y z x y")]


def random_rows(n=150):
    rng = random.Random(8)
    return [(100 + i, "".join(rng.choice(["a", "b", "é", " ", "\n", "\t", "#"]) for _ in range(rng.randrange(200)))) for i in range(n)]


def judged(spark, rows, **options):
    return {r.doc_id: r for r in quality_rules.judge(docs(spark, rows), **options).collect()}


def test_counts_match_brute_force(spark):
    rows = edge_rows() + more_rows() + random_rows()
    got = quality_rules.judge(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    base = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted([(str(r.doc_id), *base(r)) for r in got]) == sorted([(str(i), *brute(t)) for i, t, *_ in rows])


def test_kept_follows_base_rule_and_bands(spark):
    rng = random.Random(3)
    noise = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=9000))
    rows = [(1, prose(rng, 400, 4000)), (2, "so it goes " * 300), (3, "few words"),
            (4, " ".join(noise[i:i + 40] for i in range(0, 9000, 40))),  # many words, all of them noise
            # half noise, half one sentence again and again, each word with another number
            (5, " ".join(noise[i:i + 40] for i in range(0, 8160, 40)) + "".join(f" it{i} is{i} said{i} times{i}" for i in range(330)))]
    got = judged(spark, rows)
    assert [got[i].kept for i in range(1, 6)] == [True, False, False, False, False]
    assert [got[i].reason for i in range(1, 5)] == [None, "repeats", "short", "incompressible"]
    assert not got[4].base_failed and not got[5].base_failed and got[5].reason == "chunks"


def test_ratios_are_those_of_the_whole_text_and_its_chunks():
    rng = random.Random(5)
    raw = prose(rng, 6000).encode()
    c = zstandard.ZstdCompressor(level=3, write_content_size=False)
    ratio, share, reason = quality_rules.compression(memoryview(raw), c)
    assert ratio == len(raw) / len(c.compress(raw)) and share == 0 and reason is None
    bands = [(0, 0.0, 1e9), (4096, 1e9, 1e9)]  # only whole chunks are outside
    _, share, reason = quality_rules.compression(memoryview(raw), c, bands)
    assert share == (len(raw) // 4096 * 4096) / len(raw) and reason == "incompressible"


def test_limits_go_by_length():
    assert quality_rules.band(10) == (0.0, float("inf"))
    limits = [quality_rules.band(n) for n in (256, 512, 1024, 2048, 4096, 16384, 65536, 10**9)]
    assert limits == sorted(limits)


def test_clean_texts_of_the_tables_stay(spark):
    sf = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id")
    got = quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet")).filter("not base_failed").join(labels, "doc_id").collect()
    assert got and all(r.kept for r in got)


def test_keep_returns_the_rows_as_they_are(spark):
    rows = edge_rows() + more_rows()
    d = docs(spark, rows)
    out = quality_rules.keep(d)
    assert out.schema == d.schema
    want = sorted(str(tuple(r)) for r in d.collect() if judged(spark, [(1, r.text)])[1].kept)
    assert sorted(str(tuple(r)) for r in out.collect()) == want and want


def test_empty_table(spark):
    assert quality_rules.judge(docs(spark, [])).count() == 0
    assert np.all(quality_rules.duplicate_lines(np.zeros(0, np.uint8), np.zeros(3, np.int64)) == 0)
