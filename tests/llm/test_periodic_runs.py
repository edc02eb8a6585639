import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import periodic_runs

from .util import docs, edge_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=12):
    """Every period's maximal stretches; of one stretch the smallest period."""
    n, seen = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                seen.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in seen.items())


def brute(doc_id, text, rewrite=True):
    w = WORD.findall(text or "")
    n = len(w)
    if rewrite and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def check(spark, rows):
    got = periodic_runs.detect(docs(spark, rows), rewrite=True).collect()
    have = sorted((str((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in got))
    assert have == sorted(str(brute(r[0], r[1])) for r in rows)
    return got


def test_edge_rows_match_brute_force(spark):
    check(spark, [r for r in edge_rows() if len(r[1] or "") < 20_000])


def test_planted_periods_match_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        k = rng.choice([1, 2, 3, 30])
        w = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(90))]
        if rng.random() < 0.4 and w:
            p, a = rng.randint(1, max(1, len(w) // 3)), rng.randrange(len(w))
            w[a:] = [w[a + (j - a) % p] for j in range(a, len(w))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    got = check(spark, rows)
    assert sum(r.n_runs > 1 for r in got) > 20


def test_period_in_the_whole_of_a_long_text(spark):
    rng = random.Random(12)
    unit = prose(rng, 3000)
    (r,) = periodic_runs.detect(docs(spark, [(1, " ".join([unit] * 7))])).collect()
    assert (r.n_runs >= 1, r.start, r.length, r.period, r.exponent_milli) == (True, 0, 21000, 3000, 7000)
    (r,) = periodic_runs.detect(docs(spark, [(1, "ha " * 50_000)])).collect()
    assert (r.n_runs, r.start, r.length, r.period, r.n_kept) == (1, 0, 50_000, 1, 1)
    assert r.collapsed_sha256 == hashlib.sha256(b"ha").hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4))
def test_runs_of_random_sequences(texts):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    ids = np.array([x for t in texts for x in t], np.int64)
    for least in (2, 12):
        s, e, p = periodic_runs.runs(ids, first, least)
        assert list(zip(s.tolist(), (e - s).tolist(), p.tolist(), strict=True)) == [
            (a + f, length, q) for t, f in zip(texts, first.tolist(), strict=False) for a, length, q in brute_runs(t, least)]


def test_words_are_compared_by_their_bytes(spark):
    # two words of 1,024 bytes that polynomial hashes modulo 2^64 confuse
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    (r,) = periodic_runs.detect(docs(spark, [(1, " ".join([one, two] * 8))])).collect()
    assert (r.n_runs, r.period) == (1, 2)


def test_empty_table(spark):
    assert periodic_runs.detect(docs(spark, []), rewrite=True).count() == 0
