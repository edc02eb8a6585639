import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from mercato.llm import ranked_search
from mercato.llm.common import text_bytes

from .util import docs, edge_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=10):
    bags = [Counter(terms(r[1])) for r in rows]
    size = [sum(b.values()) for b in bags]
    n_docs, n_terms = sum(s > 0 for s in size), sum(size)
    df = Counter(t for b in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for r, bag, n in zip(rows, bags, size, strict=True):
            s = 0
            for t in terms(text):
                if bag[t]:
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if s > 0:
                scored.append((-s, r[0] is None, r[0] or 0, r[0]))
        out += [(item_id, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, segment string, score string")


def found(spark, rows, items, **options):
    index = ranked_search.build_index(docs(spark, rows).repartition(3), **options)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in
                   ranked_search.search(index, items_of(spark, items)).collect()), key=str)


def test_edge_rows_match_brute_force(spark):
    rows = edge_rows()
    items = [(1, "w1 w2b w3cc été"), (2, None), (3, ""), (4, "nowhere"), (5, rows[6][1]), (5, "ONE one one"), (None, "w7")]
    assert found(spark, rows, items) == brute(rows, items)


def test_many_segments_and_ties_match_brute_force(spark):
    rng = random.Random(2)
    base = [prose(rng, rng.randrange(5, 80), 120) for _ in range(300)]
    rows = [(i, base[rng.randrange(300)] if rng.random() < 0.5 else prose(rng, rng.randrange(1, 60), 120)) for i in range(900)]
    rng.shuffle(rows)
    items = [(k, prose(rng, 12, 160)) for k in range(30)] + [(100, base[0]), (101, base[1] + " " + base[1])]
    for size in (1, 6_000, 10**9):
        if size == 1:
            assert found(spark, rows[:60], items, segment_bytes=size) == brute(rows[:60], items)
        else:
            assert found(spark, rows, items, segment_bytes=size) == brute(rows, items)


def test_item_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, prose(rng, 40, 200)) for i in range(200)]
    items = [(k, prose(rng, 10, 200)) for k in range(20)]
    monkeypatch.setattr(ranked_search, "ITEMS_IN_BLOCK", 3)
    assert found(spark, rows, items) == brute(rows, items)


def _lists(texts, query, n_docs=None):
    """(weighted lists, m) of one segment over ``texts``."""
    seg = ranked_search._Segment()
    data, off = text_bytes(pa.array(texts))
    seg.add(pa.array(range(len(texts))), data, off)
    batches = list(seg.rows(0, pa.int64()))
    size = np.frombuffer(batches[0].column("docs")[0].as_py(), np.int64)
    n_docs, n_terms = int((size > 0).sum()), int(size.sum())
    norm = lambda n: ranked_search.length_norm(n, n_docs, n_terms)
    rows = [r for b in batches[1:] for r in b.to_pylist()]
    out = []
    for r in rows:
        if r["term"] in query:
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
            out.append((w, ranked_search._List(r["base"], r["docs"], r["tf"], r["tf_bytes"], r["corners"], norm)))
    return out, norm(size)


def test_block_maxima_are_exact_and_skip_blocks():
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(20, 200), 60) for _ in range(20_000)]
    for i in range(100, 112):
        texts[i] = "needle thread needle " + texts[i]
    lists, m = _lists(texts, {"needle", "thread", "w1b", "w2cc", "w3ddd"})
    for _, x in lists:
        doc, q = x.unpack(np.arange(len(x.base)), m)
        assert [int(q[i:i + 128].max()) for i in range(0, len(q), 128)] == x.most.tolist()
        assert (np.diff(doc) > 0).all()
        x.unpacked = 0
    acc = np.zeros(len(texts), np.int64)
    d, s = ranked_search.best_of_segment(lists, m, 10, acc)
    assert not acc.any() and set(d.tolist()) <= set(range(100, 112)) and len(d) == 10 and (np.diff(s) <= 0).all()
    common = [x for c, x in lists if len(x.base) > 10]
    assert common and all(x.unpacked <= 2 for x in common)  # of some hundred blocks


def test_a_term_frequency_beyond_16_bits(spark):
    rows = [(1, "x " * 70_000 + "y"), (2, "x y"), (3, "z " * 300)]
    items = [(1, "x y"), (2, "z")]
    assert found(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a b")], []) == []
    assert found(spark, [(1, None), (2, "")], [(1, "a")]) == []
