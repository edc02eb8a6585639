import random
from collections import defaultdict

import pytest

from mercato.llm import mixing

from .util import docs, edge_rows, prose, words


def fill(sizes, weights=(5, 2, 1), cap=3):
    """Water-filling by repeated resharing."""
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def make_rows():
    rng = random.Random(1)
    return [(i, prose(rng, rng.randint(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", "Z", None, "é"]))
            for i in range(400)] + [(r[0], r[1], "en", "edge") for r in edge_rows() if r[1] is None or len(r[1]) < 2000]


def test_targets_and_taken(spark):
    rows = make_rows()
    out = mixing.mix(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = fill(sizes)
    for r in out:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
    assert sum(taken.values()) <= sum(sizes.values())
    longest = max(len(words(r[1])) for r in rows)
    assert all(abs(taken[s] - want[s]) <= longest for s in sizes)


def test_rerun_and_partitioning_agree(spark):
    d = docs(spark, make_rows())
    a = sorted((tuple(r) for r in mixing.mix(d).collect()), key=repr)
    b = sorted((tuple(r) for r in mixing.mix(d.repartition(7, "text")).collect()), key=repr)
    assert a == b


def test_finer_ranges_give_the_same_mix(spark, monkeypatch):
    d = docs(spark, make_rows())
    a = sorted((tuple(r) for r in mixing.mix(d).collect()), key=repr)
    monkeypatch.setattr(mixing, "ROWS_PER_TASK", 5)
    assert sorted((tuple(r) for r in mixing.mix(d).collect()), key=repr) == a


def test_mixed_rows_repeat_documents(spark):
    d = docs(spark, make_rows())
    out = mixing.mixed_rows(d)
    assert out.columns == [*d.columns, "mix_epoch"]
    got = sum(len(words(r.text)) for r in out.collect())
    assert got == mixing.mix(d).agg({"taken": "sum"}).first()[0]


def test_empty_and_wordless(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    out = mixing.mix(docs(spark, [(1, None), (2, " ")])).collect()
    assert [(r.size, r.copies, r.taken) for r in out] == [(0, 0, 0)] * 2
    assert mixing.mixed_rows(docs(spark, [(1, None)])).count() == 0
