import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from mercato.llm import jaccard_join as jj
from mercato.llm.common import components, forest

from .util import docs, edge_rows, prose, shingles


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    post = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            post[x].append(i)
    inter = Counter(p for own in post.values() for p in combinations(own, 2))
    link = defaultdict(set)
    for (a, b), n in inter.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8:
            link[a].add(b)
            link[b].add(a)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, comp = [i], {i}
        while todo:
            for y in link[todo.pop()]:
                if y not in comp:
                    comp.add(y)
                    todo.append(y)
        seen |= comp
        ids = [rows[k][0] for k in comp]
        for k in comp:
            cls = min((x for x in ids if x is not None), default=None)
            out[k] = (rows[k][0], cls, len(link[k]), len(comp))
    return sorted(out, key=repr)


def near_rows():
    rng = random.Random(9)
    rows, i = [], 100
    for _ in range(25):
        base = prose(rng, rng.randint(30, 150)).split()
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(1000)}"
            rows.append((i, " ".join(own)))
            i += 1
    return rows


def test_links_match_brute_force(spark):
    rows = edge_rows() + near_rows()
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in jj.links(docs(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_large_group_in_blocks(spark, monkeypatch):
    rng = random.Random(2)
    base = prose(rng, 200).split()
    rows = []
    for i in range(90):
        own = list(base)
        own[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(jj, "BLOCK", 16)
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in jj.links(docs(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_representatives(spark):
    rows = edge_rows() + near_rows()
    d = docs(spark, rows)
    out = jj.representatives(d)
    assert out.schema == d.schema
    # of every class the smallest id, and every text that links to nothing
    want = {(b[0], b[3]) for b in brute(rows) if b[0] == b[1]}
    assert {r.doc_id for r in out.collect()} == {w[0] for w in want}
    assert jj.representatives(docs(spark, [])).count() == 0


def test_posterior_bound():
    need = jj.least_matches(0.8, 1e-4)
    # numerical posterior of a uniform prior
    s = (np.arange(20000) + 0.5) / 20000
    for n, m in need.items():
        post = lambda k: (w := s ** k * (1 - s) ** (n - k))[s >= 0.8].sum() / w.sum()  # noqa: B023, E731
        assert post(m) >= 1e-4 > post(m - 1)


def test_minhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2 ** 63, 200).astype(np.uint64)])
    sig = jj.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.2


def test_forest_and_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    a, b = (np.array(x) for x in zip(*pairs, strict=True))
    root = forest(60, a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: root[k] for k in set(a[a != b]) | set(b[a != b])}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
