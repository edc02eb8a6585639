"""Pivot index against all pairs; R27 over gaps, constants and many products alike."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import nearest
from mercato.plans.recommend import vectors


def table(spark, z, codes, ask=None):
    rows = [(f"k{i:05d}", [int(x) for x in z[i]], [int(x) for x in codes[i]], True if ask is None else bool(ask[i]))
            for i in range(len(z))]
    return spark.createDataFrame(rows, "key string, z array<bigint>, codes array<int>, ask boolean")


def brute(z, codes, n):
    size = nearest.sizes(z, codes)
    cos = nearest.cosines(z, codes, size, z, codes, size)
    return [[(int(j), cos[i, j]) for j in np.lexsort((np.arange(len(z)), -cos[i]))[:n]] for i in range(len(z))]


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 20_000, (25, 5))
    z = (middle[rng.integers(0, 25, n)] + rng.normal(0, 1500, (n, 5))).astype(np.int64)
    return z, rng.integers(0, 4, (n, 1)).astype(np.int64)


@pytest.mark.parametrize("block,pivots", [(16, 12), (64, 3), (4096, 24)])
def test_matches_all_pairs(spark, block, pivots):
    z, codes = clustered(700)
    z[100:160], codes[100:160] = z[0], codes[0]  # many alike
    df = nearest.nearest(table(spark, z, codes), "key", 7, block, pivots)
    assert "CartesianProduct" not in df._jdf.queryExecution().toString()
    got = {}
    for r in df.collect():
        got.setdefault(int(r.key[1:]), []).append((int(r.other[1:]), r.cos))
    want = brute(z, codes, 7)
    assert all(sorted(got[i], key=lambda x: (-x[1], x[0])) == want[i] for i in range(len(z)))


def test_only_what_is_asked_and_short_lists(spark):
    z, codes = clustered(40, 1)
    ask = np.arange(40) % 9 == 0
    got = nearest.nearest(table(spark, z, codes, ask), "key", 60, 8, 6).groupBy("key").count().collect()
    assert sorted((int(r.key[1:]), r["count"]) for r in got) == [(i, 40) for i in range(0, 40, 9)]
    assert nearest.nearest(table(spark, z[:0], codes[:0]), "key", 3).count() == 0


def test_far_blocks_are_not_read(spark):
    z, codes = clustered(3000, 2)
    blocks, _ = nearest.build(table(spark, z, codes), "key", 32, 24)
    radius = blocks.select("block", F.lit(0.1).alias("radius"))
    pairs = nearest.near_blocks(blocks, radius)
    n = blocks.count()
    assert 0 < pairs.count() < n * (n - 1) / 4
    # the bound holds: no vector of a block left out is within the radius
    rows = {r.block: nearest._Block(r.asDict()) for r in blocks.collect()}
    near = {(r.block, r.other) for r in pairs.collect()}
    for a in list(rows)[:20]:
        for b in rows:
            if a != b and (a, b) not in near:
                assert nearest.distances(rows[a].asked_against(rows[b])).min() > 0.1


def test_similar_vectors_with_gaps_and_requests(spark):
    rows = [(i, f"c{i % 3}" if i % 7 else None, None if i % 5 == 0 else float(i % 4), 2.0, i % 2, None, 3, 0.5) for i in range(120)]
    rows.append((500, None, None, None, None, None, None, None))
    pf = spark.createDataFrame(rows, "product_id long, product_category_name_english string, avg_price double, avg_freight_value double, "
                                     "total_orders long, avg_review_score double, total_reviews long, positive_sentiment_ratio double")
    vec = {r.product_id: (r.z, r.codes) for r in vectors.product_vectors(pf).collect()}
    ids = sorted(vec)
    z, codes = (np.array([vec[i][k] for i in ids], np.int64) for k in (0, 1))
    size = nearest.sizes(z, codes)
    cos = nearest.cosines(z, codes, size, z, codes, size)
    got = {}
    for r in vectors.similar_vectors(pf, 5, block=8, pivots=4).collect():
        got.setdefault(r.product_id, {})[r["rank"]] = r.similar_product_id
    for a, i in enumerate(ids):
        want = [ids[j] for j in np.lexsort((np.arange(len(ids)), -cos[a])) if j != a][:5]
        assert [got[i][k] for k in range(1, 6)] == want
    some = vectors.similar_vectors(pf, 5, requests=pf.where("product_id IN (3, 500)").select("product_id"), block=8, pivots=4).collect()
    assert {(r.product_id, r["rank"], r.similar_product_id) for r in some} == {(i, k, got[i][k]) for i in (3, 500) for k in got[i]}


def test_one_vector_for_all(spark):
    pf = spark.createDataFrame([(i, "a", 1.0, 1.0, 1, 1.0, 1, 1.0) for i in range(30)],
                               "product_id long, product_category_name_english string, avg_price double, avg_freight_value double, "
                               "total_orders long, avg_review_score double, total_reviews long, positive_sentiment_ratio double")
    got = [r.similar_product_id for r in vectors.similar_vectors(pf, 3).where("product_id = 1").orderBy("rank").collect()]
    assert got == [0, 2, 3]
