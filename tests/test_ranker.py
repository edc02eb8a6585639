"""Sampling, exact AUC and serving of the ranker on small tables."""

import itertools
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from mercato.operators import roc_auc
from mercato.plans.recommend import hybrid


def test_shuffle_is_a_permutation_of_any_size(spark):
    for size in (1, 2, 3, 7, 16, 101):
        d = spark.range(5).select(F.col("id").alias("u"), F.lit(size).cast("long").alias("n")).withColumn(
            "keys", hybrid.shuffle_keys(F.concat(F.lit("k"), F.col("u").cast("string")), F.col("n")))
        d = d.crossJoin(spark.range(size).select(F.col("id").alias("j"))).select("u", "j", hybrid.shuffled(F.col("j"), F.col("n"), F.col("keys")).alias("x"))
        got = {}
        for r in d.collect():
            got.setdefault(r.u, {})[r.j] = r.x
        assert all(sorted(g.values()) == list(range(size)) for g in got.values())
        if size > 16:
            assert len({tuple(g[j] for j in range(size)) for g in got.values()}) == 5


def test_negatives_draw_any_set_alike(spark):
    users, products, bought = 3000, 30, 2
    pos = spark.range(users).select(F.col("id").alias("customer_unique_id"),
                                    F.explode(F.array(*[(F.col("id") * 7 + k * 11) % products for k in range(bought)])).alias("product_id"))
    cat = spark.range(products).select(F.col("id").alias("product_id"))
    got = {}
    for r in hybrid.negatives(pos, cat).collect():
        got.setdefault(r.customer_unique_id, set()).add(r.product_id)
    own = {}
    for r in pos.collect():
        own.setdefault(r.customer_unique_id, set()).add(r.product_id)
    assert all(len(got[u]) == bought and not got[u] & own[u] for u in own)
    single = Counter(p for s in got.values() for p in s)
    pairs = Counter(tuple(sorted(s)) for s in got.values())
    mean = users * bought / products
    assert all(abs(single[p] - mean) < 5 * mean ** 0.5 for p in range(products))
    # pairs come together no more often than chance: near the expected count, none missing
    every = users / (products * (products - 1) / 2)
    chi = sum((pairs[p] - every) ** 2 / every for p in itertools.combinations(range(products), 2))
    cells = products * (products - 1) / 2
    assert abs(chi - cells) < 6 * (2 * cells) ** 0.5
    assert len(pairs) > 0.99 * cells * (1 - np.exp(-every))


def test_negatives_when_little_is_left(spark):
    pos = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 0)] + [("c", i) for i in range(10)], "customer_unique_id string, product_id long")
    cat = spark.range(10).select(F.col("id").alias("product_id"))
    got = sorted((r.customer_unique_id, r.product_id) for r in hybrid.negatives(pos, cat).collect())
    assert [g for g in got if g[0] == "a"] == [("a", 9)] and [g[0] for g in got].count("b") == 1 and "c" not in [g[0] for g in got]


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1 and s is not None]
    neg = [s for y, s in rows if y == 0 and s is not None]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None


def test_auc_matches_all_pairs(spark):
    rng = np.random.default_rng(0)
    for values in (1, 4, 1000):
        rows = [(int(rng.random() < 0.3), float(rng.integers(0, values))) for _ in range(400)] + [(1, None)]
        r = roc_auc(spark.createDataFrame(rows, "label int, score double"), "label", "score").first()
        assert abs(r.roc_auc - brute_auc(rows)) < 1e-12
        assert (r.positives, r.negatives) == (sum(y for y, s in rows if s is not None), sum(1 - y for y, _ in rows))
    for rows in ([], [(1, 0.5), (1, 0.7)]):
        assert roc_auc(spark.createDataFrame(rows, "label int, score double"), "label", "score").first().roc_auc is None


class Sum:
    """A model that prefers expensive and well rated products."""

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector
        p = F.col("avg_price") / 1000 + F.col("produto_avg_review_score") / 10 + F.col("customer_state") / 100
        return (df.withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("features", F.lit(0)).withColumn("rawPrediction", F.lit(0)))


def tables(spark):
    zero = lambda cols: [F.lit(0.0).alias(c) for c in cols]
    customers = spark.createDataFrame([("u", 1.0), ("v", 2.0)], "customer_unique_id string, customer_state double").select(
        "*", *zero(hybrid.FEATURES[1:8]))
    have = ["avg_price", "produto_avg_review_score", "rated"]
    products = spark.createDataFrame([("p1", 100.0, 5.0, True), ("p2", 300.0, 0.0, False), ("p3", 200.0, 2.0, True)],
                                     "product_id string, avg_price double, produto_avg_review_score double, rated boolean")
    products = products.select("product_id", *have, *zero([c for c in hybrid.FEATURES[8:] if c not in have]))
    codes = {"customer_state": spark.createDataFrame([("RJ", 0), ("SP", 1)], "value string, code int"),
             "preferred_category": spark.createDataFrame([("a", 0)], "value string, code int")}
    cand = spark.createDataFrame([(u, p) for u in "uv" for p in ("p1", "p2", "p3", "p4")], "customer_unique_id string, product_id string")
    return hybrid.FeatureTables(customers, products, codes), cand


def test_each_request_gets_its_own_list(spark):
    ft, cand = tables(spark)
    req = spark.createDataFrame([("r1", "u", None, None, 10.0, None), ("r2", "u", None, None, 99.0, None), ("r3", "u", "RJ", "a", None, 1.0),
                                 ("r4", "v", None, None, None, None)],
                                "request_id string, customer_unique_id string, state string, category string, price double, rating double")
    got = {}
    for r in hybrid.rerank_with_context(cand, req, ft, Sum(), n=3).collect():
        got.setdefault(r.request_id, {})[r["rank"]] = (r.product_id, round(r.score, 6))
    base = {"p1": (100, 5), "p2": (300, 4.0), "p3": (200, 2), "p4": (0, 4.0)}  # 4.0: not known
    def want(state, price=None, rating=None):
        s = sorted((-round((price or p) / 1000 + (rating or q) / 10 + state / 100, 6), k) for k, (p, q) in base.items())[:3]
        return {i + 1: (k, -v) for i, (v, k) in enumerate(s)}
    assert got == {"r1": want(1, price=10), "r2": want(1, price=99), "r3": want(0, rating=1), "r4": want(2)}


def test_fallbacks_by_request(spark):
    ft, cand = tables(spark)
    req = spark.createDataFrame([("r1", "u"), ("r2", "new"), ("r3", "new"), ("r4", "lonely")], "request_id string, customer_unique_id string")
    req = req.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("state", "string"), ("category", "string"), ("price", "double"))])
    known = spark.createDataFrame([("u",), ("lonely",)], "customer_unique_id string")
    cold = spark.createDataFrame([(f"r{i}", 1, f"c{i}") for i in range(1, 5)], "request_id string, rank long, product_id string")
    got = sorted((r.request_id, r.strategy, r.product_id) for r in hybrid.serve(req, cand, known, cold, ft, Sum(), n=1).collect())
    assert got == [("r1", hybrid.HYBRID, "p2"), ("r2", hybrid.COLD_START, "c2"), ("r3", hybrid.COLD_START, "c3"),
                   ("r4", hybrid.NO_CANDIDATES, "c4")]


def test_candidates_are_scored_once_and_in_all_partitions(spark):
    ft, cand = tables(spark)
    req = spark.createDataFrame([("u",), ("new",)], "customer_unique_id string").select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in (("state", "string"), ("category", "string"), ("price", "double"))])
    cold = req.select("customer_unique_id", F.lit(1).cast("long").alias("rank"), F.lit("c").alias("product_id"))
    plan = lambda d: d._jdf.queryExecution().sparkPlan().toString()
    served = hybrid.serve(req, cand, cand.select("customer_unique_id"), cold, ft, Sum(), n=1)
    # the fallbacks find their requests without a second scoring
    assert sum("produto_avg_review_score" in x and "/ 10" in x for x in plan(served).splitlines()) == 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = hybrid.rerank(cand, ft, Sum(), n=2)
    for scored in (served, listed):
        assert scored._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
        assert f", {parts}" in scored._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.customer_unique_id, r["rank"]): r.product_id for r in listed.collect()}
    assert got == {("u", 1): "p1", ("u", 2): "p3", ("v", 1): "p1", ("v", 2): "p3"}
