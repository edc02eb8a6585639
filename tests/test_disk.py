"""What lies on disk while a query runs does not grow with its rounds."""

import glob
import os
import re
import time

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from mercato.operators import layer_overview
from mercato.plans.recommend import als, hybrid
from mercato.session import ensure_checkpoint_dir
from mercato.sources.keyed import KeyedTable


def shuffles(spark):
    """Numbers of the shuffles with files on disk."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {int(m[1]) for d in dirs for f in glob.glob(f"{d}/*/shuffle_*") if (m := re.search(r"shuffle_(\d+)_", f))}


def folders(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return set(os.listdir(top))


def pairs(spark, users=60, items=50):
    rng = np.random.default_rng(5)
    rows = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, users, 900), rng.integers(0, items, 900), strict=True)})
    return spark.createDataFrame([(f"u{a:03d}", f"p{b:03d}", float(1 + (a * b) % 5)) for a, b in rows],
                                 "customer_unique_id string, product_id string, implicit_score double")


def test_a_query_leaves_no_shuffle_files(spark):
    before = shuffles(spark)
    idx = als.index_interactions(pairs(spark))
    assert idx.ratings.count() > 0
    time.sleep(1)  # files are removed in the background
    assert not shuffles(spark) - before


def test_a_fit_keeps_the_shuffles_of_its_last_iterations_only(spark):
    idx = als.index_interactions(pairs(spark))
    before = shuffles(spark)
    model = als.fit(idx, rank=4, max_iter=25, blocks=2)
    time.sleep(2)
    assert len(shuffles(spark) - before) < 12  # two an iteration and those of the ratings, before
    assert model.userFactors.count() == 60


def test_rounds_replace_each_other(spark, monkeypatch):
    monkeypatch.setattr(als, "STEP", 4)
    monkeypatch.setattr(als, "ROUND_ITEMS", 8)
    idx = als.index_interactions(pairs(spark))
    model = als.written(als.fit(idx, rank=4, max_iter=2, blocks=2))
    before = folders(spark)
    recs = als.recommend(model, idx, 5, block_items=4)
    left = {f for f in folders(spark) - before if f.startswith("cut-")}
    assert len(left) == 1  # the users' last state; a state a round before, and items copied to every group of users
    assert "CoGroup" not in recs._jdf.queryExecution().toString() and recs.count() > 0


def test_users_are_folded_in_by_shares(spark, monkeypatch):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 5)).astype(np.float32)
    items = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(v)], "id int, features array<float>")
    rows = [(u, int(i), float(1 + (u * i) % 4)) for u in range(30) for i in set(rng.integers(0, 60, 1 + 2 * u).tolist())]
    ratings = spark.createDataFrame(rows, "user_idx int, item_idx int, rating float")
    whole = {r.id: r.features for r in als.fold_in(items, ratings, chunk=7).collect()}
    monkeypatch.setattr(als, "FOLD_RATINGS", len(rows) // 5)
    before = folders(spark)
    shared = {r.id: r.features for r in als.fold_in(items, ratings, chunk=7).collect()}
    assert len({f for f in folders(spark) - before if f.startswith("cut-")}) == 7  # six shares and the histories' sizes
    assert sorted(shared) == sorted(whole) == sorted({u for u, _, _ in rows})
    assert all(np.allclose(shared[u], whole[u], rtol=1e-4, atol=1e-5) for u in whole)


class _Model:
    """Scores by price and orders."""

    def transform(self, df):
        score = (F.col("avg_price") + F.col("cliente_total_orders")) / 100
        return VectorAssembler(inputCols=["_no", "_yes"], outputCol="probability").transform(
            df.select("*", (1 - score).alias("_no"), score.alias("_yes")))


def _features(spark):
    text = lambda k, n: spark.createDataFrame([(f"{k}{i}",) for i in range(n)], "value string").withColumn("code", F.substring("value", 2, 2).cast("int"))
    customers = spark.createDataFrame([(f"u{i}", float(i)) for i in range(4)], "customer_unique_id string, cliente_total_orders double")
    products = spark.createDataFrame([(f"p{i}", float(i % 3), i != 2) for i in range(5)], "product_id string, avg_price double, rated boolean")
    for c in hybrid.FEATURES:
        if c in ("cliente_total_orders", "avg_price"):
            continue
        own = "customers" if c in ("customer_state", "total_spent", "cliente_avg_review_score", "preferred_category",
                                   "preferred_payment_type", "avg_installments", "avg_delivery_distance") else "products"
        if own == "customers":
            customers = customers.withColumn(c, F.lit(1.0))
        else:
            products = products.withColumn(c, F.lit(1.0))
    return hybrid.FeatureTables(customers, products, {"customer_state": text("s", 3), "preferred_category": text("c", 3)})


def test_candidates_move_once_for_each_table(spark):
    ft = _features(spark)
    candidates = spark.createDataFrame([(f"u{u}", f"p{p}") for u in range(5) for p in range(4)], "customer_unique_id string, product_id string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = hybrid.rerank(candidates, ft, _Model(), 3)
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 4
        got = {}
        for r in df.collect():
            got.setdefault(r.customer_unique_id, []).append((r["rank"], r.product_id))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert {u: sorted(v) for u, v in got.items()} == {f"u{u}": [(1, "p2"), (2, "p1"), (3, "p0")] for u in range(5)}


def test_requests_twice_or_without_id_keep_their_lists(spark):
    ft = _features(spark)
    candidates = spark.createDataFrame([(f"u{u}", f"p{p}") for u in range(4) for p in range(3)], "customer_unique_id string, product_id string")
    requests = spark.createDataFrame([("a", "u0", "s1", None, 5.0), ("a", "u0", "s1", None, 5.0), (None, "u1", "zz", "c2", None), ("b", None, None, None, None)],
                                     "request_id string, customer_unique_id string, state string, category string, price double")
    got = sorted(((r.request_id, r["rank"], r.product_id) for r in hybrid.rerank_with_context(candidates, requests, ft, _Model(), 4).collect()),
                 key=str)
    assert got == sorted([("a", 1, "p0"), ("a", 2, "p0"), ("a", 3, "p1"), ("a", 4, "p1"),
                          (None, 1, "p2"), (None, 2, "p1"), (None, 3, "p0")], key=str)


def test_loads_leave_nothing_but_the_table(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", f"o{i % 9}", float(i)) for i in range(60)], "item_id string, order_id string, price double")
    before, files = folders(spark), spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    rdds = {f for f in os.listdir(files) if f.startswith("rdd-")}
    t = KeyedTable.open(spark, "disk_items", str(tmp_path / "items"), rows.schema, ["item_id"], "order_id", buckets=3)
    t.upsert(rows.where("price < 20"))
    t.upsert(rows)
    assert t.upsert(rows) == []
    t.upsert(rows.where("price < 5").withColumn("price", F.lit(-1.0)), replace=True)
    assert sorted((r.item_id, r.price) for r in t.rows().collect()) == sorted((f"k{i}", -1.0 if i < 5 else float(i)) for i in range(60))
    assert not {f for f in folders(spark) - before if f.startswith("cut-")} and not {f for f in os.listdir(files) if f.startswith("rdd-")} - rdds


def test_overview_runs_one_table_after_the_other(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, None)], "k int, v string")
    df = layer_overview({"a": a, "b": a.groupBy("k").count(), "c": a.where("false")})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 3
    assert sorted(tuple(r) for r in df.collect()) == [("a", 3, 2, 2), ("b", 2, 2, 0), ("c", 0, 2, 0)]
