"""Keyed loads: replay, only touched buckets, joins without an exchange, graph tables."""

import os

from pyspark.sql import functions as F

from mercato.plans import graph
from mercato.sources.keyed import KeyedTable


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_replay_changes_nothing_and_a_batch_touches_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(f"k{i}", i, "a") for i in range(200)] + [("k3", 1000, "later"), (None, 1, "x")], "k string, v int, w string")
    t = KeyedTable.open(spark, "t_replay", path, a.schema, ["k"], buckets=8)
    assert t.upsert(a, order=["v"]) == list(range(8))
    assert sorted(tuple(r) for r in t.rows().collect()) == sorted((f"k{i}", i, "a") for i in range(200))
    seen = files(path)
    assert t.upsert(a, order=["v"]) == [] and files(path) == seen
    # one new key: one bucket is written, the others keep their files
    b = spark.createDataFrame([("new", 1, "b"), ("k5", 99, "b")], a.schema)
    (hit,) = t.upsert(b)
    now = files(path)
    assert {f for f in seen if f not in now or now[f] != seen[f]} == {f for f in seen if f"bucket={hit}/" in f}
    got = {r.k: (r.v, r.w) for r in t.rows().collect()}
    assert len(got) == 201 and got["new"] == (1, "b") and got["k5"] == (5, "a")
    assert len(t.upsert(b, replace=True)) in (1, 2)
    assert {r.k: r.v for r in t.rows().collect()}["k5"] == 99 and t.rows().count() == 201
    # another session finds it as it is
    again = KeyedTable.open(spark, "t_again", path, a.schema, ["k"], buckets=8)
    assert again.rows().count() == 201 and again.upsert(b, replace=False) == []


def test_tables_clustered_alike_join_without_exchange(spark, tmp_path):
    orders = spark.range(500).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 7).alias("c"))
    items = spark.range(1500).select(F.concat(F.col("id").cast("string")).alias("item_id"), (F.col("id") % 500).cast("string").alias("order_id"))
    o = KeyedTable.open(spark, "t_orders", str(tmp_path / "o"), orders.schema, ["order_id"], buckets=8)
    i = KeyedTable.open(spark, "t_items", str(tmp_path / "i"), items.schema, ["item_id"], cluster="order_id", buckets=8)
    o.upsert(orders)
    i.upsert(items)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = i.rows().join(o.rows(), "order_id").groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert "Exchange" not in plan
        assert joined.count() == 500 and joined.agg(F.sum("n")).first()[0] == 1500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_graph_load_twice_is_one_load(spark, tmp_path):
    from mercato.plans import silver
    from mercato.sources.fixtures import bronze_layer
    from tests.conftest import SF_SMALL
    layer = {k: v.checkpoint() for k, v in silver.build(bronze_layer(spark, SF_SMALL)).items()}
    n = graph.nodes(layer)
    want = {r.label: r.total for r in graph.label_counts(n).collect()}
    rels = {r.rel: r.total for r in graph.rel_counts(graph.edges(n)).collect()}
    loaded = graph.load(spark, layer, str(tmp_path / "g"), buckets=4)
    assert {r.label: r.total for r in graph.label_counts(loaded.nodes).collect()} == want
    assert {r.rel: r.total for r in graph.rel_counts(loaded.edges).collect()} == rels
    seen = files(str(tmp_path / "g"))
    graph.load(spark, layer, str(tmp_path / "g"), buckets=4)
    assert files(str(tmp_path / "g")) == seen
    assert sorted(map(tuple, loaded.nodes["Seller"].collect())) == sorted(map(tuple, n["Seller"].collect()))
