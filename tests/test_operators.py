"""Operators against brute force, including skewed groups."""

import itertools

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import dense_index, keep_first, pairs_within, top1_by_count
from mercato.operators.sampling import explode_range, hash_bucket, limit_per_group


def test_pairs_within_hot_group_matches_brute_force(spark):
    # one group holds most members; a tiny bucket forces the split path
    data = [(1, m) for m in range(60)] + [(2, m) for m in range(3)] + [(3, 7)]
    df = spark.createDataFrame(data, "g long, m long")
    got = sorted(tuple(r) for r in pairs_within(df, "g", "m", bucket_rows=7).collect())
    want = sorted((g, a, b) for g in (1, 2, 3) for a, b in itertools.combinations(sorted(m for gg, m in data if gg == g), 2))
    assert got == want


def test_pairs_within_payload(spark):
    df = spark.createDataFrame([("t", "x", 1.0), ("t", "y", 2.0)], "g string, m string, w double")
    r = pairs_within(df, "g", "m", payload=("w",)).first()
    assert (r.a, r.b, r.w_a, r.w_b) == ("x", "y", 1.0, 2.0)


def test_keep_first_is_idempotent_and_ordered(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "z"), (1, 1, "a"), (2, None, "b")], "k long, o long, v string")
    once = keep_first(df, ["k"], ["o"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, 1, "a"), (2, None, "b")]
    assert sorted(tuple(r) for r in keep_first(once, ["k"], ["o"]).collect()) == sorted(tuple(r) for r in once.collect())


def test_top1_by_count_ties_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (2, None)], "k long, v string")
    assert {r.k: r.v for r in top1_by_count(df, "k", "v").collect()} == {1: "a"}


def test_dense_index_is_dense(spark):
    df = spark.createDataFrame([(x,) for x in [5, 9, 5, 1, 100, 42]], "id long")
    got = sorted((r.id, r.idx) for r in dense_index(df, "id", "idx", partitions=3).collect())
    assert got == [(1, 0), (5, 1), (9, 2), (42, 3), (100, 4)]


def test_explode_range_chunks(spark):
    df = spark.createDataFrame([(1, 25), (2, 0), (3, 3)], "u long, n int")
    got = explode_range(df, F.lit(1), F.col("n"), "j", chunk=4)
    counts = {r.u: r["count"] for r in got.groupBy("u").count().collect()}
    assert counts == {1: 25, 3: 3}
    assert sorted(r.j for r in got.where("u = 1").collect()) == list(range(1, 26))


def test_limit_per_group_matches_window(spark):
    rows = [(u, i) for u in range(3) for i in range(200 * (u + 1))]
    df = spark.createDataFrame(rows, "u long, i long").withColumn("k", F.lit(37) * (F.col("u") + 1)) \
        .withColumn("h", F.xxhash64("u", "i"))
    got = limit_per_group(df, ["u"], "k", [F.col("h"), F.col("i")], hash_bucket(F.col("h"), 4))
    w = Window.partitionBy("u").orderBy("h", "i")
    want = df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= F.col("k")).drop("r")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
