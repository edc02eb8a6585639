"""Ordered writes: global order over files, ties, skew, pruning by the manifest."""

import random

from pyspark.sql import functions as F

from mercato.sources import ordered


def rows(n=4000):
    rng = random.Random(0)
    # a third of the rows share one key; many ties; nulls
    return [(None if i % 50 == 0 else 7 if i % 3 == 0 else rng.randrange(40), rng.choice([0.5, 1.5, None]), f"r{i}") for i in range(n)]


def last(x):
    return (x is None, x or 0)


def test_file_order_is_the_global_order(spark, tmp_path):
    df = spark.createDataFrame(rows(), "k int, score double, name string").repartition(5)
    path = str(tmp_path / "t")
    ordered.write_ordered(df, path, ["k", ("score", False)], files=12)
    man = ordered.manifest(spark, path).orderBy("place").collect()
    assert sum(m.rows for m in man) == 4000 and [m.before for m in man] == [sum(x.rows for x in man[:i]) for i in range(len(man))]
    assert max(m.rows for m in man) < 4000 / 4  # the hot key is in several files
    assert sum(m.first.k == 7 and m.last.k == 7 for m in man) >= 2
    got = ordered.read_ordered(spark, path).collect()
    assert sorted(r.position for r in got) == list(range(4000))
    by_place = [(r.k, r.score) for r in sorted(got, key=lambda r: r.position)]
    assert by_place == sorted(by_place, key=lambda r: (last(r[0]), (r[1] is None, -(r[1] or 0))))
    assert sorted(r.name for r in got) == sorted(r[2] for r in rows())
    # a reader that goes through the files by name meets the same order
    files = [spark.read.parquet(f"{path}/{m.file}").collect() for m in man]
    assert [(r.k, r.score) for f in files for r in f] == by_place


def test_range_reads_only_files_that_meet_it(spark, tmp_path):
    df = spark.createDataFrame(rows(), "k int, score double, name string")
    path = str(tmp_path / "t")
    ordered.write_ordered(df, path, ["k"], files=12)
    for low, high in ((3, 9), (7, 7), (100, 200), (39, 50)):
        got = ordered.read_range(spark, path, "k", low, high)
        assert sorted(r.name for r in got.collect()) == sorted(r[2] for r in rows() if r[0] is not None and low <= r[0] <= high)
    few = ordered.read_range(spark, path, "k", 0, 1)
    assert few.select(F.input_file_name().alias("f")).distinct().count() < 6


def test_same_rows_again_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")] * 10 + [(0, "b")], "k int, name string")
    ordered.write_ordered(df, path, ["k"], files=3)
    assert [r.k for r in ordered.read_ordered(spark, path).orderBy("position").collect()] == [0] + [1] * 10
    ordered.write_ordered(df.limit(0), path, ["k"], files=3)
    assert ordered.read_ordered(spark, path).count() == 0 and ordered.read_range(spark, path, "k", 0, 9).count() == 0
