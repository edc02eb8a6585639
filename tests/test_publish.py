"""Published artefacts: all or nothing, and the same scores after a round trip."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.plans.recommend import als, hybrid, publish


def feature_tables(spark):
    rng = np.random.default_rng(0)
    customers = spark.createDataFrame([(f"u{i}", *[float(x) for x in rng.integers(0, 9, 8)]) for i in range(30)],
                                      "customer_unique_id string, " + ", ".join(f"{c} double" for c in hybrid.FEATURES[:8]))
    products = spark.createDataFrame([(f"p{i}", *[float(x) for x in rng.integers(0, 9, 8)], i % 4 > 0) for i in range(20)],
                                     "product_id string, " + ", ".join(f"{c} double" for c in hybrid.FEATURES[8:]) + ", rated boolean")
    codes = {"customer_state": spark.createDataFrame([("RJ", 0), ("SP", 1)], "value string, code int"),
             "preferred_category": spark.createDataFrame([("a", 0)], "value string, code int")}
    return hybrid.FeatureTables(customers, products, codes)


def everything(ft, idx):
    return {"customer_features": ft.customers, "product_features": ft.products, "users": idx.users, "items": idx.items,
            **{f"codes_{k}": v for k, v in ft.codes.items()}}


def test_round_trip_scores_alike(spark, tmp_path):
    ft = feature_tables(spark)
    pairs = ft.customers.select("customer_unique_id").crossJoin(ft.products.select("product_id")).where(F.crc32(F.concat("customer_unique_id", "product_id")) % 3 == 0)
    neg = ft.customers.select("customer_unique_id").crossJoin(ft.products.select("product_id")).where(F.crc32(F.concat("customer_unique_id", "product_id")) % 3 == 1)
    ranker = hybrid.train(hybrid.training_set(pairs, neg, ft), trees=3, depth=3)
    idx = als.index_interactions(pairs.withColumn("implicit_score", F.lit(1.0)))
    model = als.fit(idx, rank=4, max_iter=2, blocks=2)
    root = str(tmp_path / "pub")
    with pytest.raises(FileNotFoundError):
        publish.current(spark, root)
    first = publish.publish(spark, root, {"als": model, "ranker": ranker}, everything(ft, idx))
    got = publish.current(spark, root)
    assert got.version == first and got.features == hybrid.FEATURES and got.models["als"].rank == 4
    score = lambda m, t: sorted(map(tuple, hybrid.rerank(pairs, t, m, 5).select("customer_unique_id", "rank", "product_id", "score_hybrid").collect()))
    assert score(got.models["ranker"], got.feature_tables()) == score(ranker, ft)
    assert sorted(map(tuple, got.tables["items"].collect())) == sorted(map(tuple, idx.items.collect()))

    # a job that dies when all is written, before the pointer: the old version stays
    def die():
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, root, {"ranker": ranker}, {"items": idx.items.limit(1)}, before_pointer=die)
    again = publish.current(spark, root)
    assert again.version == first and again.tables["items"].count() == idx.items.count()

    second = publish.publish(spark, root, {"ranker": ranker}, {"items": idx.items.limit(1)}, features=["a"])
    now = publish.current(spark, root)
    assert now.version == second != first and now.features == ["a"] and set(now.tables) == {"items"} and set(now.models) == {"ranker"}
    # who opened the old version still reads it
    assert got.tables["items"].count() == idx.items.count()


def test_a_write_that_fails_midway_shows_nothing(spark, tmp_path):
    root = str(tmp_path / "pub")
    good = spark.range(3)
    publish.publish(spark, root, {}, {"t": good})
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        publish.publish(spark, root, {}, {"t": good, "u": bad})
    got = publish.current(spark, root)
    assert set(got.tables) == {"t"} and got.tables["t"].count() == 3
    with pytest.raises(ValueError):
        publish.publish(spark, root, {"other": None}, {})
