"""Sources and sinks: CSV Latin-1 fallback, header trimming, layer listing,
round trip, and the idempotent streaming append."""

import os
import tempfile

from mercato.sources import io


def test_csv_latin1_fallback_and_header_trim(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    path = os.path.join(d, "t.csv")
    with open(path, "wb") as f:
        f.write(" id , city \n1,São Paulo\n".encode("latin-1"))
    df = io.read_table(spark, path)
    r = df.first()
    assert df.columns == ["id", "city"] and r.city == "São Paulo"


def test_layer_roundtrip(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    io.write_table(df, f"{d}/alpha")
    io.write_table(df, f"{d}/beta")
    assert io.list_tables(spark, d) == ["alpha", "beta"]
    layer = io.load_layer(spark, d, fmt="parquet")
    assert sorted(layer) == ["alpha", "beta"] and layer["alpha"].count() == 2


def test_missing_layer_is_error(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        io.list_tables(spark, "/tmp/definitely-not-here-mercato")


def test_streaming_keyed_append_is_idempotent(spark):
    from mercato.streaming import start_keyed_append
    d = tempfile.mkdtemp(dir="/tmp")
    src, tgt, ck = f"{d}/src", f"{d}/tgt", f"{d}/ck"
    schema = "id long, v string"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], schema).write.parquet(f"{src}/b1")
    q = start_keyed_append(spark, f"{src}/*", schema, ["id"], tgt, ck, order=["v"])
    q.awaitTermination()
    spark.createDataFrame([(2, "z"), (3, "d")], schema).write.parquet(f"{src}/b2")
    q = start_keyed_append(spark, f"{src}/*", schema, ["id"], tgt, ck, order=["v"])
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(tgt).collect())
    assert got == [(1, "a"), (2, "c"), (3, "d")]


def test_persist_roundtrip(spark):
    from mercato.plans.recommend import als, persist
    d = tempfile.mkdtemp(dir="/tmp")
    inter = spark.createDataFrame([(u, p, 1.0 + (u * p) % 3) for u in range(6) for p in range(5) if (u + p) % 2 == 0],
                                  "customer_unique_id long, product_id long, implicit_score double")
    idx = als.index_interactions(inter)
    model = als.fit(idx, rank=2, max_iter=2)
    paths = persist.save(d, als_model=model, tables={"items": idx.items})
    got = persist.load(spark, d, ["items"])
    assert set(paths) == {"als", "items"}
    assert got["items"].count() == 5
    assert got["als"].userFactors.count() == model.userFactors.count()


def test_batch_job_writes_every_layer(spark):
    from mercato import jobs
    from mercato.sources.fixtures import bronze_layer
    from tests.conftest import SF_SMALL
    d = tempfile.mkdtemp(dir="/tmp")
    done = []
    jobs.run(spark, bronze_layer(spark, SF_SMALL), d, timer=lambda n, s: done.append(n), reports=False, ml=False)
    assert {"silver", "gold", "details", "rec"} <= set(os.listdir(d))
    assert spark.read.parquet(f"{d}/gold/top_products_by_segment").count() > 0
    assert "rec_cross_category" in done


def test_batch_job_learns_routes_evaluates_and_publishes(spark):
    from mercato import jobs
    from mercato.plans.recommend import hybrid, publish
    from mercato.sources.fixtures import bronze_layer
    from tests.conftest import SF_SMALL
    d = tempfile.mkdtemp(dir="/tmp")
    jobs.run(spark, bronze_layer(spark, SF_SMALL), d, trees=2, fit={"rank": 4, "max_iter": 2})
    read = lambda name: spark.read.parquet(f"{d}/{name}")
    assert {r.rel for r in spark.table("graph_edges").select("rel").distinct().collect()} >= {"PLACED", "CONTAINS", "HAS_REVIEW"}
    assert spark.table("graph_orderitem").count() == read("silver/order_items").count()
    assert {"hybrid", "cold_start"} >= {r.strategy for r in read("rec/routed").select("strategy").distinct().collect()} != set()
    assert {r.method for r in read("rec/evaluation").collect()} == {"content_tfidf", "collaborative_filtering_als"}
    assert read("rec/ranker_report").count() == 2 and read("rec/ranker_importances").count() == len(hybrid.FEATURES)
    # what was published ranks as the job did
    got = publish.current(spark, f"{d}/published")
    own = read("rec/hybrid").select("customer_unique_id", "product_id")
    again = hybrid.rerank(own, got.feature_tables(), got.models["ranker"], 10)
    cols = ["customer_unique_id", "rank", "product_id", "score_hybrid"]
    assert sorted(map(tuple, again.select(*cols).collect())) == sorted(map(tuple, read("rec/hybrid").select(*cols).collect()))


def test_csv_quotes_line_breaks_and_latin1_by_file(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    folder = os.path.join(d, "reviews.csv")
    os.mkdir(folder)
    with open(os.path.join(folder, "a.csv"), "wb") as f:
        f.write('id,message\n1,"first line\nsecond, line"\n2,"said ""good, fine"" ok"\n3,maçã\n'.encode())
    with open(os.path.join(folder, "b.csv"), "wb") as f:
        f.write('id,message\n4,"São\nPaulo"\n'.encode("latin-1"))
    with open(os.path.join(folder, "c.csv"), "wb") as f:  # good UTF-8 that holds the replacement character itself
        f.write('id,message\n5,lost \ufffd and maçã\n'.encode())
    got = {r.id: r.message for r in io.read_table(spark, folder, fmt="csv").collect()}
    assert got == {"1": "first line\nsecond, line", "2": 'said "good, fine" ok', "3": "maçã", "4": "São\nPaulo", "5": "lost \ufffd and maçã"}


def test_layer_names_and_missing_tables(spark):
    import pytest
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    io.write_table(df, f"{d}/raw_alpha_dataset")
    io.write_table(df, f"{d}/beta")
    layer = io.load_layer(spark, d, names={"raw_alpha_dataset": "alpha"}, expected=["alpha", "beta"])
    assert sorted(layer) == ["alpha", "beta"]
    with pytest.raises(ValueError, match="missing tables .'alpha'.*unknown tables .'raw_alpha_dataset'"):
        io.load_layer(spark, d, expected=["alpha", "beta"])


def test_unknown_bronze_table_is_an_error(spark):
    import pytest
    from mercato.plans import silver
    with pytest.raises(ValueError, match="unknown bronze tables"):
        silver.build({"nonsense": spark.range(1)})


def test_job_from_csv_with_renamed_files(spark):
    from mercato import jobs
    from mercato.sources.fixtures import bronze_layer
    from tests.conftest import SF_SMALL
    d = tempfile.mkdtemp(dir="/tmp")
    names = []
    for name, df in bronze_layer(spark, SF_SMALL).items():
        io.write_table(df.coalesce(1), f"{d}/bronze/shop_{name}_dataset", fmt="csv")
        names += ["--name", f"shop_{name}_dataset={name}"]
    jobs.main(["--bronze", f"{d}/bronze", "--out", f"{d}/out", "--no-ml", "--no-reports", *names])
    assert spark.read.parquet(f"{d}/out/silver/orders").count() > 0


def test_corrupt_model_is_an_error(spark):
    import pytest
    from mercato.plans.recommend import persist
    d = tempfile.mkdtemp(dir="/tmp")
    assert persist.load(spark, d) == {}
    os.makedirs(f"{d}/als")
    with pytest.raises(Exception):  # noqa: B017
        persist.load(spark, d)
