"""Property checks over real (sf0.001) outputs."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def qs():
    import __spark_entry__ as E
    return E.queries()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "implicit_score" in df.columns


def test_jaccard_bounds_and_symmetry(spark, qs):
    cooc = qs["g5_cooccurrence"](spark, SF_SMALL)
    assert cooc.where("cooccurrence_score < 0 or cooccurrence_score > 1 or product_id_a >= product_id_b").count() == 0


def test_affinity_bounds(spark, qs):
    assert qs["g4_category_affinity"](spark, SF_SMALL).where("affinity_score < 0 or affinity_score > 1").count() == 0


def test_top_by_segment_ranks_dense(spark, qs):
    top = qs["g6_top_by_segment"](spark, SF_SMALL)
    bad = top.groupBy("segment_type", "segment_value").agg(
        F.max("rank").alias("mx"), F.count(F.lit(1)).alias("n"), F.min("rank").alias("mn")).where(
        "mx <> n or mn <> 1")
    assert bad.count() == 0


def test_edges_have_both_ends(spark, qs):
    nodes = qs["k1_nodes"](spark, SF_SMALL)
    edges = qs["k2_edges"](spark, SF_SMALL)
    src = edges.join(nodes, (edges.src_label == nodes.label) & (edges.src == nodes.node_key), "left_anti")
    dst = edges.join(nodes, (edges.dst_label == nodes.label) & (edges.dst == nodes.node_key), "left_anti")
    assert src.count() == 0 and dst.count() == 0
    assert nodes.groupBy("label", "node_key").count().where("count > 1").count() == 0


def test_tfidf_rows_unit_norm(spark, qs):
    t = qs["r2_tfidf"](spark, SF_SMALL)
    norms = t.groupBy("product_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1) > 1e-9).count() == 0


def test_negatives_disjoint_and_balanced(spark, qs):
    from mercato.plans import queries as Q
    a = Q._assets(spark, SF_SMALL)
    neg = qs["r11_negatives"](spark, SF_SMALL)
    inter = a["inter"]
    assert neg.join(inter, ["customer_unique_id", "product_id"]).count() == 0
    sample = qs["r10_user_sample"](spark, SF_SMALL)
    pos = inter.join(sample, "customer_unique_id", "left_semi").groupBy("customer_unique_id").count()
    ng = neg.groupBy("customer_unique_id").count()
    assert sorted(tuple(r) for r in pos.collect()) == sorted(tuple(r) for r in ng.collect())


def test_cf_recommendations_exclude_history(spark, qs):
    from mercato.plans import queries as Q
    recs = qs["r6_cf_recommendations"](spark, SF_SMALL)
    inter = Q._assets(spark, SF_SMALL)["inter"]
    assert recs.join(inter, ["customer_unique_id", "product_id"]).count() == 0
    assert recs.groupBy("customer_unique_id").agg(F.max("rank").alias("m")).where("m > 10").count() == 0
