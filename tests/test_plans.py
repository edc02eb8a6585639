"""Plan shape: no Python evaluation, no Cartesian products, pushdown and
pruning reach the Parquet scan, top-n uses a partial group limit."""

import pytest

from tests.conftest import SF_SMALL

PLAN_QUERIES = ["b6_order_items", "g1_interactions", "g2_product_features", "g3_customer_profile",
                "g4_category_affinity", "g5_cooccurrence", "g6_top_by_segment", "h3_delivery", "h7_customers",
                "e1_revenue_by_state", "k2_edges", "k12_category_pairs", "d4_by_payment", "r3_similar_products",
                "r7_cold_start", "r26_cross_category"]
CF_QUERIES = ["r6_cf_recommendations", "r22_cf_evaluation"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_python_no_cartesian(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("name", CF_QUERIES)
def test_collaborative_queries_have_no_cartesian(spark, name):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan


def test_window_group_limit_for_top_n(spark):
    import __spark_entry__ as E
    df = E.queries()["g6_top_by_segment"](spark, SF_SMALL)
    assert "WindowGroupLimit" in df._jdf.queryExecution().sparkPlan().toString()


def test_scan_pruning_and_pushdown(spark):
    from pyspark.sql import functions as F
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    plan = li.where(F.col("l_tax") > 0.05).select("l_orderkey").   \
        _jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_tax), GreaterThan(l_tax,0.05)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan
    import __spark_entry__ as E
    items = E.queries()["b6_order_items"](spark, SF_SMALL)
    p = items._jdf.queryExecution().sparkPlan().toString()
    assert "l_quantity" not in p.split("ReadSchema")[1].split("\n")[0]
