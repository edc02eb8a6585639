"""Data quality (Q1-Q5): profiles, missing shares and quality score, layer
overview, rule checks as one aggregation, fail-fast assertions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import np_round
from mercato.operators import layer_overview, profile  # noqa: F401  (Q1, Q3)


def missing_share(df: DataFrame, stage: str) -> DataFrame:
    """Q2: null share per column, long form ``(stage, column, missing_share)``."""
    cols = df.columns
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_share"))
                             for i, c in enumerate(cols)]))
    return row.select(F.lit(stage).alias("stage"), st.alias("_s")).select(
        "stage", "_s.column", np_round("_s.missing_share", 6).alias("missing_share"))


def quality_score(after: DataFrame) -> DataFrame:
    """Q2: ``100 * (1 - mean null share)`` over the columns."""
    cols = after.columns
    mean_share = sum((F.avg(F.col(c).isNull().cast("double")) for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))
    return after.agg(np_round(F.lit(100.0) * (F.lit(1.0) - mean_share), 6).alias("quality_score"))


def rules(gold: dict[str, DataFrame], implicit_upper: float | None = None, min_states: int = 25) -> DataFrame:
    """Q4: rule checks ``(check, passed, detail)``. The implicit-score upper
    bound of the reference cannot hold (T14), so only the lower bound is
    checked unless ``implicit_upper`` is given."""
    inter, aff, top, cooc = (gold["user_product_interactions"], gold["category_affinity"],
                             gold["top_products_by_segment"], gold["product_cooccurrence"])
    s = F.col("implicit_score")
    bad_score = (s < 0) if implicit_upper is None else ((s < 0) | (s > implicit_upper))
    i = inter.agg(F.count_if(bad_score).alias("bad"), F.count_if(F.col("customer_unique_id").isNull()).alias("null_user"),
                  F.count_if(F.col("product_id").isNull()).alias("null_product"))
    a = aff.agg(F.count_if((F.col("affinity_score") < 0) | (F.col("affinity_score") > 1)).alias("bad"))
    t = top.agg(F.count_if(F.col("segment_type") == "global").alias("global_rows"),
                F.count_distinct(F.when(F.col("segment_type") == "state", F.col("segment_value"))).alias("states"))
    c = cooc.agg(F.count_if((F.col("cooccurrence_score") < 0) | (F.col("cooccurrence_score") > 1)).alias("bad"))

    def chk(df, name, passed, detail):
        return df.select(F.lit(name).alias("check"), passed.alias("passed"), detail.cast("string").alias("detail"))

    parts = [
        chk(i, "implicit_score in range", F.col("bad") == 0, F.col("bad")),
        chk(i, "no null customer_unique_id", F.col("null_user") == 0, F.col("null_user")),
        chk(i, "no null product_id", F.col("null_product") == 0, F.col("null_product")),
        chk(a, "affinity_score in [0, 1]", F.col("bad") == 0, F.col("bad")),
        chk(t, "global segment present", F.col("global_rows") > 0, F.col("global_rows")),
        chk(t, "states covered", F.col("states") >= min_states, F.col("states")),
        chk(c, "cooccurrence_score in [0, 1]", F.col("bad") == 0, F.col("bad")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def customer_assertions(customers: DataFrame) -> DataFrame:
    """Q5: silver customer rules (state length <= 2, zip length = 5) in Q4
    form; nulls count as failures of the zip rule like the reference."""
    r = customers.agg(
        F.count_if(F.length("customer_state") > 2).alias("bad_state"),
        F.count_if(F.coalesce(F.length("customer_zip_code_prefix") != 5, F.lit(True))).alias("bad_zip"))
    return (r.select(F.lit("state length <= 2").alias("check"), (F.col("bad_state") == 0).alias("passed"),
                     F.col("bad_state").cast("string").alias("detail"))
            .unionByName(r.select(F.lit("zip length = 5").alias("check"), (F.col("bad_zip") == 0).alias("passed"),
                                  F.col("bad_zip").cast("string").alias("detail"))))


def raise_on_failure(checks: DataFrame) -> None:
    """Fail fast: one small action over the (few) rule rows."""
    failed = [r["check"] for r in checks.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise AssertionError(f"data checks failed: {failed}")
