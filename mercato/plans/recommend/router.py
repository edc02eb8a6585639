"""Unified router (R20) and cross-category suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators import top_n_per_group

USER, ITEM = "customer_unique_id", "product_id"


def route(requests: DataFrame, inter: DataFrame, profile: DataFrame) -> DataFrame:
    """Strategy per request from two flag joins: history and profile
    -> hybrid; history only -> cf; otherwise cold_start."""
    hist = inter.select(USER).distinct().withColumn("_h", F.lit(True))
    prof = profile.select(USER).distinct().withColumn("_p", F.lit(True))
    r = requests.join(hist, USER, "left").join(prof, USER, "left")
    strategy = (F.when(F.col("_h") & F.col("_p"), "hybrid").when(F.col("_h"), "cf").otherwise("cold_start"))
    return r.withColumn("strategy", strategy).drop("_h", "_p")


def combine(routed: DataFrame, hybrid: DataFrame, cf: DataFrame, cold: DataFrame,
            also: DataFrame | None = None, n_also: int = 5) -> DataFrame:
    """One table of recommendations with their strategy; with
    ``also`` (R9 output) and a ``current_product_id`` on the request, the
    also-bought list is appended with strategy ``also_bought``. Requests with
    a ``request_id`` keep it."""
    cols = [USER, "rank", ITEM]
    own = [USER, "request_id"] if "request_id" in routed.columns else [USER]
    parts = [
        routed.where(F.col("strategy") == "hybrid").select(*own).join(hybrid.select(*cols), USER)
        .withColumn("strategy", F.lit("hybrid")),
        routed.where(F.col("strategy") == "cf").select(*own).join(cf.select(*cols), USER)
        .withColumn("strategy", F.lit("cf")),
        routed.where(F.col("strategy") == "cold_start").select(*own).join(cold.select(*cols), USER)
        .withColumn("strategy", F.lit("cold_start")),
    ]
    if also is not None and "current_product_id" in routed.columns:
        a = (routed.where(F.col("current_product_id").isNotNull()).select(*own, F.col("current_product_id").alias(ITEM))
             .join(also.where(F.col("rank") <= n_also), ITEM)
             .select(*own, "rank", F.col("other_product_id").alias(ITEM)).withColumn("strategy", F.lit("also_bought")))
        parts.append(a)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_category(affinity: DataFrame, top: DataFrame, inter: DataFrame, m: int = 3, n: int = 10) -> DataFrame:
    """A user's m highest-affinity categories -> the top products of
    those categories (G6), minus what the user bought, best n by
    (affinity desc, segment rank, product_id)."""
    cats = top_n_per_group(affinity.select(USER, "product_category_name_english", "affinity_score"), [USER],
                           [F.col("affinity_score").desc(), F.col("product_category_name_english")], m, "_crank")
    seg = top.where(F.col("segment_type") == "category").select(
        F.col("segment_value").alias("product_category_name_english"), F.col("rank").alias("_srank"), ITEM)
    cand = cats.join(seg, "product_category_name_english").join(inter.select(USER, ITEM), [USER, ITEM], "left_anti")
    cand = cand.groupBy(USER, ITEM).agg(F.min(F.struct(F.col("_crank"), F.col("_srank"),
                                                       F.col("product_category_name_english"))).alias("_b"))
    ranked = top_n_per_group(cand, [USER], [F.col("_b._crank"), F.col("_b._srank"), F.col(ITEM)], n)
    return ranked.select(USER, F.col("rank").cast("bigint").alias("rank"), ITEM,
                         F.col("_b.product_category_name_english").alias("product_category_name_english"))
