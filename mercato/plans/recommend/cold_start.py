"""Cold-start recommendations from the top-by-segment table.

Requests are a DataFrame with an id column and optional ``state`` /
``category`` context. The segment lists are small per segment (n rows);
requests are joined to the one list their priority picks, so the output is
requests x n rows with no per-request driver work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators import top_n_per_group
from mercato.session import cut

OUT = ["rank", "product_id", "product_category_name_english", "avg_review_score", "avg_price", "total_orders"]


def recommend(requests: DataFrame, top: DataFrame, n: int = 10, key: str = "customer_unique_id") -> DataFrame:
    """Priority state > category > global, case-insensitive match,
    ordered by segment rank. ``requests``: ``key, state, category``."""
    st = top.where(F.col("segment_type") == "state").select(F.upper("segment_value").alias("_k")).distinct() \
        .withColumn("_has_state", F.lit(True))
    ct = top.where(F.col("segment_type") == "category").select(F.lower("segment_value").alias("_k")).distinct() \
        .withColumn("_has_cat", F.lit(True))
    r = (requests.select(key, "state", "category")
         .join(st, F.upper(requests["state"]) == st["_k"], "left").drop("_k")
         .join(ct, F.lower(requests["category"]) == ct["_k"], "left").drop("_k"))
    level = (F.when(F.col("_has_state"), F.lit("state")).when(F.col("_has_cat"), F.lit("category"))
             .otherwise(F.lit("global")))
    value = (F.when(F.col("_has_state"), F.upper("state")).when(F.col("_has_cat"), F.lower("category"))
             .otherwise(F.lit("all")))
    r = r.select(key, level.alias("segment_type"), value.alias("_v"))
    lists = top.where(F.col("rank") <= n).select(
        "segment_type", F.when(F.col("segment_type") == "state", F.upper("segment_value"))
        .when(F.col("segment_type") == "category", F.lower("segment_value")).otherwise(F.col("segment_value"))
        .alias("_v"), *OUT)
    return r.join(lists, ["segment_type", "_v"]).select(key, F.col("segment_type").alias("level"), *OUT)


def recommend_serving(requests: DataFrame, top: DataFrame, n: int = 10, key: str = "customer_unique_id") -> DataFrame:
    """R8, the serving variant: state matches ``segment_value`` exactly in any
    segment; category matches the *product's* category in any segment; the
    fallback is the whole table; each level is ordered by total_orders desc
    (ties -> product_id), a product appears once. Lists are ranked once for each
    different (state, category), written, then joined to the requests."""
    gap = F.lit("\u0000")
    context = F.concat(F.coalesce("state", gap), F.lit("\u0001"), F.coalesce("category", gap)).alias("_ctx")
    own = requests.select(key, "state", "category", context)
    lists = cut(_serving_lists(cut(own.select("_ctx", "state", "category").distinct()), top, n, "_ctx"))
    return own.select(key, "_ctx").distinct().join(lists, "_ctx").drop("_ctx")


def _serving_lists(requests: DataFrame, top: DataFrame, n: int, key: str) -> DataFrame:
    prod = top.select("segment_value", "product_id", "product_category_name_english", "total_orders")
    r = requests.select(key, "state", "category")
    by_state = r.join(prod, r["state"] == prod["segment_value"]).select(key, "product_id", "total_orders",
                                                                     F.lit(1).alias("_lvl"))
    by_cat = r.join(prod, r["category"] == prod["product_category_name_english"]).select(
        key, "product_id", "total_orders", F.lit(2).alias("_lvl"))
    glob = prod.select("product_id", "total_orders").distinct()
    cand = by_state.unionByName(by_cat).groupBy(key, "_lvl", "product_id").agg(F.max("total_orders").alias("total_orders"))
    # the first level that has products comes first, so its rows hold the ranks 1 ..; the rest goes
    best = top_n_per_group(cand, [key], [F.col("_lvl"), F.col("total_orders").desc_nulls_last(), F.col("product_id")], n)
    ranked = cut(best.withColumn("_best", F.min("_lvl").over(Window.partitionBy(key))).where("_lvl = _best").drop("_best"))
    have = ranked.select(key).distinct()
    g = top_n_per_group(glob.withColumn("_one", F.lit(1)), ["_one"],
                        [F.col("total_orders").desc_nulls_last(), F.col("product_id")], n)
    # the global list has exactly n rows: attach it by a constant key
    fallback = (r.select(key).distinct().join(have, key, "left_anti").withColumn("_one", F.lit(1))
                .join(F.broadcast(g.select("_one", "product_id", "total_orders", "rank")), "_one"))
    labels = F.when(F.col("_lvl") == 1, "state").otherwise("category")
    return (ranked.select(key, labels.alias("level"), F.col("rank").cast("bigint").alias("rank"), "product_id")
            .unionByName(fallback.select(key, F.lit("global").alias("level"), F.col("rank").cast("bigint").alias("rank"),
                                         "product_id")))
