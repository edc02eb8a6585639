"""Exploration queries (E1-E17): the tables behind the reference's
charts. Silver-based ones take the silver layer; E12-E17 take gold tables.
Sorted outputs expose a ``rank`` with a total tie-break; top-k uses
``orderBy().limit(k)`` (TakeOrderedAndProject: k rows per partition)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import (cents_sum, clip, floor_days_between, hours_between, month_bucket, np_round,
                               strip_accents)
from mercato.operators import describe, histogram, quantiles, top_n_per_group, value_counts, with_global  # noqa: F401


def _rank(df: DataFrame, order: list[Column], limit: int | None = None) -> DataFrame:
    """Rank rows of a small, already aggregated frame (bounded by its group
    count); with ``limit`` only the top rows are kept."""
    if limit is not None:
        df = df.orderBy(*order).limit(limit)
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def _sales(layer) -> DataFrame:
    """Items inner orders inner customers."""
    return (layer["order_items"].join(layer["orders"].select("order_id", "customer_id"), "order_id")
            .join(layer["customers"].select("customer_id", "customer_state"), "customer_id"))


def revenue_by_state(layer) -> DataFrame:
    """Σ price per buyer state, ranked."""
    agg = (_sales(layer).where(F.col("customer_state").isNotNull()).groupBy("customer_state")
           .agg(cents_sum("price").alias("revenue")))
    return _rank(agg, [F.col("revenue").desc(), F.col("customer_state")])


def order_status(layer) -> DataFrame:
    """Order-status distribution with share %."""
    return value_counts(layer["orders"], "order_status")


def _real_days(orders: DataFrame) -> Column:
    return floor_days_between("order_purchase_timestamp", "order_delivered_customer_date")


def delivery_days_by_state(layer) -> DataFrame:
    """Mean whole delivery days per buyer state (delivered orders)."""
    o = layer["orders"].withColumn("real_days", _real_days(layer["orders"])).where(F.col("real_days").isNotNull())
    agg = (o.join(layer["customers"].select("customer_id", "customer_state"), "customer_id")
           .where(F.col("customer_state").isNotNull()).groupBy("customer_state")
           .agg(F.avg("real_days").alias("avg_delivery_days")))
    return _rank(agg.withColumn("avg_delivery_days", np_round("avg_delivery_days", 6)),
                 [F.col("avg_delivery_days").desc(), F.col("customer_state")])


def late_days_histogram(layer, bins: int = 50) -> DataFrame:
    """Histogram of positive delay days."""
    d = layer["orders"].select(floor_days_between("order_estimated_delivery_date", "order_delivered_customer_date")
                               .alias("delivery_delay_days")).where(F.col("delivery_delay_days") > 0)
    return histogram(d, "delivery_delay_days", bins)


def estimated_vs_real(layer) -> DataFrame:
    """E5: per delivered order, estimated and real whole days, late flag,
    plus the shared axis maximum."""
    o = layer["orders"].select(
        "order_id", "is_late",
        floor_days_between("order_purchase_timestamp", "order_delivered_customer_date").alias("real_days"),
        floor_days_between("order_purchase_timestamp", "order_estimated_delivery_date").alias("estimated_days"),
    ).where(F.col("real_days").isNotNull() & F.col("estimated_days").isNotNull())
    axis = o.agg(F.greatest(F.max("estimated_days"), F.max("real_days")).alias("axis_max"))
    return with_global(o, axis)


def late_rate_by_state(layer, min_orders: int = 100, top: int = 5) -> DataFrame:
    """Late rate % per state among states with > min_orders, top 5."""
    both = (floor_days_between("order_purchase_timestamp", "order_delivered_customer_date").isNotNull()
            & floor_days_between("order_purchase_timestamp", "order_estimated_delivery_date").isNotNull())
    o = layer["orders"].where(both).select("customer_id", "is_late").join(
        layer["customers"].select("customer_id", "customer_state"), "customer_id")
    agg = (o.where(F.col("customer_state").isNotNull()).groupBy("customer_state")
           .agg(F.count("is_late").alias("total_orders"), F.count_if(F.col("is_late")).alias("total_late"))
           .where(F.col("total_orders") > min_orders)
           .withColumn("late_rate_pct", np_round(F.col("total_late") * 100.0 / F.col("total_orders"), 6)))
    return _rank(agg, [F.col("late_rate_pct").desc(), F.col("customer_state")], top)


# Weekday names and their Portuguese labels, Monday first.
WEEKDAYS = [("Monday", "Segunda"), ("Tuesday", "Terça"), ("Wednesday", "Quarta"), ("Thursday", "Quinta"),
            ("Friday", "Sexta"), ("Saturday", "Sábado"), ("Sunday", "Domingo")]


def purchases_by_weekday(layer) -> DataFrame:
    """E7 (W8): purchases per weekday in fixed Monday..Sunday order; days
    without purchases stay null. The 7-row calendar is broadcast."""
    spark = layer["orders"].sparkSession
    cal = spark.createDataFrame([(i, en, pt) for i, (en, pt) in enumerate(WEEKDAYS)],
                                "weekday_index int, weekday string, weekday_label string")
    counts = (layer["orders"].where(F.col("order_purchase_timestamp").isNotNull())
              .groupBy(F.weekday("order_purchase_timestamp").alias("weekday_index"))
              .agg(F.count(F.lit(1)).alias("purchases")))
    return F.broadcast(cal).join(counts, "weekday_index", "left").select(
        "weekday_index", "weekday", "weekday_label", "purchases")


def late_pct_by_month(layer) -> DataFrame:
    """Late % per purchase month."""
    return (layer["orders"].groupBy(month_bucket("order_purchase_timestamp").alias("month"))
            .agg(np_round(F.avg(F.col("is_late").cast("int")) * 100.0, 6).alias("late_pct")))


def approval_outliers(layer, fence: float = 1.5) -> DataFrame:
    """E9 (A9): approval hours; IQR fences (``fence`` times) over all orders; per approval
    month with outliers: outlier/regular counts, outlier/regular ratio %
    (denominator regular rows; null when none) and the outliers' box
    statistics."""
    o = layer["orders"].select(
        hours_between("order_purchase_timestamp", "order_approved_at").alias("h"),
        month_bucket("order_approved_at").alias("month_year"))
    q = quantiles(o, {"q1": ("h", 0.25), "q3": ("h", 0.75)})
    q = q.select((F.col("q1") - fence * (F.col("q3") - F.col("q1"))).alias("lo"),
                 (F.col("q3") + fence * (F.col("q3") - F.col("q1"))).alias("hi"))
    t = with_global(o.where(F.col("h").isNotNull()), q)
    out = (F.col("h") < F.col("lo")) | (F.col("h") > F.col("hi"))
    reg = (F.col("h") >= F.col("lo")) & (F.col("h") <= F.col("hi"))
    oh = F.when(out, F.col("h"))
    agg = t.groupBy("month_year").agg(
        F.count_if(out).alias("outliers"), F.count_if(reg).alias("regulars"),
        F.min(oh).alias("out_min"), F.max(oh).alias("out_max"))
    box = quantiles(t.where(out), {"out_q1": ("h", 0.25), "out_median": ("h", 0.5), "out_q3": ("h", 0.75)}, ["month_year"])
    agg = agg.join(box.withColumnRenamed("month_year", "_m"), F.col("month_year").eqNullSafe(F.col("_m"))).drop("_m")
    agg = agg.where(F.col("outliers") > 0).withColumn(
        "outlier_ratio_pct", np_round(F.try_divide(F.col("outliers") * 100.0, F.col("regulars").cast("double")), 6))
    for c in ("out_min", "out_q1", "out_median", "out_q3", "out_max"):
        agg = agg.withColumn(c, np_round(c, 6))
    return agg


def days_to_arrive(layer, cap: int = 50) -> DataFrame:
    """E10 (P15, A12): approval->delivery whole days clipped to 0..cap,
    counts per value."""
    d = layer["orders"].select(clip(floor_days_between("order_approved_at", "order_delivered_customer_date"),
                                    0, cap).alias("days_capped"))
    return d.where(F.col("days_capped").isNotNull()).groupBy("days_capped").agg(F.count(F.lit(1)).alias("count"))


def undelivered(layer) -> DataFrame:
    """E10 (A15): orders, orders never delivered after approval, share %."""
    d = floor_days_between("order_approved_at", "order_delivered_customer_date")
    return layer["orders"].agg(
        F.count(F.lit(1)).alias("total_orders"), F.count_if(d.isNull()).alias("undelivered"),
        np_round(F.count_if(d.isNull()) * 100.0 / F.count(F.lit(1)), 6).alias("undelivered_pct"))


# State capitals (accent-free, lower case).
CAPITALS = {
    "AC": "rio branco", "AL": "maceio", "AP": "macapa", "AM": "manaus", "BA": "salvador", "CE": "fortaleza",
    "DF": "brasilia", "ES": "vitoria", "GO": "goiania", "MA": "sao luis", "MT": "cuiaba", "MS": "campo grande",
    "MG": "belo horizonte", "PA": "belem", "PB": "joao pessoa", "PR": "curitiba", "PE": "recife",
    "PI": "teresina", "RJ": "rio de janeiro", "RN": "natal", "RS": "porto alegre", "RO": "porto velho",
    "RR": "boa vista", "SC": "florianopolis", "SP": "sao paulo", "SE": "aracaju", "TO": "palmas",
}


def capital_share(layer, capitals: DataFrame | None = None) -> DataFrame:
    """E11 (F6, F12): Capital vs Interior share of geolocation rows.
    ``capitals`` (geolocation_state, capital) replaces the fixed list."""
    spark = layer["geolocation"].sparkSession
    if capitals is None:
        capitals = F.broadcast(spark.createDataFrame(list(CAPITALS.items()), "geolocation_state string, capital string"))
    g = layer["geolocation"].join(capitals, "geolocation_state", "left")
    kind = F.when(F.col("capital") == strip_accents("geolocation_city"), "Capital").otherwise("Interior")
    return value_counts(g.select(kind.alias("location")), "location")


# ---------------------------------------------------------------- gold-based
def interaction_stats(inter: DataFrame) -> DataFrame:
    """E12 (A11, A15): describe(implicit_score), unique users/products,
    reviews present and share."""
    d = describe(inter, "implicit_score")
    extra = inter.agg(F.count_distinct("customer_unique_id").alias("unique_users"),
                      F.count_distinct("product_id").alias("unique_products"),
                      F.count("review_score").alias("reviews_present"),
                      np_round(F.count("review_score") * 100.0 / F.count(F.lit(1)), 6).alias("reviews_pct"))
    out = with_global(d, extra)
    for c in ("mean", "std", "min", "p25", "p50", "p75", "max"):
        out = out.withColumn(c, np_round(c, 6))
    return out


def sentiment_mix(inter: DataFrame) -> DataFrame:
    """E12 (A12)."""
    return value_counts(inter, "sentiment")


def top_counts(df: DataFrame, c: str, n: int) -> DataFrame:
    """A12 + W7: the n most frequent values (ties -> smallest value)."""
    vc = value_counts(df, c, share=False)
    return _rank(vc, [F.col("count").desc(), F.col(c)], n)


def product_stats(pf: DataFrame) -> DataFrame:
    """E13 (A15): products, categories, mean price, mean review."""
    from mercato.functions import exact_mean
    return pf.agg(F.count(F.lit(1)).alias("products"),
                  F.count_distinct("product_category_name_english").alias("categories"),
                  np_round(exact_mean("avg_price", 4), 6).alias("mean_price"),
                  np_round(exact_mean("avg_review_score", 4), 6).alias("mean_review"))


def clipped_price_histogram(pf: DataFrame, q: float = 0.95, bins: int = 40) -> DataFrame:
    """E13 (A9, P15, A13): p95-clipped average price histogram."""
    p = quantiles(pf, {"_q": ("avg_price", q)}).select(np_round("_q", 6).alias("_p"))
    clipped = with_global(pf, p).select(
        F.when(F.col("avg_price").isNull(), None).otherwise(F.least("avg_price", "_p")).alias("avg_price"))
    return histogram(clipped, "avg_price", bins)


def top_products(pf: DataFrame, n: int = 10) -> DataFrame:
    """E13 (W7, F9): top products by total_orders, short id label."""
    t = pf.where(F.col("total_orders").isNotNull()).select(
        "product_id", "product_category_name_english", "total_orders", "avg_review_score", "avg_price")
    t = _rank(t, [F.col("total_orders").desc(), F.col("product_id")], n)
    return t.withColumn("product_id_short", F.concat(F.substring(F.col("product_id").cast("string"), 1, 8), F.lit("...")))


def customer_stats(profile: DataFrame) -> DataFrame:
    """E14 (A15): customers, states, mean spend."""
    from mercato.functions import exact_mean
    return profile.agg(F.count(F.lit(1)).alias("customers"), F.count_distinct("customer_state").alias("states"),
                       np_round(exact_mean("total_spent", 4), 6).alias("mean_spent"))


def affinity_stats(aff: DataFrame) -> DataFrame:
    """E15 (A15): pairs, categories, affinity range."""
    return aff.agg(F.count(F.lit(1)).alias("pairs"),
                   F.count_distinct("product_category_name_english").alias("categories"),
                   F.min("affinity_score").alias("min_affinity"), F.max("affinity_score").alias("max_affinity"))


def top_affinity_categories(aff: DataFrame, n: int = 10) -> DataFrame:
    """E15 (A1, W7): categories by mean affinity."""
    from mercato.functions import exact_mean
    agg = aff.groupBy("product_category_name_english").agg(
        np_round(exact_mean("affinity_score", 4), 6).alias("mean_affinity"))
    return _rank(agg, [F.col("mean_affinity").desc(), F.col("product_category_name_english")], n)


def top_cooccurrence(cooc: DataFrame, n: int = 10) -> DataFrame:
    """E16 (W7, F9): top pairs by Jaccard, short ids."""
    t = _rank(cooc, [F.col("cooccurrence_score").desc(), F.col("cooccurrence_count").desc(),
                     F.col("product_id_a"), F.col("product_id_b")], n)
    short = lambda c: F.concat(F.substring(F.col(c).cast("string"), 1, 8), F.lit("..."))
    return t.withColumn("product_id_a_short", short("product_id_a")).withColumn("product_id_b_short", short("product_id_b"))


def cooccurrence_count_histogram(cooc: DataFrame, cap: int = 20, bins: int = 20) -> DataFrame:
    """E16 (P15, A13): count histogram clipped at ``cap``."""
    c = cooc.select(clip("cooccurrence_count", upper=cap).alias("cooccurrence_count"))
    return histogram(c, "cooccurrence_count", bins)


def segment_samples(top: DataFrame, segments: int = 3, n: int = 5) -> DataFrame:
    """E17 (A17, W2): the first ``segments`` segment values of each type and
    their ``n`` best products, and the product ranked first overall."""
    names = top.select("segment_type", "segment_value").distinct()
    some = top_n_per_group(names, ["segment_type"], [F.col("segment_value").asc()], segments, "_s").drop("_s")
    rows = top.join(some, ["segment_type", "segment_value"]).where(F.col("rank") <= n).select(
        "segment_type", "segment_value", F.col("rank").cast("bigint").alias("rank"), "product_id", "total_orders")
    lead = top.where(F.col("total_orders").isNotNull()).groupBy().agg(F.max("total_orders").alias("m"))
    first = (top.join(F.broadcast(lead), F.col("total_orders") == F.col("m")).agg(F.min("product_id").alias("product_id"),
                                                                                  F.max("m").alias("total_orders")))
    return rows.unionByName(first.select(F.lit("best").alias("segment_type"), F.lit("all").alias("segment_value"),
                                         F.lit(1).cast("bigint").alias("rank"), "product_id", "total_orders"))


def segment_coverage(top: DataFrame) -> DataFrame:
    """E17 (A3): distinct segment values per segment type."""
    return top.groupBy("segment_type").agg(F.count_distinct("segment_value").alias("segments"))
