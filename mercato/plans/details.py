"""Gold detail tables.

Like the reference, these read the *bronze* base tables (parameterised:
pass any layer with the same table names) plus two gold tables. Geographic
means are exact fixed-point (micro-degree) means, so results do not depend
on summation order; distances are reported to 1e-6 km.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import fixed_point, floor_days_between, haversine_km, np_round, safe_ratio
from mercato.operators import top1_by_count, with_global


def zfill(c, width: int = 5) -> Column:
    """pandas ``str.zfill``: left-pad with zeros, never truncate."""
    col = F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def _micro_mean(c: str) -> Column:
    return F.try_divide(F.sum(fixed_point(c, 6)), F.count(c)) / F.lit(1e6)


# ---------------------------------------------------------------- H1 / H2
def zip_geo(geo: DataFrame) -> DataFrame:
    """H1: one row per zip prefix: mean lat/lng, most frequent city and
    state (ties -> smallest; all null -> null)."""
    z = "geolocation_zip_code_prefix"
    g = geo.withColumn(z, zfill(z))
    means = g.groupBy(z).agg(_micro_mean("geolocation_lat").alias("geolocation_lat"),
                             _micro_mean("geolocation_lng").alias("geolocation_lng"))
    city = top1_by_count(g, z, "geolocation_city")
    state = top1_by_count(g, z, "geolocation_state")
    return means.join(city, z, "left").join(state, z, "left").select(
        z, "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")


def zip_counts(geo: DataFrame) -> DataFrame:
    """Rows per zip prefix, with the number of distinct prefixes and
    total rows on every row."""
    z = "geolocation_zip_code_prefix"
    counts = geo.where(F.col(z).isNotNull()).groupBy(z).agg(F.count(F.lit(1)).alias("count"))
    totals = geo.agg(F.count_distinct(z).alias("unique_zip_prefixes"), F.count(F.lit(1)).alias("total_records"))
    return with_global(counts, totals)


def zip_inconsistent(geo: DataFrame) -> DataFrame:
    """H2b (A4): prefixes whose lat, lng, city or state take more than one
    value."""
    z = "geolocation_zip_code_prefix"
    g = geo.withColumn(z, zfill(z))
    cols = ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]
    agg = g.groupBy(z).agg(*[F.count_distinct(c).alias(c) for c in cols])
    cond = None
    for c in cols:
        cond = (F.col(c) > 1) if cond is None else cond | (F.col(c) > 1)
    return agg.where(cond)


# ---------------------------------------------------------------- H3-H5
def delivery(layer: dict[str, DataFrame], geo: DataFrame | None = None) -> DataFrame:
    """H3: orders + buyer zip + one row per item (seller, seller zip) + both
    coordinates; carrier->customer whole days and haversine km."""
    zg = geo if geo is not None else zip_geo(layer["geolocation"])
    cgeo = zg.select(F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
                     F.col("geolocation_lat").alias("customer_lat"), F.col("geolocation_lng").alias("customer_lng"))
    sgeo = zg.select(F.col("geolocation_zip_code_prefix").alias("seller_zip_code_prefix"),
                     F.col("geolocation_lat").alias("seller_lat"), F.col("geolocation_lng").alias("seller_lng"))
    cust = layer["customers"].select("customer_id", zfill("customer_zip_code_prefix").alias("customer_zip_code_prefix"))
    sell = layer["sellers"].select("seller_id", zfill("seller_zip_code_prefix").alias("seller_zip_code_prefix"))
    items = layer["order_items"].select("order_id", "seller_id")
    df = (layer["orders"].join(cust, "customer_id", "left").join(items, "order_id", "left")
          .join(sell, "seller_id", "left").join(cgeo, "customer_zip_code_prefix", "left")
          .join(sgeo, "seller_zip_code_prefix", "left"))
    df = df.withColumn("delivery_time_days",
                       floor_days_between("order_delivered_carrier_date", "order_delivered_customer_date"))
    df = df.withColumn("distance_km", np_round(haversine_km("seller_lat", "seller_lng", "customer_lat", "customer_lng"), 6))
    base = [c for c in layer["orders"].columns]
    return df.select(*base, "customer_zip_code_prefix", "seller_id", "seller_zip_code_prefix", "customer_lat",
                     "customer_lng", "seller_lat", "seller_lng", "delivery_time_days", "distance_km")


def distance_time_corr(delivery_df: DataFrame, max_km: float = 3000, max_days: int = 60) -> DataFrame:
    """H4 (A10): Pearson correlation of distance and days, all rows and the
    ``< max_km & < max_days`` subset (pairwise nulls dropped)."""
    d, t = F.col("distance_km"), F.col("delivery_time_days").cast("double")
    keep = (d < max_km) & (t < max_days)
    return delivery_df.agg(np_round(F.corr(d, t), 6).alias("corr_all"),
                           np_round(F.corr(F.when(keep, d), F.when(keep, t)), 6).alias("corr_filtered"))


def density_grid(delivery_df: DataFrame, grid: int = 50, max_km: float | None = None,
                 max_days: float | None = None) -> DataFrame:
    """H5 (A14): rectangular ``grid x grid`` density of distance x days over
    all rows with both values (T20); optional bounds filter. Non-empty cells
    only (mincnt=1)."""
    x, y = F.col("distance_km"), F.col("delivery_time_days").cast("double")
    df = delivery_df.where(x.isNotNull() & y.isNotNull())
    if max_km is not None:
        df = df.where(x < max_km)
    if max_days is not None:
        df = df.where(y < max_days)
    df = df.select(x.alias("x"), y.alias("y"))
    stats = df.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    g = float(grid)

    def cell(v, lo, hi):
        return F.when(F.col(hi) == F.col(lo), F.lit(0)).otherwise(
            F.least(F.floor((F.col(v) - F.col(lo)) / ((F.col(hi) - F.col(lo)) / F.lit(g))), F.lit(grid - 1))).cast("int")

    return (with_global(df, stats).select(cell("x", "x0", "x1").alias("cell_x"), cell("y", "y0", "y1").alias("cell_y"))
            .groupBy("cell_x", "cell_y").agg(F.count(F.lit(1)).alias("count")))


def hexbin(delivery_df: DataFrame, gridsize: int = 50, max_km: float | None = None,
           max_days: float | None = None) -> DataFrame:
    """H5 (A14) as the reference plots it: counts in the cells of a hexagonal
    lattice of ``gridsize`` columns over the range of distance x days, and
    ``floor(gridsize / sqrt 3)`` rows; non-empty cells only.

    The centres of regular hexagons form two rectangular lattices, one shifted
    by half a step both ways (``lattice`` 1 and 2); a point belongs to the nearer of its
    nearest centres in the two, with vertical steps sqrt 3 times the horizontal
    ones. At equal distances it belongs to lattice 2; a coordinate half-way
    between two centres of lattice 1 counts to the even one. A constant coordinate is column or row 0."""
    x, y = F.col("distance_km"), F.col("delivery_time_days").cast("double")
    df = delivery_df.where(x.isNotNull() & y.isNotNull())
    if max_km is not None:
        df = df.where(x < max_km)
    if max_days is not None:
        df = df.where(y < max_days)
    df = df.select(x.alias("x"), y.alias("y"))
    rows = math.floor(gridsize / math.sqrt(3))
    stats = df.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    stats = stats.select("x0", "y0", ((F.col("x1") - F.col("x0")) / float(gridsize)).alias("sx"),
                         ((F.col("y1") - F.col("y0")) / float(rows)).alias("sy"))
    u = F.when(F.col("sx") > 0, (F.col("x") - F.col("x0")) / F.col("sx")).otherwise(0.0)
    v = F.when(F.col("sy") > 0, (F.col("y") - F.col("y0")) / F.col("sy")).otherwise(0.0)
    d = with_global(df, stats).withColumn("u", u).withColumn("v", v)
    near = lambda du, dv: du * du + 3.0 * (dv * dv)
    one = near(F.col("u") - F.rint("u"), F.col("v") - F.rint("v"))
    two = near(F.col("u") - F.floor("u") - 0.5, F.col("v") - F.floor("v") - 0.5)
    first = one < two
    cells = d.select("x0", "y0", "sx", "sy", F.when(first, 1).otherwise(2).alias("lattice"),
                     F.when(first, F.rint("u")).otherwise(F.floor("u")).cast("int").alias("col"),
                     F.when(first, F.rint("v")).otherwise(F.floor("v")).cast("int").alias("row"))
    shift = (F.col("lattice") - 1) * 0.5
    return (cells.groupBy("lattice", "col", "row", "x0", "y0", "sx", "sy").agg(F.count(F.lit(1)).alias("count"))
            .select("lattice", "col", "row", np_round(F.col("x0") + (F.col("col") + shift) * F.col("sx"), 6).alias("center_km"),
                    np_round(F.col("y0") + (F.col("row") + shift) * F.col("sy"), 6).alias("center_days"), "count"))


# ---------------------------------------------------------------- H6
def _review_sums(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.sum("review_score").alias("_rs"), F.count("review_score").alias("_rn"))


def sellers_details(layer: dict[str, DataFrame]) -> DataFrame:
    """H6: per seller: most sold product and its count, mean review over
    item x review rows, most sold category (ties -> smallest)."""
    items = layer["order_items"]
    top = top1_by_count(items, "seller_id", "product_id", "specialized_product", "times_sold")
    rev = (items.select("order_id", "seller_id").join(_review_sums(layer["reviews"]), "order_id", "left")
           .where(F.col("seller_id").isNotNull()).groupBy("seller_id")
           .agg(F.try_divide(F.sum("_rs"), F.sum("_rn")).alias("average_review_score")))
    cats = items.select("seller_id", "product_id").join(
        layer["products"].select("product_id", "product_category_name"), "product_id", "left")
    top_cat = top1_by_count(cats, "seller_id", "product_category_name", "specialized_category")
    return (top.join(rev, "seller_id", "left").join(top_cat, "seller_id", "left")
            .select("seller_id", "specialized_product", "times_sold", "average_review_score", "specialized_category"))


# ---------------------------------------------------------------- H7
def customer_details(layer: dict[str, DataFrame], profile: DataFrame, delivery_df: DataFrame) -> DataFrame:
    """H7: customer profile + distinct sellers bought from (0 if none) +
    mean delivery distance over item rows (T11)."""
    person = layer["orders"].select("order_id", "customer_id").join(
        layer["customers"].select("customer_id", "customer_unique_id"), "customer_id", "left")
    sellers = (person.join(layer["order_items"].select("order_id", "seller_id"), "order_id", "left")
               .groupBy("customer_unique_id").agg(F.count_distinct("seller_id").alias("total_sellers")))
    dist = (person.join(delivery_df.select("order_id", "distance_km"), "order_id", "left")
            .groupBy("customer_unique_id")
            .agg(F.try_divide(F.sum(fixed_point("distance_km", 6)), F.count("distance_km") * F.lit(1e6))
                 .alias("avg_delivery_distance")))
    return (profile.join(sellers, "customer_unique_id", "left")
            .withColumn("total_sellers", F.coalesce("total_sellers", F.lit(0)).cast("int"))
            .join(dist, "customer_unique_id", "left"))


# ---------------------------------------------------------------- H8-H10
def product_repeat(layer: dict[str, DataFrame]) -> DataFrame:
    """H8 (A3, A7, F10): distinct orders per (product, person); repeat
    buyers (>= 2), one-time buyers (= 1), ratio with inf/NaN -> 0."""
    person = layer["orders"].select("order_id", "customer_id").join(
        layer["customers"].select("customer_id", "customer_unique_id"), "customer_id", "left")
    cpo = layer["order_items"].select("order_id", "product_id").join(person, "order_id", "left")
    per = (cpo.where(F.col("product_id").isNotNull() & F.col("customer_unique_id").isNotNull())
           .groupBy("product_id", "customer_unique_id").agg(F.count_distinct("order_id").alias("num_orders")))
    stats = per.groupBy("product_id").agg(F.count_if(F.col("num_orders") >= 2).alias("repeat_buyers"),
                                          F.count_if(F.col("num_orders") == 1).alias("one_time_buyers"))
    return stats.withColumn("repeat_product", safe_ratio("repeat_buyers", "one_time_buyers"))


def repeat_summary(repeat: DataFrame) -> DataFrame:
    """H9 (A15): products, repeatable products and share, mean ratio among
    repeatable products."""
    rep = F.col("repeat_buyers") > 0
    # one row a product: counting rows is counting products
    total, repeatable = F.count("product_id"), F.count_if(rep & F.col("product_id").isNotNull())
    return repeat.agg(
        total.alias("total_products"), repeatable.alias("repeatable_products"),
        (total - repeatable).alias("non_repeatable_products"),
        np_round(repeatable * 100.0 / total, 6).alias("repeatable_pct"),
        np_round(F.avg(F.when(rep, F.col("repeat_product"))), 6).alias("average_repeat_chance"))


def product_sellers(layer: dict[str, DataFrame]) -> DataFrame:
    """H10 (A3): distinct sellers per product."""
    return (layer["order_items"].where(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(F.count_distinct("seller_id").alias("total_sellers")))


def product_details(layer: dict[str, DataFrame], product_feats: DataFrame) -> DataFrame:
    """H8+H10: product features + repeat ratio (0 if none) + seller count (0 if none)."""
    return (product_feats.join(product_repeat(layer).select("product_id", "repeat_product"), "product_id", "left")
            .withColumn("repeat_product", F.coalesce("repeat_product", F.lit(0.0)))
            .join(product_sellers(layer), "product_id", "left")
            .withColumn("total_sellers", F.coalesce("total_sellers", F.lit(0)).cast("int")))


def multi_seller_summary(layer: dict[str, DataFrame]) -> DataFrame:
    """H10 (A15): products, products with more than one seller, share %."""
    ps = product_sellers(layer)
    multi = F.count_if(F.col("total_sellers") > 1)
    return ps.agg(F.count(F.lit(1)).alias("total_products"), multi.alias("multi_seller_products"),
                  np_round(multi * 100.0 / F.count(F.lit(1)), 6).alias("multi_seller_pct"))
