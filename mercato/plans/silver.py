"""Bronze -> silver cleaning, one function per table.

Order of steps follows the reference job by job (it matters: e.g. the
freight median is taken after the price filter, the installment median over
the rows that survive the payment filters). "Keep first" needs a total
order Spark does not get from files (T7); each table documents its own.
Global statistics (medians, p99.9) are one-row aggregates broadcast back; the
deduplicated rows they are taken of, and the one row, are written once (``cut``), so no
use of a table repeats its keep-first and its statistics.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import (SENTIMENT_LABELS, blank_to_null, clip, floor_days_between, norm_city,
                               norm_state, norm_zip, np_round, sentiment_of, strip, to_num, to_ts)
from mercato.operators import keep_first, quantiles, with_global
from mercato.session import cut


def _str_cols(df: DataFrame, names) -> list[str]:
    types = dict(df.dtypes)
    return [c for c in names if c in types and types[c] == "string"]


def _blank_to_null(df: DataFrame, names) -> DataFrame:
    for c in _str_cols(df, names):
        df = df.withColumn(c, blank_to_null(c))
    return df


def clean_customers(df: DataFrame) -> DataFrame:
    """B1. Keep-first order: customer_id, then the other columns."""
    df = (df.withColumn("customer_city", norm_city("customer_city"))
            .withColumn("customer_state", norm_state("customer_state"))
            .withColumn("customer_zip_code_prefix", norm_zip("customer_zip_code_prefix")))
    df = _blank_to_null(df, ["customer_unique_id", "customer_city", "customer_state"])
    df = df.dropna(subset=["customer_id", "customer_unique_id"])
    return keep_first(df, ["customer_id"])


def clean_sellers(df: DataFrame) -> DataFrame:
    """B2."""
    df = (df.withColumn("seller_city", norm_city("seller_city"))
            .withColumn("seller_state", norm_state("seller_state"))
            .withColumn("seller_zip_code_prefix", norm_zip("seller_zip_code_prefix")))
    df = _blank_to_null(df, ["seller_city", "seller_state"])
    df = df.dropna(subset=["seller_id"])
    return keep_first(df, ["seller_id"])


UNKNOWN_CATEGORY = ("desconhecida", "unknown")


def clean_translation(df: DataFrame) -> DataFrame:
    """lower/trim both names, dedupe, guarantee the unknown row."""
    df = df.select(F.lower(strip("product_category_name")).alias("product_category_name"),
                   F.lower(strip("product_category_name_english")).alias("product_category_name_english"))
    df = df.dropna(subset=["product_category_name", "product_category_name_english"])
    df = keep_first(df, ["product_category_name"])
    extra = df.sparkSession.createDataFrame([UNKNOWN_CATEGORY], df.schema)
    return df.unionByName(extra.join(df, "product_category_name", "left_anti"))


PRODUCT_NUMERIC = ["product_name_lenght", "product_description_lenght", "product_photos_qty",
                   "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
PRODUCT_DIMS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def clean_products(df: DataFrame) -> DataFrame:
    """Category null -> 'desconhecida'; dimension medians *before* the
    range filter, length medians *after* it; numpy rounding to 2."""
    cat = F.lower(strip("product_category_name"))
    df = df.withColumn("product_category_name",
                       F.when(F.col("product_category_name").isNull() | (cat == "nan"), F.lit(UNKNOWN_CATEGORY[0]))
                       .otherwise(cat))
    df = keep_first(df, ["product_id"])
    for c in PRODUCT_NUMERIC:
        df = df.withColumn(c, to_num(c))
    df = cut(df)
    med = cut(quantiles(df, {f"_m_{c}": (c, 0.5) for c in PRODUCT_DIMS}))
    df = with_global(df, med)
    for c in PRODUCT_DIMS:
        df = df.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    df = df.drop(*[f"_m_{c}" for c in PRODUCT_DIMS])
    df = df.where((F.col("product_weight_g") > 0) & (F.col("product_weight_g") <= 30000)
                  & (F.col("product_length_cm") > 0) & (F.col("product_length_cm") <= 200)
                  & (F.col("product_height_cm") > 0) & (F.col("product_height_cm") <= 200)
                  & (F.col("product_width_cm") > 0) & (F.col("product_width_cm") <= 200))
    df = df.withColumn("product_photos_qty", F.coalesce("product_photos_qty", F.lit(0.0)))
    lens = ["product_name_lenght", "product_description_lenght"]
    med2 = cut(quantiles(df, {f"_m_{c}": (c, 0.5) for c in lens}))
    df = with_global(df, med2)
    for c in lens:
        df = df.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    df = df.drop(*[f"_m_{c}" for c in lens])
    for c in PRODUCT_NUMERIC:
        df = df.withColumn(c, np_round(c, 2))
    return df


ORDER_DATES = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"]


def clean_orders(df: DataFrame) -> DataFrame:
    """Floor-day durations (T1), delivery flags, approval filter."""
    df = keep_first(df, ["order_id"])
    for c in ORDER_DATES:
        if c in df.columns:
            df = df.withColumn(c, to_ts(c))
    df = df.dropna(subset=["order_id", "customer_id", "order_purchase_timestamp"])
    df = df.withColumn("order_status", F.lower(strip("order_status")))
    df = (df.withColumn("delivery_days", floor_days_between("order_purchase_timestamp", "order_delivered_customer_date"))
            .withColumn("delivery_delay_days",
                        floor_days_between("order_estimated_delivery_date", "order_delivered_customer_date"))
            .withColumn("is_delivered", F.col("order_delivered_customer_date").isNotNull())
            .withColumn("is_late", F.coalesce(F.col("delivery_delay_days") > 0, F.lit(False))))
    return df.where(F.col("order_approved_at").isNull()
                    | (F.col("order_approved_at") >= F.col("order_purchase_timestamp")))


ITEM_ORDER = ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]


def clean_order_items(df: DataFrame, outlier_quantile: float = 0.999) -> DataFrame:
    """Dedupe (keep-first by product, seller, shipping date, price,
    freight), null drop, price > 0, freight median fill + clip, total,
    p99.9 outlier drop, numpy rounding."""
    df = keep_first(df, ["order_id", "order_item_id"], ITEM_ORDER)
    df = (df.withColumn("price", to_num("price")).withColumn("freight_value", to_num("freight_value"))
            .withColumn("shipping_limit_date", to_ts("shipping_limit_date")))
    df = df.dropna(subset=["order_id", "order_item_id", "product_id", "seller_id", "price"])
    df = cut(df.where(F.col("price") > 0))
    # filling and clipping the freight removes no row: one set of statistics serves both
    df = with_global(df, cut(quantiles(df, {"_mf": ("freight_value", 0.5), "_p": ("price", outlier_quantile)})))
    df = df.withColumn("freight_value", clip(F.coalesce(F.col("freight_value"), F.col("_mf")), lower=0)).drop("_mf")
    df = df.withColumn("total_item_value", F.col("price") + F.col("freight_value"))
    df = df.withColumn("is_price_outlier", F.col("price") > F.col("_p")).drop("_p")
    df = df.where(~F.col("is_price_outlier"))
    for c in ("price", "freight_value", "total_item_value"):
        df = df.withColumn(c, np_round(c, 2))
    return df


def clean_payments(df: DataFrame) -> DataFrame:
    """Type filter (null-safe, P12), median over the remaining rows,
    clip >= 1, half-even rounding, dedupe last (keep-first by value)."""
    df = df.withColumn("payment_type", F.lower(strip("payment_type")))
    df = df.where(~F.col("payment_type").eqNullSafe("not_defined"))
    df = (df.withColumn("payment_sequential", to_num("payment_sequential", "int"))
            .withColumn("payment_installments", to_num("payment_installments"))
            .withColumn("payment_value", to_num("payment_value")))
    df = df.dropna(subset=["order_id", "payment_sequential", "payment_type", "payment_value"])
    df = df.where(F.col("payment_value") > 0)
    df = with_global(df, cut(quantiles(df, {"_mi": ("payment_installments", 0.5)})))
    inst = clip(F.coalesce(F.col("payment_installments"), F.col("_mi")), lower=1)
    df = df.withColumn("payment_installments", F.rint(inst).cast("int")).drop("_mi")
    df = keep_first(df, ["order_id", "payment_sequential"], ["payment_value"])
    return df.withColumn("payment_value", np_round("payment_value", 2))


def clean_reviews(df: DataFrame, legacy_has_comment: bool = False) -> DataFrame:
    """Dedupe review_id first (keep-first by order, creation date),
    score in 1..5, comment flag (T2), sentiment label (P17)."""
    df = keep_first(df, ["review_id"], ["order_id", "review_creation_date"])
    df = df.withColumn("review_score", to_num("review_score"))
    df = df.where(F.col("review_score").between(1, 5))
    for c in ("review_creation_date", "review_answer_timestamp"):
        if c in df.columns:
            df = df.withColumn(c, to_ts(c))
    msg = F.col("review_comment_message")
    if legacy_has_comment:
        has = msg.isNull() | (strip(msg) != "")
    else:
        has = msg.isNotNull() & (strip(msg) != "")
    return df.withColumn("has_comment", has).withColumn("sentiment", sentiment_of("review_score"))


# The latitude/longitude box of the country.
GEO_BOX = {"lat": (-33.8, 5.3), "lng": (-73.9, -34.7)}


def clean_geolocation(df: DataFrame) -> DataFrame:
    """Box filter, normalised text and zip; every row kept."""
    df = (df.withColumn("geolocation_lat", to_num("geolocation_lat"))
            .withColumn("geolocation_lng", to_num("geolocation_lng")))
    df = df.dropna(subset=["geolocation_lat", "geolocation_lng"])
    df = df.where(F.col("geolocation_lat").between(*GEO_BOX["lat"])
                  & F.col("geolocation_lng").between(*GEO_BOX["lng"]))
    df = (df.withColumn("geolocation_city", norm_city("geolocation_city"))
            .withColumn("geolocation_state", norm_state("geolocation_state"))
            .withColumn("geolocation_zip_code_prefix", norm_zip("geolocation_zip_code_prefix")))
    df = df.where(F.col("geolocation_zip_code_prefix").isNotNull())
    return (df.withColumn("geolocation_lat", np_round("geolocation_lat", 6))
              .withColumn("geolocation_lng", np_round("geolocation_lng", 6)))


CLEANERS = {
    "customers": clean_customers, "sellers": clean_sellers, "translation": clean_translation,
    "products": clean_products, "orders": clean_orders, "order_items": clean_order_items,
    "payments": clean_payments, "reviews": clean_reviews, "geolocation": clean_geolocation,
}


class Layer(Mapping):
    """Tables by name, each made when it is first asked for."""

    def __init__(self, make: dict):
        self._make, self._made = make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)


def build(bronze: dict[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The whole silver layer, lazily; a table without a cleaner is an error."""
    unknown = sorted(set(bronze) - set(CLEANERS))
    if unknown:
        raise ValueError(f"unknown bronze tables {unknown}; known are {sorted(CLEANERS)}")
    return Layer({name: (lambda name=name, df=df: CLEANERS[name](df)) for name, df in bronze.items()})


__all__ = ["build", "CLEANERS", "SENTIMENT_LABELS"] + [f.__name__ for f in CLEANERS.values()]
