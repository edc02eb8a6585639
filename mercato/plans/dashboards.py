"""Dashboard and lookup queries (D1-D5), batch form of the reference's
HTTP endpoints: each takes DataFrames and returns the table the endpoint
would serialise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import PRICE_BANDS, exact_mean, fixed_point, np_round, price_band


def price_vs_rating(products: DataFrame) -> DataFrame:
    """D1 (F7, A1): products with both price and rating, count and mean
    rating (2 decimals) per observed left-closed price band."""
    spark = products.sparkSession
    order = spark.createDataFrame([(lbl, i) for i, (_, _, lbl) in enumerate(PRICE_BANDS)],
                                  "price_band string, band_order int")
    p = products.where(F.col("avg_price").isNotNull() & F.col("avg_review_score").isNotNull()) \
        .withColumn("price_band", price_band("avg_price")).where(F.col("price_band").isNotNull())
    agg = p.groupBy("price_band").agg(F.count(F.lit(1)).alias("total_products"),
                                      np_round(exact_mean("avg_review_score", 4), 2).alias("avg_rating"))
    return agg.join(F.broadcast(order), "price_band")


def top_categories(products: DataFrame, n: int = 10) -> DataFrame:
    """D2 (A1, W7): categories by Σ total_orders, unweighted mean rating."""
    agg = (products.where(F.col("product_category_name_english").isNotNull())
           .groupBy("product_category_name_english")
           .agg(F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
                np_round(exact_mean("avg_review_score", 4), 2).alias("avg_rating")))
    from mercato.plans.explore import _rank
    return _rank(agg, [F.col("total_orders").desc(), F.col("product_category_name_english")], n)


def by_state(profile: DataFrame) -> DataFrame:
    """D3 (A1): customers, Σ orders and mean spend per state."""
    return (profile.where(F.col("customer_state").isNotNull()).groupBy("customer_state")
            .agg(F.count("customer_unique_id").alias("total_customers"),
                 F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
                 np_round(exact_mean("total_spent", 4), 2).alias("avg_spent")))


# Display labels of payment methods.
PAYMENT_LABELS = {"credit_card": "Cartão de Crédito", "boleto": "Boleto", "voucher": "Voucher",
                  "debit_card": "Cartão de Débito"}


def by_payment(payments: DataFrame) -> DataFrame:
    """D4 (P12, A1, J8): transactions and value per payment type (null-safe
    ``not_defined`` filter), display label with fallback to the type."""
    spark = payments.sparkSession
    labels = spark.createDataFrame(list(PAYMENT_LABELS.items()), "payment_type string, label string")
    agg = (payments.where(~F.col("payment_type").eqNullSafe("not_defined") & F.col("payment_type").isNotNull())
           .groupBy("payment_type")
           .agg(F.count("payment_type").alias("total_transactions"),
                np_round(F.sum(fixed_point("payment_value", 4)) / F.lit(1e4), 2).alias("total_value")))
    return (agg.join(F.broadcast(labels), "payment_type", "left")
            .withColumn("label", F.coalesce("label", "payment_type")))


def product_detail(requests: DataFrame, product_details: DataFrame) -> DataFrame:
    """Detail rows for requested product ids; absent ids give no row."""
    return product_details.join(requests.select("product_id").distinct(), "product_id", "left_semi")
