"""Content similarity over numeric and one-hot features.

A product's vector: its numeric features in standard deviations from the mean
(nulls stand at the mean, a constant feature at 0), in fixed point, and its
category as a one-hot part (null: a category of its own). The n most similar
other products by cosine come from the pivot index of ``operators.nearest``;
products with equal vectors are searched once and ties in similarity go to the
smaller product id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators import with_global
from mercato.operators.nearest import BLOCK, PIVOTS, SCALE, nearest
from mercato.plans.recommend.content import expand_twins
from mercato.plans.recommend.hybrid import label_codes

NUMERIC = ["avg_price", "avg_freight_value", "total_orders", "avg_review_score", "total_reviews", "positive_sentiment_ratio"]
ONE_HOT = ["product_category_name_english"]


def product_vectors(pf: DataFrame, numeric: list[str] = NUMERIC, one_hot: list[str] = ONE_HOT) -> DataFrame:
    """``(product_id, z array<bigint>, codes array<int>)``."""
    stats = pf.agg(*[F.avg(c).alias(f"_m_{c}") for c in numeric], *[F.stddev_pop(c).alias(f"_s_{c}") for c in numeric])
    place = lambda c: F.coalesce(F.floor(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) * SCALE + 0.5), F.lit(0))
    out = with_global(pf, stats).select("product_id", F.array(*[place(c).cast("bigint") for c in numeric]).alias("z"), *one_hot)
    for c in one_hot:
        codes = label_codes(pf, c).withColumnRenamed("value", f"_v_{c}").withColumnRenamed("code", f"_c_{c}")
        out = out.withColumn(f"_v_{c}", F.coalesce(F.col(c).cast("string"), F.lit("unknown"))).join(codes, f"_v_{c}")
    return out.select("product_id", "z", F.array(*[F.col(f"_c_{c}") for c in one_hot]).alias("codes"))


def similar_vectors(pf: DataFrame, n: int = 10, requests: DataFrame | None = None, numeric: list[str] = NUMERIC,
                    one_hot: list[str] = ONE_HOT, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``(product_id, rank, similar_product_id, similarity)`` for every
    product (or the ``product_id`` rows of ``requests``), similarity rounded to 4."""
    own = product_vectors(pf, numeric, one_hot).checkpoint()
    asked = own if requests is None else own.join(requests.select("product_id").distinct(), "product_id", "left_semi")
    # products with one vector are one entry, known by the smallest of their ids
    asks = asked.select("z", "codes").distinct().withColumn("_ask", F.lit(True))
    lead = (own.groupBy("z", "codes").agg(F.min("product_id").alias("lead")).join(asks, ["z", "codes"], "left")
            .select("lead", "z", "codes", F.coalesce("_ask", F.lit(False)).alias("ask")).checkpoint())
    twins = own.join(lead.select("z", "codes", "lead"), ["z", "codes"]).select("product_id", F.col("lead").alias("twin"))
    best = nearest(lead, "lead", n + 2, block, pivots).select(F.col("lead").alias("s1"), F.col("other").alias("s2"), "cos")
    return expand_twins(twins, best, n, requests)
