"""Also-bought neighbours (R9): both directions of every co-occurrence
pair, top-n per product by Jaccard (ties -> count desc, product id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators import top_n_per_group


def also_bought(cooc: DataFrame, n: int = 10, requests: DataFrame | None = None) -> DataFrame:
    a = cooc.select(F.col("product_id_a").alias("product_id"), F.col("product_id_b").alias("other_product_id"),
                    F.col("category_b").alias("category"), "cooccurrence_score", "cooccurrence_count")
    b = cooc.select(F.col("product_id_b").alias("product_id"), F.col("product_id_a").alias("other_product_id"),
                    F.col("category_a").alias("category"), "cooccurrence_score", "cooccurrence_count")
    both = a.unionByName(b)
    if requests is not None:
        both = both.join(requests.select("product_id").distinct(), "product_id", "left_semi")
    r = top_n_per_group(both, ["product_id"], [F.col("cooccurrence_score").desc(), F.col("cooccurrence_count").desc(),
                                              F.col("other_product_id")], n)
    return r.select("product_id", F.col("rank").cast("bigint").alias("rank"), "other_product_id", "category",
                    F.col("cooccurrence_score").alias("jaccard"), F.col("cooccurrence_count").alias("bought_together"))
