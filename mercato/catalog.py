"""Registry of runnable queries: name -> callable(spark, sf_dir) -> DataFrame.

Every entry starts from the driver tables at ``sf_dir`` (through the bronze
mapping), so its work grows with them. Names carry the SURVEY section 2 id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import silver
from mercato.sources.fixtures import bronze_layer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return bronze_layer(spark, sf_dir)


def silver_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return silver.build(bronze(spark, sf_dir))


def _silver_query(table: str):
    def q(spark, sf_dir):
        return silver.CLEANERS[table](bronze(spark, sf_dir)[table])
    return q


for _i, _t in enumerate(["customers", "sellers", "translation", "products", "orders", "order_items",
                         "payments", "reviews", "geolocation"], start=1):
    register(f"b{_i}_{_t}")(_silver_query(_t))


@lru_cache(maxsize=1)
def _load_all():
    # plan modules register their own queries on import
    from mercato.plans import queries  # noqa: F401
    return QUERIES


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_load_all())
