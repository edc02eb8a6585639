"""Keep-first, top-1 / top-N per group and per-group min-max.

All of them are aggregations or window-group-limits, so Spark combines map
side before the shuffle: a hot key holding a third of the rows reaches the
reducer as one partial row per map task, never as a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per ``keys``: the smallest by ``order``, then by every
    remaining column (a total order, trap T7). Nulls sort first.

    Expressed as ``min(struct(...))`` per key: a partial+final aggregate, so
    duplicates collapse before the shuffle and skewed keys stay cheap.
    """
    keys = list(keys)
    order_cols = _cols(order)
    rest = [c for c in df.columns if c not in keys]
    # plain columns lead the struct under their own names and are not packed twice
    plain = list(dict.fromkeys(x for x in order if isinstance(x, str) and x in rest))
    if len(plain) == len(order):
        packed = F.struct(*[F.col(c) for c in plain], *[F.col(c) for c in rest if c not in plain])
    else:
        names = [f"_o{i}" for i in range(len(order_cols))]
        packed = F.struct(*[c.alias(n) for c, n in zip(order_cols, names)], *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def top1_by_count(df: DataFrame, key: str | Sequence[str], value: str, out: str | None = None,
                  count_name: str | None = None) -> DataFrame:
    """Per ``key``, the ``value`` seen most often; ties -> smallest
    value (T5). Null keys and null values are dropped (pandas groupby)."""
    keys = [key] if isinstance(key, str) else list(key)
    out = out or value
    nonnull = F.lit(True)
    for k in keys + [value]:
        nonnull = nonnull & F.col(k).isNotNull()
    counts = df.where(nonnull).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cnt"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_cnt")).alias("neg"), F.col(value).alias("v"))).alias("_b"))
    cols = [*keys, F.col("_b.v").alias(out)]
    if count_name:
        cols.append((-F.col("_b.neg")).alias(count_name))
    return best.select(*cols)


def mode_of_counts(labels: Sequence[str], count_cols: Sequence[str | Column]) -> Column:
    """A5 over a fixed label domain: given per-label count columns, the label
    with the highest count, ties -> smallest label, all zero -> null."""
    cands = [F.when(c > 0, F.struct((-c).alias("n"), F.lit(lbl).alias("v")))
             for lbl, c in zip(labels, _cols(count_cols))]
    best = F.least(*cands) if len(cands) > 1 else cands[0]
    return best.getField("v")


def top_n_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group by ``order`` with a dense 1..n
    position. ``row_number() <= n`` lets Spark plan a partial
    ``WindowGroupLimit`` before the shuffle, so a huge group ships only
    ``n`` rows per map task."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def minmax_over(c: str | Column, *partition: str) -> Column:
    """(x - min) / (max - min) within the group; constant group -> 0."""
    col = F.col(c) if isinstance(c, str) else c
    w = Window.partitionBy(*partition)
    mn, mx = F.min(col).over(w), F.max(col).over(w)
    return F.when(mx == mn, F.lit(0.0)).otherwise(F.try_divide(col - mn, mx - mn))
