"""Global statistics, histograms, value counts and table profiles
(A9, A11-A15, A13, P14, P16, Q1-Q3).

Global statistics are one ``agg`` returning one row that is broadcast back
(its size is one row by construction); nothing is collected to the driver.
Exact quantiles never gather the distinct values in one task (``quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantiles(df: DataFrame, specs: dict[str, tuple[str | Column, float]], by: Sequence[str] = (),
              accuracy: int = 100_000) -> DataFrame:
    """Exact quantiles with linear interpolation: one row (per group ``by``)
    with a column for each ``name: (column, q)``; nulls are ignored.

    Two passes of bounded memory: a sketch with rank error ``1 / accuracy``
    brackets each quantile; then values below the bracket are counted and only
    the different values inside it, a share of ``4 / accuracy`` of the rows, are
    put in order.
    """
    by, eps = list(by), 2.0 / accuracy
    cols = {k: (F.col(c) if isinstance(c, str) else c).cast("double") for k, (c, _) in enumerate(specs.values())}
    base = df.select(*by, *[c.alias(f"_v{k}") for k, c in cols.items()])
    aggs, parts = [], []
    for k, (_, q) in enumerate(specs.values()):
        v = F.col(f"_v{k}")
        low = F.percentile_approx(v, q - eps, accuracy) if q - eps > 0 else F.min(v)
        high = F.percentile_approx(v, q + eps, accuracy) if q + eps < 1 else F.max(v)
        aggs += [low.alias(f"_lo{k}"), high.alias(f"_hi{k}"), F.count(v).alias(f"_n{k}")]
        parts.append(F.struct(F.lit(k).alias("k"), F.lit(float(q)).alias("q"), v.alias("v"), F.col(f"_lo{k}").alias("lo"),
                              F.col(f"_hi{k}").alias("hi"), F.col(f"_n{k}").alias("n")))
    bracket = base.groupBy(*by).agg(*aggs)
    if by:
        named = bracket.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], *bracket.columns[len(by):])
        same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
        wide = base.join(named, same)
    else:
        wide = base.crossJoin(F.broadcast(bracket))
    long = wide.select(*by, F.explode(F.array(*parts)).alias("x")).select(*by, "x.*").where("v is not null")
    # below the bracket, each value inside it, above it; the value next to the bracket on
    # either side is kept too, as the sketch's ranks may differ by one from ours
    zone = F.when(F.col("v") < F.col("lo"), 0).when(F.col("v") > F.col("hi"), 2).otherwise(1)
    inside = F.when((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")), F.col("v"))
    counts = (long.groupBy(*by, "k", "q", "n", zone.alias("zone"), inside.alias("in"))
              .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most")))
    order = Window.partitionBy(*by, "k").orderBy("zone", "in")
    run = counts.withColumn("upto", F.sum("c").over(order)).withColumn("pos", F.col("q") * (F.col("n") - 1))

    def at(rank):
        first = (F.col("upto") > rank) & (F.col("upto") - F.col("c") <= rank)
        return F.max(F.when(first & (F.col("zone") == 1), F.col("in"))
                     .when(first & (F.col("zone") == 0) & (rank == F.col("upto") - 1), F.col("most"))
                     .when(first & (F.col("zone") == 2) & (rank == F.col("upto") - F.col("c")), F.col("least")))

    ends = run.groupBy(*by, "k").agg(F.first("pos").alias("pos"), at(F.floor("pos")).alias("a"), at(F.ceil("pos")).alias("b"))
    pos, a, b = F.col("pos"), F.col("a"), F.col("b")
    # a rank outside its bracket would be a null that later filters swallow
    missed = F.raise_error(F.lit("a quantile's rank lies outside its bracket")).cast("double")
    value = F.when(a.isNull() | b.isNull(), missed).when(a == b, a).otherwise((F.ceil(pos) - pos) * a + (pos - F.floor(pos)) * b)
    return ends.withColumn("value", value).groupBy(*by).agg(
        *[F.max(F.when(F.col("k") == k, F.col("value"))).alias(name) for k, name in enumerate(specs)])


def global_row(df: DataFrame, *aggs: Column) -> DataFrame:
    """A one-row DataFrame of global aggregates (safe to broadcast)."""
    return df.agg(*aggs)


def with_global(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row stats frame to every row (broadcast nested-loop
    join against exactly one row; no Cartesian growth)."""
    return df.crossJoin(F.broadcast(stats))


def histogram(df: DataFrame, c: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Fixed-width bins over [min, max] (or given bounds); the last
    bin is closed. Output: bin, bin_start, bin_end, count (only non-empty
    bins). Without bounds the rows are counted by value first and the counts written:
    bounds and bins are two uses of them, not two runs of ``df``."""
    from mercato.session import cut
    x = F.col(c)
    data = df.where(x.isNotNull() & ~F.isnan(x.cast("double")))
    rows = F.count(F.lit(1))
    if lo is None or hi is None:
        data, rows = cut(data.groupBy(x.alias(c)).agg(rows.alias("_rows"))), F.sum("_rows")
        stats = data.agg(F.min(x).cast("double").alias("_lo"), F.max(x).cast("double").alias("_hi"))
    else:
        stats = df.sparkSession.range(1).select(F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / w), F.lit(bins - 1))).cast("int")
    binned = with_global(data, stats).where((x >= F.col("_lo")) & (x <= F.col("_hi"))).withColumn("bin", b)
    out = binned.groupBy("bin", "_lo", "_hi").agg(rows.alias("count"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.select("bin", (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
                      (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"), "count")


def value_counts(df: DataFrame, c: str, name: str | None = None, share: bool = True) -> DataFrame:
    """Counts per value (null dropped) with share % of the total."""
    name = name or c
    counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(name)).agg(F.count(F.lit(1)).alias("count"))
    if not share:
        return counts
    total = counts.agg(F.sum("count").alias("_total"))
    return with_global(counts, total).select(name, "count", (F.col("count") * 100.0 / F.col("_total")).alias("share_pct"))


def describe(df: DataFrame, c: str) -> DataFrame:
    """Count, mean, std, min, quartiles, max (exact, like pandas)."""
    x = F.col(c)
    basic = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                   F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"))
    quart = quantiles(df, {"p25": (c, 0.25), "p50": (c, 0.5), "p75": (c, 0.75)})
    return with_global(basic, quart).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def profile(df: DataFrame, name: str) -> DataFrame:
    """Q1: shape, duplicate rows and nulls per column, long form
    (table, column, nulls, rows, columns, duplicate_rows). One pass for the
    null counts plus one distinct for duplicates."""
    cols = df.columns
    nulls = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    distinct_rows = df.distinct().agg(F.count(F.lit(1)).alias("_distinct"))
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"))
                                  for i, c in enumerate(cols)]))
    return (with_global(nulls, distinct_rows)
            .select(F.lit(name).alias("table"), stacked.alias("_s"), "_rows", "_distinct")
            .select("table", F.col("_s.column").alias("column"), F.col("_s.nulls").alias("nulls"),
                    F.col("_rows").alias("rows"), F.lit(len(cols)).cast("bigint").alias("columns"),
                    (F.col("_rows") - F.col("_distinct")).alias("duplicate_rows")))


def layer_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Q3: rows, columns and total nulls per table, one row per table. The tables are
    run one after the other, each one's row written: their shuffle files aren't
    on disk together."""
    from mercato.session import cut
    parts = []
    for name, df in tables.items():
        total_nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("bigint"))
        parts.append(cut(df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                                F.lit(len(df.columns)).cast("bigint").alias("columns"),
                                total_nulls.cast("bigint").alias("total_nulls"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (rank sum, ties averaged): one row
    ``roc_auc, positives, negatives``; null where a class is missing. Rows
    without score or label don't count.

    Rows are counted by score first, so ties are one row; the scores are
    range-partitioned, a partition's negatives become the offset of the next, and only
    partition counts meet in one place."""
    from mercato.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    by_score = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("_s"))
                .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
                .repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_s")
                .withColumn("_p", F.spark_partition_id()).checkpoint())
    parts = by_score.groupBy("_p").agg(F.sum("_neg").alias("_n"))
    offsets = parts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_off"))
    below = F.sum("_neg").over(Window.partitionBy("_p").orderBy("_s")) - F.col("_neg") + F.col("_off")
    twice = (by_score.join(F.broadcast(offsets), "_p").withColumn("_below", below)
             .agg(F.sum((F.col("_pos") * (2 * F.col("_below") + F.col("_neg"))).cast("decimal(38,0)")).alias("_u"),
                  F.coalesce(F.sum("_pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("_neg"), F.lit(0)).alias("negatives")))
    both = F.col("positives").cast("double") * F.col("negatives")
    return twice.select(F.try_divide(F.col("_u").cast("double"), 2 * both).alias("roc_auc"), "positives", "negatives")
