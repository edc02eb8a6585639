"""Unordered pairs of distinct members within a group (J7), skew-safe.

The result of a co-occurrence count *is* the set of pairs, so every pair is
produced once -- but never all in one task. Each group is cut into ``B``
buckets by a hash of the member, where ``B`` grows with the group size
(``ceil(size / bucket_rows)``). A member of bucket ``b`` is sent as the left
side to the bucket pairs ``(b, j)``, ``j >= b``, and as the right side to
``(i, b)``, ``i <= b``; the equi-join on ``(group, i, j)`` then splits a hot
group of ``m`` members into ``B(B+1)/2`` tasks of about ``bucket_rows^2``
candidate pairs each. Ordinary groups have ``B = 1`` and are not copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairs_within(df: DataFrame, group: str, member: str, bucket_rows: int = 2048,
                 a: str = "a", b: str = "b", payload: tuple[str, ...] = ()) -> DataFrame:
    """``df`` has distinct ``(group, member)`` rows. Returns
    ``(group, a, b)`` with ``a < b`` for every unordered pair of members of
    the same group; each ``payload`` column ``x`` comes back as ``x_a`` and
    ``x_b`` (the value on the member that ended up as ``a`` / ``b``)."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_m"))
    nb = F.greatest(F.lit(1), F.ceil(F.col("_m") / F.lit(float(bucket_rows)))).cast("int")
    tagged = (df.join(sizes.where(F.col("_m") > 1), group)
              .withColumn("_nb", nb)
              .withColumn("_bk", F.pmod(F.xxhash64(F.col(member)), F.col("_nb").cast("long")).cast("int")))
    # left copies: (bk, j) for j in [bk, nb); right copies: (i, bk) for i in [0, bk]
    left = tagged.select(group, F.col(member).alias("_l"), *[F.col(p).alias(f"_l_{p}") for p in payload],
                         F.col("_bk").alias("_i"), F.explode(F.sequence(F.col("_bk"), F.col("_nb") - 1)).alias("_j"))
    right = tagged.select(group, F.col(member).alias("_r"), *[F.col(p).alias(f"_r_{p}") for p in payload],
                          F.col("_bk").alias("_j"), F.explode(F.sequence(F.lit(0), F.col("_bk"))).alias("_i"))
    joined = left.join(right, [group, "_i", "_j"])
    # diagonal tasks see each pair twice -> keep l < r; off-diagonal once -> normalise
    keep = (F.col("_i") < F.col("_j")) | (F.col("_l") < F.col("_r"))
    lt = F.col("_l") < F.col("_r")
    extra = []
    for p in payload:
        extra.append(F.when(lt, F.col(f"_l_{p}")).otherwise(F.col(f"_r_{p}")).alias(f"{p}_a"))
        extra.append(F.when(lt, F.col(f"_r_{p}")).otherwise(F.col(f"_l_{p}")).alias(f"{p}_b"))
    return joined.where(keep & (F.col("_l") != F.col("_r"))).select(
        group, F.least("_l", "_r").alias(a), F.greatest("_l", "_r").alias(b), *extra)
