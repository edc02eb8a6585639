"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue; its documents, shuffled by a hash of their id and
repeated for up to ``max_epochs`` epochs, get the virtual finish time

    (words of the source served up to and with this copy) / (its target words)

so that at virtual time 1 every source has been served its target. All copies
are put in one global order of finish times and the order is cut where the
total budget of words is reached.

Running sums never sit in one task: a source is dealt into hash ranges whose
number grows with the rows, ranges are summed first and their offsets added
back; the global order is a range split of the virtual time, whose bins hold
about equally many words because the queue is fair, and only the bin in which
the budget ends is ranked row by row.

Defined cases: a null text or a text without words has size 0 and is never
taken; a null source is a source of its own, ordered last; rows with a null
or repeated id are separate documents; ties in finish time are ordered by
hash, id, size and epoch; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import cut

#: White space of the word definition: blank and 0x09 to 0x0D.
WORD = "[^\\x20\\x09-\\x0D]+"
ROWS_PER_TASK = 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size) -> with weight and target words.

    Water-filling: in the order of cap / weight, the first source from which
    on nobody reaches the cap gives the level that the rest share. One row a
    source, so the ordered windows here run over sources, not documents.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    pick = F.array(*[F.lit(float(w)) for w in weights])
    t = (sizes.withColumn("rank", F.row_number().over(by_name))
         .withColumn("weight", F.element_at(pick, (F.col("rank") - 1) % len(weights) + 1))
         .withColumn("cap", (F.col("source_size") * max_epochs).cast("double")))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (t.withColumn("k", F.row_number().over(order))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("w_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
         .withColumn("w_all", F.sum("weight").over(whole))
         .withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("k", "level"))
    t = t.withColumn("level", F.min(fits).over(whole)["level"])
    return t.select("source", "source_size", "rank", "weight",
                    F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")).alias("target"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, max_epochs: int = 3,
        seed: str = "", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    copies (long, how many times it is taken), taken (long, words taken)."""
    slim = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                           n_words(F.col(text_col)).alias("size"))
               .withColumn("key", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))),
               "mix-sizes")
    stats = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    goal = cut(targets(stats, weights, share, max_epochs), "mix-targets")
    n, total = stats.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    budget = total * share
    digits = max(1, math.ceil(math.log(max(n / ROWS_PER_TASK, 1), 16)))

    # running words of a source in hash order: range sums first, then inside each range
    ranged = slim.withColumn("part", F.substring("key", 1, digits))
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("part_size").over(ahead), F.lit(0))).drop("part_size")
    inside = (Window.partitionBy("source", "part").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = ranged.withColumn("inside", F.sum("size").over(inside))
    run = run.join(sums.select(F.col("source").alias("s1"), F.col("part").alias("p1"), "ahead"),
                   F.col("source").eqNullSafe(F.col("s1")) & (F.col("part") == F.col("p1"))).drop("s1", "p1")
    run = run.join(goal.select(F.col("source").alias("s2"), "source_size", "target", "rank"),
                   F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    run = cut(run.withColumn("served", F.col("ahead") + F.col("inside"))
              .select("doc_id", "source", "key", "size", "served", "source_size", "target", "rank"), "mix-served")

    bins = max(16, math.ceil(max_epochs * n / ROWS_PER_TASK))

    def finish(epoch):
        served = F.col("served") + (epoch - F.lit(1)) * F.col("source_size")
        return served.cast("double") / F.when(F.col("target") > 0, F.col("target"))

    def bin_of(epoch):
        return F.least(F.floor(finish(epoch) * bins), F.lit(4 * bins))

    copies = (run.filter((F.col("size") > 0) & (F.col("target") > 0))
              .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))))
    filled = (copies.groupBy(bin_of(F.col("epoch")).alias("bin")).agg(F.sum("size").alias("words"))
              .withColumn("upto", F.sum("words").over(Window.orderBy("bin"))))
    # the bin in which the budget ends, and what is left of it there
    last = (filled.filter(F.col("upto") > F.lit(budget))
            .agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("b")).first()["b"])
    end, left = (last["bin"], budget - last["before"]) if last else (4 * bins + 1, 0.0)

    edge = (copies.filter(bin_of(F.col("epoch")) == F.lit(end)).withColumn("finish", finish(F.col("epoch")))
            .withColumn("upto", F.sum("size").over(
                Window.orderBy("finish", "key", "doc_id", "size", "epoch")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .filter(F.col("upto") <= F.lit(left))
            .groupBy(F.col("rank").alias("r3"), F.col("served").alias("v3"))
            .agg(F.count(F.lit(1)).alias("more")))
    whole = sum(((bin_of(F.lit(e)) < F.lit(end)).cast("long") for e in range(1, max_epochs + 1)), F.lit(0))
    out = run.join(edge, (F.col("rank") == F.col("r3")) & (F.col("served") == F.col("v3")) & (F.col("size") > 0), "left")
    n_copies = F.when((F.col("size") > 0) & (F.col("target") > 0),
                      whole + F.coalesce(F.col("more"), F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", n_copies.alias("copies"),
                      (n_copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, one for each copy taken, with the
    number of the copy in ``mix_epoch``. Rows equal in id, source and size
    are told apart by their order, so repeated rows keep their own copies."""
    names = [c for c in docs.columns if c != "mix_epoch"]
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    same = Window.partitionBy("doc_id", "source", "size").orderBy(F.desc("copies"))
    taken = (taken.withColumn("k", F.row_number().over(same)).filter("copies > 0")
             .select(*[F.col(c).alias(f"_mix_{c}") for c in ("doc_id", "source", "size", "k", "copies")]))
    d = docs.withColumn("_mix_n", n_words(F.col(text_col)))
    d = d.withColumn("_mix_row", F.row_number().over(
        Window.partitionBy(id_col, source_col, "_mix_n").orderBy(F.lit(1))))
    d = d.join(taken, F.col(id_col).eqNullSafe(F.col("_mix_doc_id"))
               & F.col(source_col).eqNullSafe(F.col("_mix_source"))
               & (F.col("_mix_n") == F.col("_mix_size")) & (F.col("_mix_row") == F.col("_mix_k")))
    return d.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))).alias("mix_epoch"))
