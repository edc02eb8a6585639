"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame.

Each query applies its operator to a whole table with the operator's default
parameters and derives the digest columns from its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import (chat_format, decontaminate, exact_dedup, hmm_lm, jaccard_join, langid, mixing, periodic_runs, quality_fm,
                         quality_rules, ranked_search, secret_scan, suffix_dedup)
from mercato.llm.common import held_out, learnable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark, sf_dir):
    """The conversations as transcripts that name the speaker of every other
    turn only (by hash); the role column trains the model on four fifths of
    the conversations and is no input of the decoding."""
    c = table(spark, sf_dir, "conversations")
    named = F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))) % 2 == 0
    shown = F.when(named & F.col("role").isNotNull(), F.concat(F.initcap("role"), F.lit(": "), F.coalesce("text", F.lit(""))))
    transcripts = c.select("conv_id", "turn", "role", F.coalesce(shown, "text").alias("text"))
    learn = c.filter(learnable("conv_id", 5, 0)).select("conv_id")
    turns = chat_format.parse(transcripts, learn=learn, role_col="role")
    return turns.withColumn("held_out", held_out("conv_id", 5, 0))


def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return (langid.predict(docs, langid.train(docs))
            .select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score"))


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.links(table(spark, sf_dir, "documents"))


def op5_hmm_lm(spark, sf_dir):
    return hmm_lm.score(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removals(table(spark, sf_dir, "documents")).drop("spans")


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    return (quality_fm.score(docs, model)
            .select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op8_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark, sf_dir):
    return (secret_scan.scan(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"))


def op11_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark, sf_dir):
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.detect(table(spark, sf_dir, "documents"), rewrite=True).drop("runs")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_mixing": op2_mixing,
    "op3_langid": op3_langid,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_hmm_lm": op5_hmm_lm,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_quality_rules": op11_quality_rules,
    "op12_ranked_search": op12_ranked_search,
    "op13_periodic_runs": op13_periodic_runs,
}
