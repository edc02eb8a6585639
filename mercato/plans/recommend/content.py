"""Content-based similarity.

R1 builds each product's text from five banded attributes; R2 is TF-IDF
with the usual defaults (lower-case, tokens of two or more word characters,
raw counts, ``idf = ln((1 + n) / (1 + df)) + 1``, L2-normalised rows).

R3 ranks, for every product, the most similar other products. A product's
vector depends only on its text, so products collapse into distinct texts
("signatures"), whose number is bounded by the attribute domains, not by
the catalogue size. The best ``n + 2`` signatures per signature come from a
threshold algorithm over blocks of postings (see ``best_texts``), never from all
signature pairs, and are expanded to products, ties in score broken by
product_id ascending (T18).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import feature_price_band, np_round, score_band, sentiment_band
from mercato.operators import dense_index, top_n_per_group

TOKEN_PATTERN = r"\b\w\w+\b"


def product_text(pf: DataFrame) -> DataFrame:
    """R1 (F8, F9): ``category price_band score_band sentiment_band state``."""
    text = F.concat_ws(" ", F.coalesce(F.col("product_category_name_english"), F.lit("unknown")),
                       feature_price_band("avg_price"), score_band("avg_review_score"),
                       sentiment_band("positive_sentiment_ratio"), F.coalesce(F.col("seller_state"), F.lit("unknown")))
    return pf.select("product_id", text.alias("text"))


def product_tfidf(pf: DataFrame) -> DataFrame:
    """R2 at product grain: ``(product_id, token, weight)``. Documents are
    all products (n), as in the reference; weights are computed once per
    distinct text and joined back."""
    texts = product_text(pf)
    sig = _signature_table(texts)
    return texts.join(sig, "text").select("product_id", "token", "weight")


def _signature_table(texts: DataFrame) -> DataFrame:
    """Per distinct text: token, tf, normalised weight and the raw vector
    norm (document frequencies over products)."""
    per_text = texts.groupBy("text").agg(F.count(F.lit(1)).alias("_k"))
    tok = per_text.select("text", "_k", F.explode(F.regexp_extract_all(F.lower(F.col("text")),
                                                                      F.lit(TOKEN_PATTERN), 0)).alias("token"))
    tf = tok.groupBy("text", "token").agg(F.count(F.lit(1)).alias("tf"), F.first("_k").alias("_k"))
    n = per_text.agg(F.sum("_k").alias("_n"))
    dfreq = tf.groupBy("token").agg(F.sum("_k").alias("_df"))
    idf = dfreq.crossJoin(F.broadcast(n)).select("token", (F.log((1 + F.col("_n")) / (1 + F.col("_df"))) + 1).alias("_idf"))
    w = tf.join(idf, "token").withColumn("_w", F.col("tf") * F.col("_idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("text")))
    return w.select("text", "token", "tf", (F.col("_w") / norm).alias("weight"), np_round(norm, 12).alias("norm"))


def _near_keys(sig: DataFrame) -> DataFrame:
    """Keys of a text: its tokens but one, its tokens but two, and each token
    alone; quadratic in the number of tokens. Texts that share a key are likely
    neighbours; the keys only serve to find a lower bound (see ``similar``)."""
    arr = sig.groupBy("text").agg(F.array_sort(F.collect_set("token")).alias("_a"), F.first("norm").alias("norm"))
    out = F.expr("""concat(
        transform(_a, x -> x),
        flatten(transform(_a, (x, i) -> transform(filter(_a, (y, j) -> j >= i),
                (y, j) -> array_join(filter(_a, z -> z <> x AND z <> y), '|')))))""")
    return arr.select("text", "norm", F.explode(F.array_distinct(out)).alias("_key")).where(F.col("_key") != "")


def _cosines(pairs: DataFrame, sig: DataFrame) -> DataFrame:
    """Exact cosine of every (s1, s2) pair, rounded at 1e-12 so that float
    noise never decides a tie."""
    w1 = sig.select(F.col("text").alias("s1"), "token", F.col("weight").alias("_w1"))
    w2 = sig.select(F.col("text").alias("s2"), "token", F.col("weight").alias("_w2"))
    return (pairs.join(w1, "s1").join(w2, ["s2", "token"]).groupBy("s1", "s2")
            .agg(np_round(F.sum(F.col("_w1") * F.col("_w2")), 12).alias("cos")))


#: Postings in one block of a token's list.
POSTINGS = 256
ROUND_BLOCKS = 64  # at most read of a list in one round
_SLACK = 1e-9  # more than the rounding of cosines


def posting_blocks(sig: DataFrame, size: int = POSTINGS) -> DataFrame:
    """``(token, s2, weight, b)``: the texts of each token in order of falling
    weight, ``size`` to a block; numbered by range partitioning, so a token
    that all texts hold is no single task's list."""
    rows = sig.select("token", "text", "weight", F.struct("token", (-F.col("weight")).alias("w"), "text").alias("_key"))
    rows = rows.join(dense_index(rows, "_key", "_place"), "_key")
    first = rows.groupBy("token").agg(F.min("_place").alias("_first"))
    return rows.join(first, "token").select("token", F.col("text").alias("s2"), "weight",
                                            F.floor((F.col("_place") - F.col("_first")) / size).cast("int").alias("b"))


def best_texts(sig: DataFrame, known: DataFrame, lead: DataFrame, n: int, size: int = POSTINGS) -> tuple[DataFrame, DataFrame]:
    """The ``n`` most similar texts ``(s1, s2, cos)`` of each text, by a threshold
    algorithm over impact-ordered posting blocks; ties go to the smaller
    ``_lead`` of ``lead (s2, _lead)``.

    ``known`` are some pairs with their cosines. A text not met yet can reach at
    most the sum, over the query's tokens, of the query's weight times the largest
    weight of the token's next block. Tokens whose sums, from the smallest
    on, stay below the n-th best cosine so far need not be read; the others'
    next blocks are joined by token and block number, what they hold gets its exact cosine,
    and so on until no token needs to be read. Rounds read 1, 2, 4, ...
    blocks. The second result tells how many blocks of each list were read:
    ``(s1, token, next)``.
    """
    postings = posting_blocks(sig, size).checkpoint()
    maxima = postings.groupBy("token", "b").agg(F.max("weight").alias("m")).checkpoint()
    ask = sig.select(F.col("text").alias("s1"), "token", F.col("weight").alias("w"), F.lit(0).alias("next"))

    def top(pairs: DataFrame) -> DataFrame:
        ranked = top_n_per_group(pairs.join(lead, "s2"), ["s1"], [F.col("cos").desc(), F.col("_lead").asc()], n, "_r")
        return ranked.select("s1", "s2", "cos").checkpoint()

    best, step = top(known), 1
    while True:
        floor = best.groupBy("s1").agg(F.when(F.count(F.lit(1)) >= n, F.min("cos")).otherwise(0.0).alias("floor"))
        gain = F.col("w") * F.coalesce("m", F.lit(0.0))
        upto = F.sum("gain").over(Window.partitionBy("s1").orderBy("gain", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        state = (ask.join(maxima.withColumnRenamed("b", "next"), ["token", "next"], "left").withColumn("gain", gain)
                 .join(floor, "s1", "left").withColumn("upto", upto)
                 .withColumn("read", (F.col("gain") > 0) & (F.col("upto") >= F.coalesce("floor", F.lit(0.0)) - _SLACK))
                 .select("s1", "token", "w", "next", "read").checkpoint())
        now = state.where("read")
        if now.isEmpty():
            return best, state.select("s1", "token", "next")
        blocks = now.select("s1", "token", F.explode(F.sequence("next", F.col("next") + (step - 1))).alias("b"))
        met = blocks.join(postings, ["token", "b"]).select("s1", "s2").distinct().join(best, ["s1", "s2"], "left_anti")
        best = top(best.unionByName(_cosines(met, sig)))
        ask = state.select("s1", "token", "w", F.when(F.col("read"), F.col("next") + step).otherwise(F.col("next")).alias("next"))
        step = min(2 * step, ROUND_BLOCKS)


def similar(pf: DataFrame, n: int = 10, requests: DataFrame | None = None) -> DataFrame:
    """For every product (or the ``product_id`` rows of ``requests``),
    the ``n`` most similar other products: ``(product_id, rank,
    similar_product_id, similarity)`` with similarity rounded to 4.

    Texts with all tokens but one or two in common (``n + 2`` per key) give a
    first n-th best cosine for each text; ``best_texts`` then reads what may still
    be better, never the whole list of a token that it doesn't need.
    """
    texts = product_text(pf)
    sig = _signature_table(texts).checkpoint()
    keys = _near_keys(sig)
    lists = top_n_per_group(keys, ["_key"], [F.col("norm").asc(), F.col("text").asc()], n + 2, "_r")
    some = (keys.select(F.col("text").alias("s1"), "_key").join(lists.select("_key", F.col("text").alias("s2")), "_key")
            .select("s1", "s2").distinct())
    # equal cosines: the text with the smaller first product goes first
    lead = texts.groupBy(F.col("text").alias("s2")).agg(F.min("product_id").alias("_lead")).checkpoint()
    best, _ = best_texts(sig, _cosines(some, sig), lead, n + 2)
    return expand_twins(texts.withColumnRenamed("text", "twin"), best, n, requests)


def expand_twins(twins: DataFrame, best: DataFrame, n: int, requests: DataFrame | None = None) -> DataFrame:
    """The n best other products of each product from the best ``n + 2`` groups
    of each group of products alike: ``twins (product_id, twin)`` and ``best (s1, s2,
    cos)``, a group itself among its best; ties go to the smaller product id."""
    # the first n + 1 product ids of each group are all that can ever be used
    members = top_n_per_group(twins, ["twin"], [F.col("product_id").asc()], n + 1, "_m")
    cand_p = best.join(members.select(F.col("twin").alias("s2"), F.col("product_id").alias("cand")), "s2")
    per_sig = top_n_per_group(cand_p, ["s1"], [F.col("cos").desc(), F.col("cand").asc()], n + 1, "_c")
    src = twins if requests is None else twins.join(requests.select("product_id").distinct(), "product_id", "left_semi")
    out = (src.join(per_sig, src["twin"] == per_sig["s1"]).where(F.col("cand") != F.col("product_id"))
           .select("product_id", F.col("cand").alias("similar_product_id"), "cos"))
    ranked = top_n_per_group(out, ["product_id"], [F.col("cos").desc(), F.col("similar_product_id").asc()], n)
    return ranked.select("product_id", F.col("rank").cast("bigint").alias("rank"), "similar_product_id",
                         np_round("cos", 4).alias("similarity"))
