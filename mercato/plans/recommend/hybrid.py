"""Hybrid re-ranker (R10-R19): user sample, negative sampling, label
encoding, training-set assembly, stratified split, boosted trees,
evaluation, feature importance, batch hybrid recommendations and the
serving variant with request context.

Randomness is replaced by seeded hashes (MD5 of seed and key), so every
sample is reproducible and survives task retries without checkpoints.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.operators import dense_index, roc_auc, top_n_per_group
from mercato.operators.sampling import explode_range, limit_per_group
from mercato.session import cut

USER, ITEM = "customer_unique_id", "product_id"


def _h(*cols, seed: int = 42):
    """Seeded random order: hex MD5 of the seed and the values."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def _leading(key: Column, digits: int) -> Column:
    """The first hex digits of a key as a number (monotone in the key)."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


# ---------------------------------------------------------------- R10
def user_sample(profile: DataFrame, inter: DataFrame, size: int = 5000, seed: int = 42) -> DataFrame:
    """R10 (U2): up to ``size`` persons that have both a profile and a
    history, chosen by a seeded hash (TakeOrderedAndProject, k rows)."""
    ids = profile.select(USER).intersect(inter.select(USER))
    return ids.orderBy(_h(USER, seed=seed), USER).limit(size)


# ---------------------------------------------------------------- R11
#: Rounds of the permutation, and the prime of its coin flips.
SHUFFLE_ROUNDS = 24
_PRIME = 2_147_483_647


def shuffle_keys(key: Column, size: Column, rounds: int = SHUFFLE_ROUNDS) -> Column:
    """Round keys of a swap-or-not shuffle of ``0 .. size - 1``, from MD5s of ``key``."""
    def part(r: int, first: int, digits: int) -> Column:
        return F.conv(F.substring(F.md5(F.concat_ws(":", key, F.lit(str(r)))), first, digits), 16, 10).cast("long")

    return F.array(*[F.struct((part(r, 1, 12) % size).alias("k"), (1 + part(r, 13, 7) % F.lit(_PRIME - 1)).alias("a"),
                              part(r, 20, 7).alias("b")) for r in range(rounds)])


def shuffled(place: Column, size: Column, keys: Column) -> Column:
    """Where a keyed permutation of ``0 .. size - 1`` takes ``place``.

    Each round pairs x with (k - x) mod size and swaps the pair, or not, by a
    coin that both members see alike; so every round, and the whole, is a
    permutation of just these numbers, for any size below 2^31."""
    def step(x: Column, r: Column) -> Column:
        other = F.pmod(r["k"] - x, size)
        line = (r["a"] * F.greatest(x, other) + r["b"]) % F.lit(_PRIME)
        return F.when(((line * line) % F.lit(_PRIME)) % 2 == 1, other).otherwise(x)

    return F.aggregate(keys, place.cast("long"), step)


def negatives(pos: DataFrame, catalogue: DataFrame, seed: int = 42) -> DataFrame:
    """For each user in ``pos`` (``customer_unique_id, product_id``) as
    many catalogue products they did not buy as they bought (all of them if
    fewer remain), uniformly without replacement and without a cross join.

    Every user reads the dense catalogue index through a permutation of its own
    (``shuffled``): the first ``2 n`` products hold at least ``n`` that were
    not bought, or all that remain. The first n not bought ones are the sample,
    so any set of products may be drawn; one scheme for light and heavy users."""
    cat = dense_index(catalogue, ITEM, "_pidx")
    p_count = cat.agg(F.count(F.lit(1)).alias("_P"))
    bought = pos.select(USER, ITEM).distinct()
    need = (bought.groupBy(USER).agg(F.count(F.lit(1)).alias("_n")).crossJoin(F.broadcast(p_count))
            .withColumn("_keys", shuffle_keys(F.concat_ws(":", F.lit(str(seed)), F.col(USER).cast("string")), F.col("_P"))))
    walk = explode_range(need, F.lit(0), (F.least(F.col("_n") * 2, F.col("_P")) - 1).cast("int"), "_j")
    walk = walk.select(USER, "_n", "_j", shuffled(F.col("_j"), F.col("_P"), F.col("_keys")).cast("int").alias("_pidx"))
    free = (walk.join(cat, "_pidx").join(bought, [USER, ITEM], "left_anti")
            .select(USER, ITEM, "_n", "_j").checkpoint())  # the limit reads it twice
    # a monotone bucket of the step, so that no user's walk is ranked in one task
    return limit_per_group(free, [USER], "_n", [F.col("_j")], F.floor(F.col("_j") / 1024).cast("int")).select(USER, ITEM)


# ---------------------------------------------------------------- R12
def label_codes(df: DataFrame, col: str, unknown: str = "unknown") -> DataFrame:
    """Sorted-class label encoding (nulls -> ``unknown`` first):
    ``(value, code)`` with code = position among the sorted distinct values."""
    return dense_index(df.select(F.coalesce(F.col(col).cast("string"), F.lit(unknown)).alias("value")), "value", "code")


def encode(df: DataFrame, col: str, codes: DataFrame, unknown: str = "unknown") -> DataFrame:
    v = F.coalesce(F.col(col).cast("string"), F.lit(unknown))
    return (df.withColumn("_v", v).join(codes.withColumnRenamed("value", "_v"), "_v", "left")
            .drop("_v", col).withColumnRenamed("code", col))


# ---------------------------------------------------------------- R13
# The feature columns of R13, their order and names.
CUSTOMER_FEATURES = ["customer_state", "total_orders", "total_spent", "avg_review_score", "preferred_category",
                     "preferred_payment_type", "avg_installments", "avg_delivery_distance"]
PRODUCT_FEATURES = ["product_category_name_english", "avg_price", "avg_review_score", "total_orders",
                    "positive_sentiment_ratio", "seller_state", "repeat_product", "total_sellers"]
FEATURES = ["customer_state", "cliente_total_orders", "total_spent", "cliente_avg_review_score",
            "preferred_category", "preferred_payment_type", "avg_installments", "avg_delivery_distance",
            "product_category_name_english", "avg_price", "produto_avg_review_score", "produto_total_orders",
            "positive_sentiment_ratio", "seller_state", "repeat_product", "total_sellers"]


@dataclass
class FeatureTables:
    customers: DataFrame   # customer_unique_id + encoded customer features
    products: DataFrame    # product_id + encoded product features; rated: the rating is known
    codes: dict[str, DataFrame]


def feature_tables(customer_details: DataFrame, product_details: DataFrame) -> FeatureTables:
    """R12 + R13: encoded customer and product feature tables (nulls -> 0),
    colliding names renamed explicitly (J9)."""
    codes = {}
    cp = customer_details.select(USER, *CUSTOMER_FEATURES)
    for c in ("customer_state", "preferred_category", "preferred_payment_type"):
        codes[c] = label_codes(cp, c)
        cp = encode(cp, c, codes[c])
    cp = cp.withColumnRenamed("total_orders", "cliente_total_orders") \
        .withColumnRenamed("avg_review_score", "cliente_avg_review_score")
    pf = product_details.select(ITEM, *PRODUCT_FEATURES).withColumn("rated", F.col("avg_review_score").isNotNull())
    for c in ("product_category_name_english", "seller_state"):
        codes[c] = label_codes(pf, c)
        pf = encode(pf, c, codes[c])
    pf = pf.withColumnRenamed("avg_review_score", "produto_avg_review_score") \
        .withColumnRenamed("total_orders", "produto_total_orders")
    cp = cp.select(USER, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cp.columns if c != USER])
    pf = pf.select(ITEM, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in pf.columns if c not in (ITEM, "rated")], "rated")
    return FeatureTables(cp, pf, codes)


def training_set(pos: DataFrame, neg: DataFrame, ft: FeatureTables) -> DataFrame:
    """Positives (label 1) + negatives (label 0) with 16 features."""
    rows = pos.select(USER, ITEM, F.lit(1).alias("label")).unionByName(neg.select(USER, ITEM, F.lit(0).alias("label")))
    t = rows.join(ft.customers, USER, "left").join(ft.products, ITEM, "left")
    return t.select(USER, ITEM, F.col("label").cast("double").alias("label"),
                    *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in FEATURES])


# ---------------------------------------------------------------- R14
def stratified_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: within each label exactly
    ``ceil(test_fraction * n_label)`` rows, the lowest by a seeded hash.
    Selected with the bucketed per-group limit, so a label holding half
    the rows is never ranked in one task."""
    n = df.groupBy("label").agg(F.ceil(F.count(F.lit(1)) * F.lit(test_fraction)).cast("bigint").alias("_k"))
    d = df.join(F.broadcast(n), "label").withColumn("_key", _h(USER, ITEM, seed=seed))
    test = limit_per_group(d, ["label"], "_k", [F.col("_key"), F.col(USER), F.col(ITEM)], _leading(F.col("_key"), 4))
    flags = test.select(USER, ITEM, "label").withColumn("is_test", F.lit(True))
    return (df.join(flags, [USER, ITEM, "label"], "left")
            .withColumn("is_test", F.coalesce(F.col("is_test"), F.lit(False))))


# ---------------------------------------------------------------- R15-R17
def train(df: DataFrame, trees: int = 200, depth: int = 6, rate: float = 0.1, subsample: float = 0.8,
          colsample: str = "0.8", seed: int = 42) -> PipelineModel:
    """Boosted trees on the assembled feature vector."""
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"),
        GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate,
                      subsamplingRate=subsample, featureSubsetStrategy=colsample, seed=seed,
                      checkpointInterval=10, cacheNodeIds=False),
    ])
    return pipe.fit(df)


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    p = model.transform(df)
    return p.withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability")


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Exact ROC-AUC plus precision / recall / F1 / support per class, from
    one confusion ``groupBy``."""
    pred = model.transform(test)
    scored = pred.select("label", "prediction", vector_to_array("probability")[1].alias("score")).checkpoint()
    pred, auc = scored, roc_auc(scored, "label", "score").first()["roc_auc"]
    conf = pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    parts = []
    for cls in (0.0, 1.0):
        tp = F.sum(F.when((F.col("label") == cls) & (F.col("prediction") == cls), F.col("n")).otherwise(0))
        fp = F.sum(F.when((F.col("label") != cls) & (F.col("prediction") == cls), F.col("n")).otherwise(0))
        fn = F.sum(F.when((F.col("label") == cls) & (F.col("prediction") != cls), F.col("n")).otherwise(0))
        support = F.sum(F.when(F.col("label") == cls, F.col("n")).otherwise(0))
        parts.append(conf.agg(F.lit(str(int(cls))).alias("class"), F.try_divide(tp, tp + fp).alias("precision"),
                              F.try_divide(tp, tp + fn).alias("recall"), support.alias("support")))
    rep = parts[0].unionByName(parts[1])
    rep = rep.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"),
                                            F.col("precision") + F.col("recall")))
    return rep.withColumn("roc_auc", F.lit(auc).cast("double"))


def importances(model: PipelineModel) -> DataFrame:
    """Feature importance ranking (16 rows)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(FEATURES, imp)], "feature string, importance double")
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature")))


# ---------------------------------------------------------------- R18 / R19
def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by ``key`` to all shuffle partitions: few bytes, but each is scored by every tree."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def rerank(candidates: DataFrame, ft: FeatureTables, model: PipelineModel, n: int = 10) -> DataFrame:
    """Score ALS candidates (``customer_unique_id, product_id``) with
    the classifier and keep the n best per user, with the product's category
    code, price and rating as the classifier saw them."""
    # the products' features join first: rows then move to their user once, for the user's features and the list
    t = (_spread(candidates.select(USER, ITEM).join(ft.products, ITEM, "left"), USER).join(ft.customers, USER, "left")
         .select(USER, ITEM, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in FEATURES]))
    s = score(model, t, "score_hybrid")
    top = top_n_per_group(s, [USER], [F.col("score_hybrid").desc(), F.col(ITEM)], n)
    return top.select(USER, F.col("rank").cast("bigint").alias("rank"), ITEM, "score_hybrid",
                      "product_category_name_english", "avg_price", F.col("produto_avg_review_score").alias("avg_review_score"))


def request_key(requests: DataFrame) -> str:
    """What tells requests apart: ``request_id`` if they carry one, else the customer."""
    return "request_id" if "request_id" in requests.columns else USER


def rerank_with_context(candidates: DataFrame, requests: DataFrame, ft: FeatureTables, model: PipelineModel,
                        n: int = 10, default_state: str = "SP", default_rating: float = 4.0) -> DataFrame:
    """Like R18 for each request, with request context overriding the
    customer's state (unknown -> ``default_state``, or the first class if
    absent), preferred category (unknown -> first class), product price and
    product rating (T12; ``rating`` is optional); a product whose rating isn't known counts as
    rated ``default_rating``. A customer may send several requests: with a
    ``request_id`` each gets a list of its own."""
    key = request_key(requests)
    own = [key] if key == USER else [key, USER]
    st, cat = ft.codes["customer_state"], ft.codes["preferred_category"]
    first_st = st.agg(F.min("code").alias("_fs"))
    sp = st.where(F.col("value") == default_state).select(F.col("code").alias("_sp"))
    first_cat = cat.agg(F.min("code").alias("_fc"))
    rating = F.col("rating") if "rating" in requests.columns else F.lit(None)
    ctx = (requests.select(*own, "state", "category", "price", rating.cast("double").alias("_ctx_rating"))
           .join(st.select(F.col("value").alias("state"), F.col("code").alias("_st")), "state", "left")
           .join(cat.select(F.col("value").alias("category"), F.col("code").alias("_ct")), "category", "left")
           .crossJoin(F.broadcast(first_st)).crossJoin(F.broadcast(first_cat))
           .join(F.broadcast(sp), F.lit(True), "left"))
    ctx = ctx.select(*own, F.when(F.col("state").isNull(), None)
                     .otherwise(F.coalesce("_st", "_sp", "_fs")).cast("double").alias("_ctx_state"),
                     F.when(F.col("category").isNull(), None)
                     .otherwise(F.coalesce("_ct", "_fc")).cast("double").alias("_ctx_cat"),
                     F.col("price").cast("double").alias("_ctx_price"), "_ctx_rating")
    # a request's context and its customer's features are written once under a number; until
    # they are needed, just that number goes along with each candidate
    ctx = cut(ctx.join(ft.customers, USER, "left").withColumn("_request", F.monotonically_increasing_id()))
    t = (ctx.select("_request", USER).join(candidates.select(USER, ITEM), USER).drop(USER).join(ft.products, ITEM, "left"))
    t = _spread(t, "_request").join(ctx, "_request")
    value = {"customer_state": F.coalesce("_ctx_state", "customer_state"), "preferred_category": F.coalesce("_ctx_cat", "preferred_category"),
             "avg_price": F.coalesce("_ctx_price", "avg_price"),
             "produto_avg_review_score": F.coalesce("_ctx_rating", F.when(F.col("rated"), F.col("produto_avg_review_score")),
                                                    F.lit(default_rating))}
    t = t.select(*own, ITEM, *[F.coalesce(value.get(c, F.col(c)), F.lit(0.0)).alias(c) for c in FEATURES])
    s = score(model, t, "score")
    top = top_n_per_group(s, [key], [F.col("score").desc(), F.col(ITEM)], n)
    return top.select(*own, F.col("rank").cast("bigint").alias("rank"), ITEM, "score",
                      F.lit(HYBRID).alias("strategy"))


# The strategy labels of the serving contract.
HYBRID, COLD_START, NO_CANDIDATES = "xgboost_hybrid", "cold_start", "fallback_hybrid"


def serve(requests: DataFrame, candidates: DataFrame, known: DataFrame, cold: DataFrame, ft: FeatureTables,
          model: PipelineModel, n: int = 10) -> DataFrame:
    """R19 with its fallbacks: requests of customers without history get the
    cold-start list of their context, those of known customers without candidates too, under a
    label of their own. ``known`` holds the customers with a history, ``cold`` the
    lists by request (``request_id`` where requests have one, else the customer)."""
    key = request_key(requests)
    own = [key] if key == USER else [key, USER]
    ranked = rerank_with_context(candidates, requests, ft, model, n)
    # a request has a list if its customer has candidates; nothing is scored to find that out
    have = requests.select(*own).join(candidates.select(USER), USER, "left_semi").select(key).distinct()
    rest = requests.select(*own).distinct().join(have, key, "left_anti")
    rest = rest.join(known.select(USER).distinct().withColumn("_known", F.lit(True)), USER, "left")
    label = F.when(F.col("_known"), F.lit(NO_CANDIDATES)).otherwise(F.lit(COLD_START))
    lists = rest.join(cold.select(key, "rank", ITEM), key).select(
        *own, F.col("rank").cast("bigint").alias("rank"), ITEM, F.lit(None).cast("double").alias("score"), label.alias("strategy"))
    return ranked.unionByName(lists)
