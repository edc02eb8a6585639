"""Silver -> gold feature tables.

Plan shape:
* Reviews are reduced to one row per order first (``review_by_order``:
  row count, score sum/count, per-sentiment counts). The reference joins
  items to reviews and lets several reviews per order multiply item rows
  (trap T11); the same numbers follow from one row per order by weighting
  with the order's review-row multiplicity, so no fan-out join of the item
  fact is ever materialised and each gold table is a single aggregation.
* Orders carry the person key (``order_person``: orders joined to
  customers once); items join it on ``order_id``.
* All grouping keys are hashed once; joins between aggregates on the same
  key reuse that partitioning.
* Money sums are exact integer-cent sums (order-independent results).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import SENTIMENT_LABELS, cents, np_round
from mercato.operators import keep_first, minmax_over, mode_of_counts, pairs_within, top_n_per_group
from mercato.session import cut

SENTIMENTS = sorted(SENTIMENT_LABELS.values())
POSITIVE = ("positivo",)


def _snt(label: str) -> str:
    return "_s_" + label.replace(" ", "_")


def review_by_order(reviews: DataFrame) -> DataFrame:
    """One row per order: review rows, non-null scores, score sum and the
    count of each sentiment label."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_rv_rows"),
        F.count("review_score").alias("_rv_n"),
        F.sum("review_score").alias("_rv_sum"),
        *[F.count_if(F.col("sentiment") == s).alias(_snt(s)) for s in SENTIMENTS])


def _weight() -> Column:
    """Rows an item contributes after a left join with its order's reviews."""
    return F.greatest(F.coalesce(F.col("_rv_rows"), F.lit(0)), F.lit(1))


def with_reviews(items: DataFrame, reviews: DataFrame) -> DataFrame:
    return items.join(review_by_order(reviews), "order_id", "left")


def categories(layer: dict[str, DataFrame]) -> DataFrame:
    """product_id -> category, English category (J1 with the translation)."""
    return (layer["products"].select("product_id", "product_category_name")
            .join(layer["translation"], "product_category_name", "left"))


def order_person(layer: dict[str, DataFrame], *extra: str) -> DataFrame:
    """order_id -> customer_unique_id (+ extra customer columns)."""
    cust = layer["customers"].select("customer_id", "customer_unique_id", *extra)
    return layer["orders"].select("order_id", "customer_id").join(cust, "customer_id", "left").drop("customer_id")


def _mode_sentiment() -> Column:
    return mode_of_counts(SENTIMENTS, [F.sum(F.col(_snt(s))) for s in SENTIMENTS])


def _avg_score() -> Column:
    return F.try_divide(F.sum("_rv_sum"), F.sum("_rv_n"))


# ---------------------------------------------------------------- G1
def interactions(layer: dict[str, DataFrame]) -> DataFrame:
    """G1: per (person, product): purchase_count (item rows), total_spent,
    mean review / sentiment mode over item x review rows, English category,
    ``implicit_score = count + 0.5 * coalesce(review, 3) / 5``."""
    items = layer["order_items"].select("order_id", "product_id", "total_item_value")
    fact = with_reviews(items.join(order_person(layer), "order_id", "left"), layer["reviews"])
    agg = (fact.where(F.col("customer_unique_id").isNotNull() & F.col("product_id").isNotNull())
           .groupBy("customer_unique_id", "product_id")
           .agg(F.count("order_id").alias("purchase_count"),
                (F.sum(cents("total_item_value")) / F.lit(100.0)).alias("total_spent"),
                _avg_score().alias("review_score"),
                _mode_sentiment().alias("sentiment")))
    cats = categories(layer).select("product_id", "product_category_name_english")
    out = agg.join(cats, "product_id", "left")
    review_norm = F.coalesce(F.col("review_score"), F.lit(3.0)) / F.lit(5.0)
    out = out.withColumn("implicit_score", F.col("purchase_count") * F.lit(1.0) + review_norm * F.lit(0.5))
    return out.select("customer_unique_id", "product_id", "product_category_name_english", "purchase_count",
                      "total_spent", "review_score", "sentiment", "implicit_score")


# ---------------------------------------------------------------- G2
def product_features(layer: dict[str, DataFrame], positive_labels=POSITIVE) -> DataFrame:
    """spine = products; sales, main seller state, review stats."""
    items = layer["order_items"].select("order_id", "product_id", "seller_id", "price", "freight_value")
    pos = sum((F.col(_snt(s)) for s in positive_labels), F.lit(0))
    # one pass: sums per product and seller, then per product, with the seller of most rows (ties -> smallest)
    per = (with_reviews(items.where(F.col("product_id").isNotNull()), layer["reviews"]).groupBy("product_id", "seller_id")
           .agg(F.sum(cents("price")).alias("_ps"), F.count("price").alias("_pn"),
                F.sum(cents("freight_value")).alias("_fs"), F.count("freight_value").alias("_fn"),
                F.count("order_id").alias("_orders"), F.count(F.lit(1)).alias("_rows"),
                F.sum("_rv_sum").alias("_rv_sum"), F.sum("_rv_n").alias("_rv_n"),
                F.sum(F.coalesce(pos, F.lit(0))).alias("_pos"), F.sum(_weight()).alias("_w")))
    best = F.when(F.col("seller_id").isNotNull(), F.struct((-F.col("_rows")).alias("neg"), F.col("seller_id").alias("v")))
    sales = per.groupBy("product_id").agg(
        (F.sum("_ps") / F.sum("_pn") / F.lit(100.0)).alias("avg_price"),
        (F.sum("_fs") / F.sum("_fn") / F.lit(100.0)).alias("avg_freight_value"),
        F.sum("_orders").alias("total_orders"), _avg_score().alias("avg_review_score"),
        F.coalesce(F.sum("_rv_n"), F.lit(0)).alias("total_reviews"),
        (F.sum("_pos") / F.sum("_w")).alias("positive_sentiment_ratio"), F.min(best).alias("_b"))
    sales = sales.withColumn("seller_id", F.col("_b.v")).join(
        layer["sellers"].select("seller_id", "seller_state"), "seller_id", "left").drop("_b", "seller_id")
    out = categories(layer).join(sales, "product_id", "left")
    for c in ("avg_price", "avg_freight_value", "avg_review_score", "positive_sentiment_ratio"):
        out = out.withColumn(c, np_round(c, 4))
    return out.select("product_id", "product_category_name", "product_category_name_english", "avg_price",
                      "avg_freight_value", "total_orders", "avg_review_score", "total_reviews",
                      "positive_sentiment_ratio", "seller_state")


# ---------------------------------------------------------------- G3
def customer_profile(layer: dict[str, DataFrame]) -> DataFrame:
    """One row per person (first customer row by customer_id)."""
    cust = layer["customers"]
    spine = keep_first(cust.select("customer_unique_id", "customer_id", "customer_city", "customer_state"),
                       ["customer_unique_id"], ["customer_id"]).drop("customer_id")
    # orders x customers once; every per-person branch reuses it
    orders = cut(layer["orders"].select("order_id", "customer_id", "delivery_days", "is_late").join(
        cust.select("customer_id", "customer_unique_id"), "customer_id", "left"))
    op = orders.select("order_id", "customer_unique_id")
    order_agg = orders.where(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.count("order_id").alias("total_orders"), F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg(F.col("is_late").cast("int")).alias("is_late_buyer_pct"))
    items = layer["order_items"].select("order_id", "product_id", "total_item_value").join(op, "order_id", "left")
    cat_items = items.join(categories(layer).select("product_id", "product_category_name_english"), "product_id", "left")

    def per_person(df: DataFrame, value: str, **sums: Column) -> DataFrame:
        """Sums per person, and the value of most rows (``_top``; ties -> smallest, nulls don't count), in one pass."""
        per = (df.where(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id", value)
               .agg(F.count(F.lit(1)).alias("_n"), *[c.alias(k) for k, c in sums.items()]))
        best = F.when(F.col(value).isNotNull(), F.struct((-F.col("_n")).alias("neg"), F.col(value).alias("v")))
        return per.groupBy("customer_unique_id").agg(*[F.sum(k).alias(k) for k in sums], F.min(best)["v"].alias("_top"))

    spend = per_person(cat_items, "product_category_name_english", _spent=F.sum(cents("total_item_value"))).select(
        "customer_unique_id", (F.coalesce("_spent", F.lit(0)) / F.lit(100.0)).alias("total_spent"), F.col("_top").alias("preferred_category"))
    pay = layer["payments"].select("order_id", "payment_type", "payment_installments").join(op, "order_id", "left")
    pay = per_person(pay, "payment_type", _s=F.sum("payment_installments"), _c=F.count("payment_installments")).select(
        "customer_unique_id", F.col("_top").alias("preferred_payment_type"), F.try_divide("_s", "_c").alias("avg_installments"))
    rev = layer["reviews"].select("order_id", "review_score").join(op, "order_id", "left")
    rev_agg = rev.where(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.avg("review_score").alias("avg_review_score"))
    out = spine
    for part in (order_agg, spend, rev_agg, pay):
        out = out.join(part, "customer_unique_id", "left")
    for c in ("avg_delivery_days", "is_late_buyer_pct", "total_spent", "avg_review_score", "avg_installments"):
        out = out.withColumn(c, np_round(c, 4))
    return out.select("customer_unique_id", "customer_city", "customer_state", "total_orders", "avg_delivery_days",
                      "is_late_buyer_pct", "total_spent", "avg_review_score", "preferred_category",
                      "preferred_payment_type", "avg_installments")


# ---------------------------------------------------------------- G4
def category_affinity(layer: dict[str, DataFrame], weights=(0.5, 0.3, 0.2)) -> DataFrame:
    """Per (person, category) over item x review rows (T11); per-person
    min-max of count, spend and review (missing review -> 3.0)."""
    items = layer["order_items"].select("order_id", "product_id", "total_item_value")
    fact = (items.join(categories(layer).select("product_id", "product_category_name_english"), "product_id", "left")
            .join(order_person(layer), "order_id", "left"))
    fact = with_reviews(fact, layer["reviews"])
    w = _weight()
    aff = (fact.where(F.col("customer_unique_id").isNotNull() & F.col("product_category_name_english").isNotNull())
           .groupBy("customer_unique_id", "product_category_name_english")
           .agg(F.sum(F.when(F.col("order_id").isNotNull(), w).otherwise(0)).alias("purchase_count"),
                (F.coalesce(F.sum(cents("total_item_value") * w), F.lit(0)) / F.lit(100.0)).alias("total_spent"),
                _avg_score().alias("avg_review_score")))
    u = "customer_unique_id"
    p = minmax_over("purchase_count", u)
    s = minmax_over("total_spent", u)
    r = minmax_over(F.coalesce(F.col("avg_review_score"), F.lit(3.0)), u)
    score = p * F.lit(weights[0]) + s * F.lit(weights[1]) + r * F.lit(weights[2])
    return aff.withColumn("affinity_score", np_round(score, 4)).select(
        u, "product_category_name_english", "purchase_count", "total_spent", "avg_review_score", "affinity_score")


# ---------------------------------------------------------------- G5
def multi_item_rows(items: DataFrame, group: str = "order_id", member: str = "product_id") -> DataFrame:
    """Rows of groups with more than one non-null member row (J5 as an
    aggregate + join, not a window: a hot group stays a partial count)."""
    sizes = items.groupBy(group).agg(F.count(member).alias("_n")).where(F.col("_n") > 1).select(group)
    return items.join(sizes, group, "left_semi")


def cooccurrence_scores(layer: dict[str, DataFrame], bucket_rows: int = 2048) -> DataFrame:
    """G5 without the categories: product pairs bought in the same (multi-item)
    order, their count and Jaccard ``c / (n_a + n_b - c)``. Items carry the number
    of their product's orders into the pairs: there are more pairs than items, and
    the pairs are shuffled once, to be counted."""
    items = layer["order_items"].select("order_id", "product_id")
    basket = cut(multi_item_rows(items).where(F.col("product_id").isNotNull()).distinct())  # read twice
    freq = basket.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    basket = cut(basket.join(freq, "product_id"))  # read three times
    pairs = pairs_within(basket, "order_id", "product_id", bucket_rows, "product_id_a", "product_id_b", payload=("_n",))
    counts = pairs.groupBy("product_id_a", "product_id_b").agg(
        F.count(F.lit(1)).alias("cooccurrence_count"), F.max("_n_a").alias("_na"), F.max("_n_b").alias("_nb"))
    c = F.col("cooccurrence_count")
    return counts.select("product_id_a", "product_id_b", "cooccurrence_count",
                         np_round(c / (F.col("_na") + F.col("_nb") - c), 6).alias("cooccurrence_score"))


def cooccurrence(layer: dict[str, DataFrame], bucket_rows: int = 2048) -> DataFrame:
    """``cooccurrence_scores`` with both categories."""
    cats = categories(layer).select("product_id", "product_category_name_english")
    out = (cooccurrence_scores(layer, bucket_rows)
           .join(cats.select(F.col("product_id").alias("product_id_a"),
                             F.col("product_category_name_english").alias("category_a")), "product_id_a", "left")
           .join(cats.select(F.col("product_id").alias("product_id_b"),
                             F.col("product_category_name_english").alias("category_b")), "product_id_b", "left"))
    return out.select("product_id_a", "product_id_b", "category_a", "category_b", "cooccurrence_count",
                      "cooccurrence_score")


# ---------------------------------------------------------------- G6
def segment_counts(layer: dict[str, DataFrame]) -> DataFrame:
    """Item rows per segment and product: counted by (product, state), which are
    the state segments, then by product, for the global and the category segment
    (null states and categories skipped)."""
    items = layer["order_items"].select("order_id", "product_id").where(F.col("product_id").isNotNull())
    fact = items.join(order_person(layer, "customer_state"), "order_id", "left")
    per = cut(fact.groupBy("product_id", F.col("customer_state").cast("string").alias("customer_state"))
              .agg(F.count("order_id").alias("_c")))
    total = (per.groupBy("product_id").agg(F.sum("_c").alias("_c"))
             .join(categories(layer).select("product_id", "product_category_name_english"), "product_id", "left"))
    segs = F.filter(F.array(
        F.struct(F.lit("global").alias("t"), F.lit("all").alias("v")),
        F.struct(F.lit("category").alias("t"), F.col("product_category_name_english").alias("v"))),
        lambda s: s["v"].isNotNull())
    return (per.where(F.col("customer_state").isNotNull())
            .select(F.lit("state").alias("segment_type"), F.col("customer_state").alias("segment_value"), "product_id", F.col("_c").alias("_seg_orders"))
            .unionByName(total.select(F.explode(segs).alias("_seg"), "product_id", "_c").select(
                F.col("_seg.t").alias("segment_type"), F.col("_seg.v").alias("segment_value"), "product_id", F.col("_c").alias("_seg_orders"))))


def top_by_segment(layer: dict[str, DataFrame], product_feats: DataFrame | None = None, n: int = 10) -> DataFrame:
    """Top-n products per segment by segment item rows desc, then product
    mean review desc (null last), then product_id asc."""
    pf = product_feats if product_feats is not None else product_features(layer)
    # only products that reach the n-th count, ties included, need their features
    by_count = Window.partitionBy("segment_type", "segment_value").orderBy(F.col("_seg_orders").desc())
    counts = segment_counts(layer).withColumn("_place", F.rank().over(by_count)).where(F.col("_place") <= n).drop("_place")
    ranked = top_n_per_group(
        counts.join(pf.select("product_id", "product_category_name_english", "avg_review_score", "avg_price",
                              "total_orders", "positive_sentiment_ratio"), "product_id", "left"),
        ["segment_type", "segment_value"],
        [F.col("_seg_orders").desc(), F.col("avg_review_score").desc_nulls_last(), F.col("product_id").asc()], n)
    return ranked.select("segment_type", "segment_value", F.col("rank").cast("bigint").alias("rank"), "product_id",
                         "product_category_name_english", "avg_review_score", "avg_price", "total_orders",
                         "positive_sentiment_ratio")


# ---------------------------------------------------------------- G7
_TYPE_NAMES = {"string": "string", "double": "float", "float": "float", "bigint": "integer", "int": "integer",
               "smallint": "integer", "tinyint": "integer", "boolean": "boolean"}


def contract(tables: dict[str, DataFrame]) -> DataFrame:
    """Data contract per table and column, long form: type, nullable
    (nulls present in the data), min/max for numeric columns (rounded 4),
    row and column counts. One aggregation pass per table."""
    parts = []
    for name, df in tables.items():
        types = dict(df.dtypes)
        aggs = [F.count(F.lit(1)).alias("_rows")]
        entries = []
        for i, c in enumerate(df.columns):
            kind = _TYPE_NAMES.get(types[c], "string")
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"_n{i}"))
            if kind in ("float", "integer"):
                aggs += [F.min(c).cast("double").alias(f"_lo{i}"), F.max(c).cast("double").alias(f"_hi{i}")]
                lo, hi = np_round(f"_lo{i}", 4), np_round(f"_hi{i}", 4)
            else:
                lo = hi = F.lit(None).cast("double")
            entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("type"),
                                    (F.col(f"_n{i}") > 0).alias("nullable"), lo.alias("min"), hi.alias("max")))
        row = df.agg(*aggs)
        parts.append(row.select(F.lit(name).alias("table_name"), F.col("_rows").alias("row_count"),
                                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                                F.explode(F.array(*entries)).alias("_e"))
                     .select("table_name", "_e.column_name", "_e.type", "_e.nullable", "_e.min", "_e.max",
                             "row_count", "column_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build(layer: dict[str, DataFrame]) -> dict[str, DataFrame]:
    pf = product_features(layer)
    return {
        "user_product_interactions": interactions(layer),
        "product_features": pf,
        "customer_profile": customer_profile(layer),
        "category_affinity": category_affinity(layer),
        "product_cooccurrence": cooccurrence(layer),
        "top_products_by_segment": top_by_segment(layer, pf),
    }
