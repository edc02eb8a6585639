"""Property graph as node and edge DataFrames.

Nodes: one DataFrame per label with a unique key; edges: ``(rel, src,
dst)`` rows that exist only when both end nodes exist (inner joins).
Pattern queries become joins over these tables. Keys are strings, so ids
of any type share one edge schema.
"""

# ruff: noqa: E731
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.functions import exact_mean, fixed_point, np_round
from mercato.operators import keep_first, pairs_within
from mercato.plans.details import zip_geo
from mercato.plans.silver import Layer
from mercato.sources.keyed import KeyedTable


def _s(c: str):
    return F.col(c).cast("string")


def nodes(layer: dict[str, DataFrame]) -> Mapping[str, DataFrame]:
    """K1 + K3: node tables with unique keys (synthetic ``payment_id`` and
    ``item_id`` = ``order_id + '_' + sequence``), each made when it is first asked for."""
    cust = lambda: layer["customers"].select(_s("customer_id").alias("customer_id"),
                                     _s("customer_unique_id").alias("unique_id"),
                                     F.col("customer_city").alias("city"), F.col("customer_state").alias("state"),
                                     F.col("customer_zip_code_prefix").alias("zip_code"))
    orders = lambda: layer["orders"].select(_s("order_id").alias("order_id"), _s("customer_id").alias("customer_id"),
                                    F.col("order_status").alias("status"),
                                    F.col("order_purchase_timestamp").alias("purchase_timestamp"),
                                    F.col("order_delivered_customer_date").alias("delivered_customer_date"))
    items = lambda: layer["order_items"].select(
        F.concat(_s("order_id"), F.lit("_"), _s("order_item_id")).alias("item_id"), _s("order_id").alias("order_id"),
        _s("product_id").alias("product_id"), _s("seller_id").alias("seller_id"), "price", "freight_value",
        F.col("shipping_limit_date").alias("shipping_limit"))
    products = lambda: layer["products"].select(_s("product_id").alias("product_id"),
                                        F.col("product_category_name").alias("category"),
                                        F.col("product_weight_g").alias("weight_g"),
                                        F.col("product_photos_qty").alias("photos_qty"))
    sellers = lambda: layer["sellers"].select(_s("seller_id").alias("seller_id"), F.col("seller_city").alias("city"),
                                      F.col("seller_state").alias("state"),
                                      F.col("seller_zip_code_prefix").alias("zip_code"))
    payments = lambda: layer["payments"].select(
        F.concat(_s("order_id"), F.lit("_"), _s("payment_sequential")).alias("payment_id"),
        _s("order_id").alias("order_id"), F.col("payment_type").alias("type"),
        F.col("payment_installments").alias("installments"), F.col("payment_value").alias("value"))
    reviews = lambda: keep_first(layer["reviews"].select(_s("review_id").alias("review_id"), _s("order_id").alias("order_id"),
                                                 F.col("review_score").alias("score"),
                                                 F.col("review_comment_message").alias("comment"),
                                                 F.col("review_creation_date").alias("creation_date")),
                         ["review_id"])
    categories = lambda: layer["translation"].select(F.col("product_category_name").alias("name"),
                                             F.col("product_category_name_english").alias("name_en"))
    geo = lambda: zip_geo(layer["geolocation"]).select(
        F.col("geolocation_zip_code_prefix").alias("zip_code"), F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"), F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"))
    return Layer({"Customer": cust, "Order": orders, "OrderItem": items, "Product": products, "Seller": sellers,
            "Payment": payments, "Review": reviews, "Category": categories, "Geolocation": geo})


# Labels and their keys.
NODE_KEYS = {"Customer": "customer_id", "Order": "order_id", "OrderItem": "item_id", "Product": "product_id",
             "Seller": "seller_id", "Payment": "payment_id", "Review": "review_id", "Category": "name",
             "Geolocation": "zip_code"}


def node_keys(n: dict[str, DataFrame]) -> DataFrame:
    """K1 in long form: (label, node_key)."""
    parts = [df.select(F.lit(lbl).alias("label"), F.col(NODE_KEYS[lbl]).cast("string").alias("node_key"))
             for lbl, df in n.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Relations as (rel, from label, from column on the from-node, to label, reversed).
EDGE_DEFS = [
    ("PLACED", "Order", "customer_id", "Customer", True),
    ("CONTAINS", "OrderItem", "order_id", "Order", True),
    ("REFERENCES", "OrderItem", "product_id", "Product", False),
    ("FULFILLED_BY", "OrderItem", "seller_id", "Seller", False),
    ("PAID_WITH", "Payment", "order_id", "Order", True),
    ("HAS_REVIEW", "Review", "order_id", "Order", True),
    ("BELONGS_TO", "Product", "category", "Category", False),
    ("LOCATED_IN", "Customer", "zip_code", "Geolocation", False),
    ("LOCATED_IN", "Seller", "zip_code", "Geolocation", False),
]


def edges(n: dict[str, DataFrame]) -> DataFrame:
    """K2: ``(rel, src_label, src, dst_label, dst)``; an edge exists only if
    both ends exist (inner join on the node tables). ``reverse`` edges point from the referenced node (e.g.
    Customer -PLACED-> Order is found on the order row)."""
    parts = []
    for rel, holder, col, other, reverse in EDGE_DEFS:
        h = n[holder].select(F.col(NODE_KEYS[holder]).alias("_h"), F.col(col).cast("string").alias("_o"))
        o = n[other].select(F.col(NODE_KEYS[other]).cast("string").alias("_o"))
        # node keys are unique (silver keys, keep-first), so each holder row
        # yields exactly one edge: no distinct (and no extra shuffle) needed
        e = h.join(o, "_o")
        if reverse:
            parts.append(e.select(F.lit(rel).alias("rel"), F.lit(other).alias("src_label"), F.col("_o").alias("src"),
                                  F.lit(holder).alias("dst_label"), F.col("_h").alias("dst")))
        else:
            parts.append(e.select(F.lit(rel).alias("rel"), F.lit(holder).alias("src_label"), F.col("_h").alias("src"),
                                  F.lit(other).alias("dst_label"), F.col("_o").alias("dst")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Node tables that lie by another column than their key, so that what belongs to one order lies together.
NODE_CLUSTER = {"OrderItem": "order_id", "Payment": "order_id", "Review": "order_id"}


@dataclass
class Loaded:
    nodes: dict[str, DataFrame]
    edges: DataFrame


def load_nodes(spark: SparkSession, layer: dict[str, DataFrame], path: str, buckets: int = 16, prefix: str = "graph") -> dict[str, DataFrame]:
    """K1 as an idempotent load: one keyed table a label under ``path``; nodes that
    are there already stay, and only buckets with something new are written."""
    found = {}
    for label, df in nodes(layer).items():
        t = KeyedTable.open(spark, f"{prefix}_{label.lower()}", f"{path}/nodes/{label}", df.schema, [NODE_KEYS[label]],
                            NODE_CLUSTER.get(label), buckets)
        t.upsert(df)
        found[label] = t.rows()
    return found


def load(spark: SparkSession, layer: dict[str, DataFrame], path: str, buckets: int = 16, prefix: str = "graph",
         found: dict[str, DataFrame] | None = None) -> Loaded:
    """K1, K2: nodes, then the edges derived from the loaded nodes, in one keyed table by source."""
    found = found or load_nodes(spark, layer, path, buckets, prefix)
    e = edges(found)
    t = KeyedTable.open(spark, f"{prefix}_edges", f"{path}/edges", e.schema, ["rel", "src_label", "src", "dst"], "src", buckets)
    t.upsert(e)
    return Loaded(found, t.rows())


def label_counts(n: dict[str, DataFrame]) -> DataFrame:
    """K4: nodes per label."""
    return node_keys(n).groupBy("label").agg(F.count(F.lit(1)).alias("total"))


def rel_counts(e: DataFrame) -> DataFrame:
    """K4: edges per relation type."""
    return e.groupBy("rel").agg(F.count(F.lit(1)).alias("total"))


def _rel(e: DataFrame, rel: str, src: str, dst: str) -> DataFrame:
    return e.where(F.col("rel") == rel).select(F.col("src").alias(src), F.col("dst").alias(dst))


def path_sample(e: DataFrame, limit: int = 25) -> DataFrame:
    """K5: customer->order->item->product paths, first ``limit`` by keys."""
    p = (_rel(e, "PLACED", "customer", "order").join(_rel(e, "CONTAINS", "order", "item"), "order")
         .join(_rel(e, "REFERENCES", "item", "product"), "item"))
    order = [F.col("customer"), F.col("order"), F.col("item"), F.col("product")]
    return p.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")) \
        .select("rank", "customer", "order", "item", "product")


def _buyers(n: dict[str, DataFrame], *cols) -> DataFrame:
    """Orders (``order_id``) with ``cols`` of the customer that placed them."""
    c = n["Customer"].select("customer_id", *cols)
    return n["Order"].select("order_id", "customer_id").join(c, "customer_id").drop("customer_id")


def products_by_person(n: dict[str, DataFrame]) -> DataFrame:
    """K6: for every person, products bought with item price and the
    order's review scores (one row per item x review).

    The edges on these paths lie on the rows of the items, orders and reviews, and exist
    where both nodes do: each node table is joined once, no edge is built first."""
    items = n["OrderItem"].select(F.col("item_id").alias("item"), "order_id", "product_id", "price").where(F.col("item").isNotNull())
    reviews = n["Review"].select(F.col("review_id").alias("review"), "order_id", "score").where(F.col("review").isNotNull())
    return (items.join(_buyers(n, "unique_id"), "order_id").join(reviews, "order_id")
            .join(n["Product"].select("product_id", "category"), "product_id")
            .select("unique_id", "product_id", "category", "price", "score", "item", "review"))


def top_sellers_by_revenue(n: dict[str, DataFrame], e: DataFrame, k: int = 10) -> DataFrame:
    """K7: sellers by Σ item price, top k."""
    r = (_rel(e, "FULFILLED_BY", "item", "seller")
         .join(n["OrderItem"].select(F.col("item_id").alias("item"), fixed_point("price", 4).alias("_p")), "item")
         .groupBy("seller").agg((F.sum("_p") / F.lit(1e4)).alias("revenue"))
         .join(n["Seller"].select(F.col("seller_id").alias("seller"), "state"), "seller"))
    order = [F.col("revenue").desc(), F.col("seller")]
    return r.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")) \
        .select("rank", F.col("seller").alias("seller_id"), "state", np_round("revenue", 2).alias("revenue"))


def top_categories_by_review(n: dict[str, DataFrame], e: DataFrame, k: int = 15) -> DataFrame:
    """K8: categories by item-weighted mean review (2 decimals), top k."""
    # reviews of an order as sums first: items meet one row an order, however many reviews it has
    per_order = (_rel(e, "HAS_REVIEW", "order", "review")
                 .join(n["Review"].select(F.col("review_id").alias("review"), "score"), "review")
                 .groupBy("order").agg(F.sum(fixed_point("score", 4)).alias("_s"), F.count("score").alias("_n")))
    p = (_rel(e, "BELONGS_TO", "product", "category").join(_rel(e, "REFERENCES", "item", "product"), "product")
         .join(_rel(e, "CONTAINS", "order", "item"), "item").join(per_order, "order")
         .groupBy("category").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
         .join(n["Category"].select(F.col("name").alias("category"), "name_en"), "category"))
    mean = F.try_divide(F.sum("_s"), F.sum("_n")) / F.lit(1e4)
    agg = p.groupBy("name_en").agg(np_round(mean, 2).alias("avg_score"), F.sum("_n").alias("total_reviews"))
    order = [F.col("avg_score").desc(), F.col("total_reviews").desc(), F.col("name_en")]
    return agg.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")) \
        .select("rank", F.col("name_en").alias("category"), "avg_score", "total_reviews")


def multi_state_buyers(n: dict[str, DataFrame], min_states: int = 3) -> DataFrame:
    """K9 (A16): customers whose items came from sellers in more than
    ``min_states - 1`` states; the distinct states (bounded by the number of
    states) as a sorted list."""
    items = n["OrderItem"].where(F.col("item_id").isNotNull()).select("order_id", "seller_id")
    sellers = n["Seller"].where(F.col("state").isNotNull()).select("seller_id", F.col("state").alias("seller_state"))
    # an order's item rows of one state count once: the pairs are made different before they meet the buyers
    p = (items.join(sellers, "seller_id").select("order_id", "seller_state").distinct()
         .join(_buyers(n, F.col("customer_id").alias("customer")), "order_id"))
    agg = p.groupBy("customer").agg(F.sort_array(F.collect_set("seller_state")).alias("_st"))
    return (agg.where(F.size("_st") >= min_states)
            .join(n["Customer"].select(F.col("customer_id").alias("customer"), F.col("state").alias("customer_state")),
                  "customer")
            .select(F.col("customer").alias("customer_id"), "customer_state", F.size("_st").cast("bigint").alias("n_states"),
                    F.array_join("_st", ",").alias("states")))


def expensive_freight(n: dict[str, DataFrame]) -> DataFrame:
    """Items whose freight exceeds the price; count, mean difference."""
    i = n["OrderItem"].where(F.col("freight_value") > F.col("price"))
    return i.agg(F.count(F.lit(1)).alias("items"),
                 np_round(exact_mean(F.col("freight_value") - F.col("price"), 4), 2).alias("avg_difference"))


def category_sales(layer: dict[str, DataFrame]) -> DataFrame:
    """Items sold, revenue and average item ticket per category."""
    cats = layer["products"].select("product_id", "product_category_name").join(
        layer["translation"], "product_category_name", "left")
    i = layer["order_items"].join(cats, "product_id", "left").where(F.col("product_category_name_english").isNotNull())
    return i.groupBy("product_category_name_english").agg(
        F.count(F.lit(1)).alias("items"), np_round(F.sum(fixed_point("price", 4)) / F.lit(1e4), 2).alias("revenue"),
        np_round(exact_mean("price", 4), 2).alias("avg_ticket"))


def category_pairs(layer: dict[str, DataFrame], bucket_rows: int = 2048) -> DataFrame:
    """K12 (J7 at category grain): orders containing both categories, a < b."""
    basket = (layer["order_items"].select("order_id", "product_id")
              .join(layer["products"].select("product_id", "product_category_name"), "product_id")
              .select("order_id", "product_category_name").where(F.col("product_category_name").isNotNull()).distinct())
    pairs = pairs_within(basket, "order_id", "product_category_name", bucket_rows, "category_a", "category_b")
    return pairs.groupBy("category_a", "category_b").agg(F.count(F.lit(1)).alias("orders"))


def state_tickets(layer: dict[str, DataFrame]) -> DataFrame:
    """Orders, average item ticket and freight per buyer state."""
    i = (layer["order_items"].join(layer["orders"].select("order_id", "customer_id"), "order_id")
         .join(layer["customers"].select("customer_id", "customer_state"), "customer_id")
         .where(F.col("customer_state").isNotNull()))
    return i.groupBy("customer_state").agg(
        F.count_distinct("order_id").alias("orders"), np_round(exact_mean("price", 4), 2).alias("avg_ticket"),
        np_round(exact_mean("freight_value", 4), 2).alias("avg_freight"))


def payment_revenue(layer: dict[str, DataFrame]) -> DataFrame:
    """Σ payment value per method."""
    return (layer["payments"].where(F.col("payment_type").isNotNull()).groupBy("payment_type")
            .agg(np_round(F.sum(fixed_point("payment_value", 4)) / F.lit(1e4), 2).alias("revenue")))
