"""Oracle SQL for the quality queries (Q1-Q5)."""

from __future__ import annotations

from oracles.base import npr

ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
             "total_item_value", "is_price_outlier"]
PRODUCT_COLS = ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
GOLD_TABLES = {
    "user_product_interactions": ("g_interactions", 8),
    "product_features": ("g_product_features", 10),
    "customer_profile": ("g_customer_profile", 11),
    "category_affinity": ("g_category_affinity", 6),
    "product_cooccurrence": ("g_product_cooccurrence", 6),
    "top_products_by_segment": ("g_top_products_by_segment", 9),
}
GOLD_COLUMNS = {
    "g_interactions": ["customer_unique_id", "product_id", "product_category_name_english", "purchase_count",
                       "total_spent", "review_score", "sentiment", "implicit_score"],
    "g_product_features": ["product_id", "product_category_name", "product_category_name_english", "avg_price",
                           "avg_freight_value", "total_orders", "avg_review_score", "total_reviews",
                           "positive_sentiment_ratio", "seller_state"],
    "g_customer_profile": ["customer_unique_id", "customer_city", "customer_state", "total_orders", "avg_delivery_days",
                           "is_late_buyer_pct", "total_spent", "avg_review_score", "preferred_category",
                           "preferred_payment_type", "avg_installments"],
    "g_category_affinity": ["customer_unique_id", "product_category_name_english", "purchase_count", "total_spent",
                            "avg_review_score", "affinity_score"],
    "g_product_cooccurrence": ["product_id_a", "product_id_b", "category_a", "category_b", "cooccurrence_count",
                               "cooccurrence_score"],
    "g_top_products_by_segment": ["segment_type", "segment_value", "rank", "product_id",
                                  "product_category_name_english", "avg_review_score", "avg_price", "total_orders",
                                  "positive_sentiment_ratio"],
}


def _profile_all() -> str:
    """Every mapped and every cleaned table, whatever its columns."""
    parts = []
    for when, prefix in (("before", "m"), ("after", "s")):
        for t in ("customers", "sellers", "translation", "products", "orders", "order_items", "payments", "reviews",
                  "geolocation"):
            parts.append(f"""SELECT '{when}.{t}' AS "table", "column", nulls, (SELECT count(*) FROM {prefix}_{t}) AS rows,
              count(*) OVER () AS columns,
              (SELECT count(*) FROM {prefix}_{t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {prefix}_{t})) AS duplicate_rows
            FROM (UNPIVOT (SELECT count(CASE WHEN COLUMNS('(.*)') IS NULL THEN 1 END) AS "\\1" FROM {prefix}_{t})
                  ON COLUMNS(*) INTO NAME "column" VALUE nulls)""")
    return "\nUNION ALL\n".join(parts)


def _q1() -> str:
    parts = [f"SELECT 'order_items' AS \"table\", '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
             f"count(*) AS rows, CAST({len(ITEM_COLS)} AS BIGINT) AS columns, "
             f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s_order_items)) AS duplicate_rows "
             f"FROM s_order_items" for c in ITEM_COLS]
    return "\nUNION ALL\n".join(parts)


def _q2() -> str:
    parts = []
    for stage, src in (("before", "m_products"), ("after", "s_products")):
        for c in PRODUCT_COLS:
            parts.append(f"SELECT '{stage}' AS stage, '{c}' AS \"column\", "
                         f"{npr(f'avg(CAST({c} IS NULL AS DOUBLE))', 6)} AS missing_share FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _q2s() -> str:
    mean = " + ".join(f"avg(CAST({c} IS NULL AS DOUBLE))" for c in PRODUCT_COLS)
    return f"SELECT {npr(f'100.0 * (1.0 - (0.0 + {mean}) / {float(len(PRODUCT_COLS))})', 6)} AS quality_score FROM s_products"


def _q3() -> str:
    parts = []
    for name, (src, ncols) in GOLD_TABLES.items():
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in GOLD_COLUMNS[src])
        parts.append(f"SELECT '{name}' AS \"table\", count(*) AS rows, CAST({ncols} AS BIGINT) AS columns, "
                     f"CAST({nulls} AS BIGINT) AS total_nulls FROM {src}")
    return "\nUNION ALL\n".join(parts)


Q = {
    "q1_profile_all": _profile_all(),
    "q1_profile_items": _q1(),
    "q2_missing_share": _q2(),
    "q2_quality_score": _q2s(),
    "q3_layer_overview": _q3(),
    "q4_rules": """
      SELECT 'implicit_score in range' AS "check", count(*) FILTER (WHERE implicit_score < 0) = 0 AS passed,
        CAST(count(*) FILTER (WHERE implicit_score < 0) AS VARCHAR) AS detail FROM g_interactions
      UNION ALL SELECT 'no null customer_unique_id', count(*) FILTER (WHERE customer_unique_id IS NULL) = 0,
        CAST(count(*) FILTER (WHERE customer_unique_id IS NULL) AS VARCHAR) FROM g_interactions
      UNION ALL SELECT 'no null product_id', count(*) FILTER (WHERE product_id IS NULL) = 0,
        CAST(count(*) FILTER (WHERE product_id IS NULL) AS VARCHAR) FROM g_interactions
      UNION ALL SELECT 'affinity_score in [0, 1]', count(*) FILTER (WHERE affinity_score < 0 OR affinity_score > 1) = 0,
        CAST(count(*) FILTER (WHERE affinity_score < 0 OR affinity_score > 1) AS VARCHAR) FROM g_category_affinity
      UNION ALL SELECT 'global segment present', count(*) FILTER (WHERE segment_type = 'global') > 0,
        CAST(count(*) FILTER (WHERE segment_type = 'global') AS VARCHAR) FROM g_top_products_by_segment
      UNION ALL SELECT 'states covered', count(DISTINCT segment_value) FILTER (WHERE segment_type = 'state') >= 25,
        CAST(count(DISTINCT segment_value) FILTER (WHERE segment_type = 'state') AS VARCHAR) FROM g_top_products_by_segment
      UNION ALL SELECT 'cooccurrence_score in [0, 1]',
        count(*) FILTER (WHERE cooccurrence_score < 0 OR cooccurrence_score > 1) = 0,
        CAST(count(*) FILTER (WHERE cooccurrence_score < 0 OR cooccurrence_score > 1) AS VARCHAR) FROM g_product_cooccurrence""",
    "q5_customer_assertions": """
      SELECT 'state length <= 2' AS "check", count(*) FILTER (WHERE length(customer_state) > 2) = 0 AS passed,
        CAST(count(*) FILTER (WHERE length(customer_state) > 2) AS VARCHAR) AS detail FROM s_customers
      UNION ALL SELECT 'zip length = 5', count(*) FILTER (WHERE coalesce(length(customer_zip_code_prefix) <> 5, true)) = 0,
        CAST(count(*) FILTER (WHERE coalesce(length(customer_zip_code_prefix) <> 5, true)) AS VARCHAR) FROM s_customers""",
}
