"""Oracle CTEs for the gold tables, written the way the reference computes
them (item x review fan-out joins, explicit top-1 windows)."""

from __future__ import annotations

from oracles.base import cents_sum, npr

D = "CAST({} AS DOUBLE)".format

GOLD = f"""
g_cat AS (
  SELECT p.product_id, p.product_category_name, t.product_category_name_english
  FROM s_products p LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
),
g_op AS (
  SELECT o.order_id, c.customer_unique_id, c.customer_state
  FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
),
g_it AS (
  SELECT i.order_id, i.product_id, i.seller_id, i.price, i.freight_value, i.total_item_value,
    op.customer_unique_id, op.customer_state
  FROM s_order_items i LEFT JOIN g_op op ON i.order_id = op.order_id
),
g_itr AS (
  SELECT it.*, r.review_score, r.sentiment FROM g_it it LEFT JOIN s_reviews r ON it.order_id = r.order_id
),
g_interactions AS (
  SELECT a.customer_unique_id, a.product_id, cat.product_category_name_english, a.purchase_count, a.total_spent,
    ra.review_score, sm.sentiment,
    a.purchase_count * CAST(1.0 AS DOUBLE) + coalesce(ra.review_score, CAST(3.0 AS DOUBLE)) / CAST(5.0 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS implicit_score
  FROM (SELECT customer_unique_id, product_id, count(order_id) AS purchase_count,
          {cents_sum('total_item_value')} AS total_spent
        FROM g_it WHERE customer_unique_id IS NOT NULL AND product_id IS NOT NULL GROUP BY 1, 2) a
  LEFT JOIN (SELECT customer_unique_id, product_id, avg(review_score) AS review_score FROM g_itr
             WHERE customer_unique_id IS NOT NULL AND product_id IS NOT NULL GROUP BY 1, 2) ra
    ON a.customer_unique_id = ra.customer_unique_id AND a.product_id = ra.product_id
  LEFT JOIN (SELECT customer_unique_id, product_id, sentiment FROM (
               SELECT customer_unique_id, product_id, sentiment,
                 row_number() OVER (PARTITION BY customer_unique_id, product_id ORDER BY count(*) DESC, sentiment) AS rn
               FROM g_itr WHERE customer_unique_id IS NOT NULL AND product_id IS NOT NULL AND sentiment IS NOT NULL
               GROUP BY 1, 2, 3) WHERE rn = 1) sm
    ON a.customer_unique_id = sm.customer_unique_id AND a.product_id = sm.product_id
  LEFT JOIN g_cat cat ON a.product_id = cat.product_id
),
g_product_features AS (
  SELECT cat.product_id, cat.product_category_name, cat.product_category_name_english,
    {npr('s.avg_price', 4)} AS avg_price, {npr('s.avg_freight_value', 4)} AS avg_freight_value, s.total_orders,
    {npr('r.avg_review_score', 4)} AS avg_review_score, r.total_reviews,
    {npr('r.positive_sentiment_ratio', 4)} AS positive_sentiment_ratio, ms.seller_state
  FROM g_cat cat
  LEFT JOIN (SELECT product_id,
      CAST(sum(CAST(round_even(price * 100.0, 0) AS BIGINT)) AS DOUBLE) / count(price) / CAST(100.0 AS DOUBLE) AS avg_price,
      CAST(sum(CAST(round_even(freight_value * 100.0, 0) AS BIGINT)) AS DOUBLE) / count(freight_value) / CAST(100.0 AS DOUBLE) AS avg_freight_value,
      count(order_id) AS total_orders
    FROM g_it WHERE product_id IS NOT NULL GROUP BY 1) s ON cat.product_id = s.product_id
  LEFT JOIN (SELECT product_id, avg(review_score) AS avg_review_score, count(review_score) AS total_reviews,
      CAST(sum(CASE WHEN sentiment = 'positivo' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS positive_sentiment_ratio
    FROM g_itr WHERE product_id IS NOT NULL GROUP BY 1) r ON cat.product_id = r.product_id
  LEFT JOIN (SELECT m.product_id, sl.seller_state FROM (
      SELECT product_id, seller_id, row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, seller_id) AS rn
      FROM g_it WHERE product_id IS NOT NULL AND seller_id IS NOT NULL GROUP BY 1, 2) m
      LEFT JOIN s_sellers sl ON m.seller_id = sl.seller_id WHERE m.rn = 1) ms ON cat.product_id = ms.product_id
),
g_ocust AS (
  SELECT o.order_id, o.delivery_days, o.is_late, c.customer_unique_id
  FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
),
g_customer_profile AS (
  SELECT sp.customer_unique_id, sp.customer_city, sp.customer_state, oa.total_orders,
    {npr('oa.avg_delivery_days', 4)} AS avg_delivery_days, {npr('oa.is_late_buyer_pct', 4)} AS is_late_buyer_pct,
    {npr('sd.total_spent', 4)} AS total_spent, {npr('rv.avg_review_score', 4)} AS avg_review_score,
    cp.preferred_category, pp.preferred_payment_type, {npr('pi.avg_installments', 4)} AS avg_installments
  FROM (SELECT customer_unique_id, customer_city, customer_state FROM (
          SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) AS rn FROM s_customers)
        WHERE rn = 1) sp
  LEFT JOIN (SELECT customer_unique_id, count(order_id) AS total_orders, avg(delivery_days) AS avg_delivery_days,
               avg(CAST(is_late AS INTEGER)) AS is_late_buyer_pct
             FROM g_ocust WHERE customer_unique_id IS NOT NULL GROUP BY 1) oa USING (customer_unique_id)
  LEFT JOIN (SELECT customer_unique_id, coalesce(sum(CAST(round_even(total_item_value * 100.0, 0) AS BIGINT)), 0) / CAST(100.0 AS DOUBLE) AS total_spent
             FROM g_it WHERE customer_unique_id IS NOT NULL GROUP BY 1) sd USING (customer_unique_id)
  LEFT JOIN (SELECT op.customer_unique_id, avg(r.review_score) AS avg_review_score
             FROM s_reviews r LEFT JOIN g_op op ON r.order_id = op.order_id
             WHERE op.customer_unique_id IS NOT NULL GROUP BY 1) rv USING (customer_unique_id)
  LEFT JOIN (SELECT customer_unique_id, preferred_category FROM (
               SELECT it.customer_unique_id, cat.product_category_name_english AS preferred_category,
                 row_number() OVER (PARTITION BY it.customer_unique_id ORDER BY count(*) DESC, cat.product_category_name_english) AS rn
               FROM g_it it LEFT JOIN g_cat cat ON it.product_id = cat.product_id
               WHERE it.customer_unique_id IS NOT NULL AND cat.product_category_name_english IS NOT NULL
               GROUP BY 1, 2) WHERE rn = 1) cp USING (customer_unique_id)
  LEFT JOIN (SELECT customer_unique_id, preferred_payment_type FROM (
               SELECT op.customer_unique_id, p.payment_type AS preferred_payment_type,
                 row_number() OVER (PARTITION BY op.customer_unique_id ORDER BY count(*) DESC, p.payment_type) AS rn
               FROM s_payments p LEFT JOIN g_op op ON p.order_id = op.order_id
               WHERE op.customer_unique_id IS NOT NULL AND p.payment_type IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) pp
    USING (customer_unique_id)
  LEFT JOIN (SELECT op.customer_unique_id, avg(p.payment_installments) AS avg_installments
             FROM s_payments p LEFT JOIN g_op op ON p.order_id = op.order_id
             WHERE op.customer_unique_id IS NOT NULL GROUP BY 1) pi USING (customer_unique_id)
),
g_aff0 AS (
  SELECT it.customer_unique_id, cat.product_category_name_english, count(it.order_id) AS purchase_count,
    coalesce(sum(CAST(round_even(it.total_item_value * 100.0, 0) AS BIGINT)), 0) / CAST(100.0 AS DOUBLE) AS total_spent,
    avg(r.review_score) AS avg_review_score
  FROM g_it it LEFT JOIN g_cat cat ON it.product_id = cat.product_id LEFT JOIN s_reviews r ON it.order_id = r.order_id
  WHERE it.customer_unique_id IS NOT NULL AND cat.product_category_name_english IS NOT NULL
  GROUP BY 1, 2
),
g_aff1 AS (
  SELECT *, coalesce(avg_review_score, CAST(3.0 AS DOUBLE)) AS rf,
    min(purchase_count) OVER w AS p0, max(purchase_count) OVER w AS p1,
    min(total_spent) OVER w AS s0, max(total_spent) OVER w AS s1,
    min(coalesce(avg_review_score, CAST(3.0 AS DOUBLE))) OVER w AS r0,
    max(coalesce(avg_review_score, CAST(3.0 AS DOUBLE))) OVER w AS r1
  FROM g_aff0 WINDOW w AS (PARTITION BY customer_unique_id)
),
g_category_affinity AS (
  SELECT customer_unique_id, product_category_name_english, purchase_count, total_spent, avg_review_score,
    {npr('''(CASE WHEN p1 = p0 THEN CAST(0.0 AS DOUBLE) ELSE (purchase_count - p0) / (p1 - p0) END) * CAST(0.5 AS DOUBLE)
      + (CASE WHEN s1 = s0 THEN CAST(0.0 AS DOUBLE) ELSE (total_spent - s0) / (s1 - s0) END) * CAST(0.3 AS DOUBLE)
      + (CASE WHEN r1 = r0 THEN CAST(0.0 AS DOUBLE) ELSE (rf - r0) / (r1 - r0) END) * CAST(0.2 AS DOUBLE)''', 4)} AS affinity_score
  FROM g_aff1
),
g_basket AS (
  SELECT DISTINCT order_id, product_id FROM s_order_items
  WHERE product_id IS NOT NULL AND order_id IN (
    SELECT order_id FROM s_order_items GROUP BY order_id HAVING count(product_id) > 1)
),
g_product_cooccurrence AS (
  SELECT c.a AS product_id_a, c.b AS product_id_b, ca.product_category_name_english AS category_a,
    cb.product_category_name_english AS category_b, c.n AS cooccurrence_count,
    {npr('c.n / (coalesce(fa.n, 1) + coalesce(fb.n, 1) - c.n)', 6)} AS cooccurrence_score
  FROM (SELECT x.product_id AS a, y.product_id AS b, count(*) AS n
        FROM g_basket x JOIN g_basket y ON x.order_id = y.order_id AND x.product_id < y.product_id GROUP BY 1, 2) c
  LEFT JOIN (SELECT product_id, count(*) AS n FROM g_basket GROUP BY 1) fa ON c.a = fa.product_id
  LEFT JOIN (SELECT product_id, count(*) AS n FROM g_basket GROUP BY 1) fb ON c.b = fb.product_id
  LEFT JOIN g_cat ca ON c.a = ca.product_id
  LEFT JOIN g_cat cb ON c.b = cb.product_id
),
g_seg AS (
  SELECT 'global' AS segment_type, 'all' AS segment_value, it.order_id, it.product_id FROM g_it it
  UNION ALL
  SELECT 'state', it.customer_state, it.order_id, it.product_id FROM g_it it WHERE it.customer_state IS NOT NULL
  UNION ALL
  SELECT 'category', cat.product_category_name_english, it.order_id, it.product_id
  FROM g_it it JOIN g_cat cat ON it.product_id = cat.product_id WHERE cat.product_category_name_english IS NOT NULL
),
g_top_products_by_segment AS (
  SELECT segment_type, segment_value, rank, product_id, product_category_name_english, avg_review_score, avg_price,
    total_orders, positive_sentiment_ratio FROM (
    SELECT s.segment_type, s.segment_value, s.product_id, pf.product_category_name_english, pf.avg_review_score,
      pf.avg_price, pf.total_orders, pf.positive_sentiment_ratio,
      row_number() OVER (PARTITION BY s.segment_type, s.segment_value
                         ORDER BY s.so DESC, pf.avg_review_score DESC NULLS LAST, s.product_id) AS rank
    FROM (SELECT segment_type, segment_value, product_id, count(order_id) AS so FROM g_seg
          WHERE product_id IS NOT NULL GROUP BY 1, 2, 3) s
    LEFT JOIN g_product_features pf ON s.product_id = pf.product_id)
  WHERE rank <= 10
)"""

# column -> contract type, for the two contracted tables
CONTRACT_COLUMNS = {
    "user_product_interactions": [
        ("customer_unique_id", "integer"), ("product_id", "integer"), ("product_category_name_english", "string"),
        ("purchase_count", "integer"), ("total_spent", "float"), ("review_score", "float"), ("sentiment", "string"),
        ("implicit_score", "float")],
    "product_features": [
        ("product_id", "integer"), ("product_category_name", "string"), ("product_category_name_english", "string"),
        ("avg_price", "float"), ("avg_freight_value", "float"), ("total_orders", "integer"),
        ("avg_review_score", "float"), ("total_reviews", "integer"), ("positive_sentiment_ratio", "float"),
        ("seller_state", "string")],
}


def contract_sql() -> str:
    parts = []
    for table, cols in CONTRACT_COLUMNS.items():
        src = f"g_{'interactions' if table == 'user_product_interactions' else table}"
        for c, kind in cols:
            if kind in ("float", "integer"):
                lo, hi = npr(f"min({c})", 4), npr(f"max({c})", 4)
            else:
                lo = hi = "CAST(NULL AS DOUBLE)"
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS type, "
                         f"count(*) FILTER (WHERE {c} IS NULL) > 0 AS nullable, {lo} AS min, {hi} AS max, "
                         f"count(*) AS row_count, CAST({len(cols)} AS BIGINT) AS column_count FROM {src}")
    return "\nUNION ALL\n".join(parts)
