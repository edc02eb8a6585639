"""Oracle SQL for explorations (E), dashboards (D) and graph queries (K)."""

from __future__ import annotations

from oracles.base import days, npr

DBL = "CAST({} AS DOUBLE)".format


def hist(src: str, col: str, bins: int) -> str:
    """Fixed-width histogram over [min, max], last bin closed, non-empty bins."""
    x = f"CAST({col} AS DOUBLE)"
    w = f"((s.hi - s.lo) / {DBL(str(float(bins)))})"
    b = f"CAST(CASE WHEN s.hi = s.lo THEN 0 ELSE least(floor(({x} - s.lo) / {w}), {bins - 1}) END AS INTEGER)"
    return (f"SELECT bin, lo + bin * ((hi - lo) / {DBL(str(float(bins)))}) AS bin_start, "
            f"lo + (bin + 1) * ((hi - lo) / {DBL(str(float(bins)))}) AS bin_end, count(*) AS count FROM ("
            f"SELECT {b} AS bin, s.lo, s.hi FROM (SELECT * FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({x})) d, "
            f"(SELECT {DBL(f'min({col})')} AS lo, {DBL(f'max({col})')} AS hi FROM {src} "
            f"WHERE {col} IS NOT NULL AND NOT isnan({x})) s "
            f"WHERE {x} >= s.lo AND {x} <= s.hi) GROUP BY bin, lo, hi")


def vc(src: str, col: str, name: str | None = None) -> str:
    name = name or col
    return (f"SELECT {col} AS {name}, count(*) AS count, count(*) * {DBL('100.0')} / sum(count(*)) OVER () AS share_pct "
            f"FROM {src} WHERE {col} IS NOT NULL GROUP BY 1")


def top_counts(src: str, col: str, n: int) -> str:
    return (f"SELECT * FROM (SELECT {col}, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, {col}) AS rank "
            f"FROM {src} WHERE {col} IS NOT NULL GROUP BY 1) WHERE rank <= {n}")


def xmean(col: str, d: int) -> str:
    s = f"{10 ** d}.0"
    return f"(CAST(sum(CAST(round_even({col} * {s}, 0) AS BIGINT)) AS DOUBLE) / count({col}) / {DBL(s)})"


def fsum(col: str, d: int) -> str:
    s = f"{10 ** d}.0"
    return f"(CAST(sum(CAST(round_even({col} * {s}, 0) AS BIGINT)) AS DOUBLE) / {DBL(s)})"


SALES = ("(SELECT i.*, c.customer_state FROM s_order_items i JOIN s_orders o ON i.order_id = o.order_id "
         "JOIN s_customers c ON o.customer_id = c.customer_id)")
REAL = days("order_purchase_timestamp", "order_delivered_customer_date")
EST = days("order_purchase_timestamp", "order_estimated_delivery_date")
E5 = (f"(SELECT * FROM (SELECT order_id, is_late, {REAL} AS real_days, {EST} AS estimated_days FROM s_orders) "
      f"WHERE real_days IS NOT NULL AND estimated_days IS NOT NULL)")
HOURS = "(datediff('microsecond', order_purchase_timestamp, order_approved_at) / 3600000000.0)"
APPROVAL = f"(SELECT {HOURS} AS h, strftime(order_approved_at, '%Y-%m') AS month_year FROM s_orders)"
DTA = days("order_approved_at", "order_delivered_customer_date")

# State capitals (accent-free, lower case).
CAPITALS = [("AC", "rio branco"), ("AL", "maceio"), ("AP", "macapa"), ("AM", "manaus"), ("BA", "salvador"),
            ("CE", "fortaleza"), ("DF", "brasilia"), ("ES", "vitoria"), ("GO", "goiania"), ("MA", "sao luis"),
            ("MT", "cuiaba"), ("MS", "campo grande"), ("MG", "belo horizonte"), ("PA", "belem"),
            ("PB", "joao pessoa"), ("PR", "curitiba"), ("PE", "recife"), ("PI", "teresina"),
            ("RJ", "rio de janeiro"), ("RN", "natal"), ("RS", "porto alegre"), ("RO", "porto velho"),
            ("RR", "boa vista"), ("SC", "florianopolis"), ("SP", "sao paulo"), ("SE", "aracaju"), ("TO", "palmas")]
CAP_VALUES = ", ".join(f"('{s}', '{c}')" for s, c in CAPITALS)

E = {
    "e1_revenue_by_state": f"""SELECT customer_state, revenue, row_number() OVER (ORDER BY revenue DESC, customer_state) AS rank
      FROM (SELECT customer_state, {fsum('price', 2)} AS revenue FROM {SALES} WHERE customer_state IS NOT NULL GROUP BY 1)""",
    "e2_order_status": vc("s_orders", "order_status"),
    "e3_delivery_days_by_state": f"""SELECT customer_state, avg_delivery_days,
        row_number() OVER (ORDER BY avg_delivery_days DESC, customer_state) AS rank FROM (
        SELECT c.customer_state, {npr('avg(o.real_days)', 6)} AS avg_delivery_days
        FROM (SELECT customer_id, {REAL} AS real_days FROM s_orders) o JOIN s_customers c ON o.customer_id = c.customer_id
        WHERE o.real_days IS NOT NULL AND c.customer_state IS NOT NULL GROUP BY 1)""",
    "e4_late_days_histogram": hist(
        f"(SELECT {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS d FROM s_orders "
        f"WHERE {days('order_estimated_delivery_date', 'order_delivered_customer_date')} > 0)", "d", 50),
    "e5_estimated_vs_real": f"""SELECT e.*, a.axis_max FROM {E5} e,
        (SELECT greatest(max(estimated_days), max(real_days)) AS axis_max FROM {E5}) a""",
    "e6_late_rate_by_state": f"""SELECT * FROM (SELECT customer_state, total_orders, total_late, late_rate_pct,
        row_number() OVER (ORDER BY late_rate_pct DESC, customer_state) AS rank FROM (
        SELECT c.customer_state, count(e.is_late) AS total_orders, count(*) FILTER (WHERE e.is_late) AS total_late,
          {npr(f"count(*) FILTER (WHERE e.is_late) * {DBL('100.0')} / count(e.is_late)", 6)} AS late_rate_pct
        FROM {E5} e JOIN s_orders o ON e.order_id = o.order_id JOIN s_customers c ON o.customer_id = c.customer_id
        WHERE c.customer_state IS NOT NULL GROUP BY 1 HAVING count(e.is_late) > 100)) WHERE rank <= 5""",
    "e7_purchases_by_weekday": """SELECT cal.weekday_index, cal.weekday, cal.weekday_label, c.purchases
        FROM (VALUES (0, 'Monday', 'Segunda'), (1, 'Tuesday', 'Terça'), (2, 'Wednesday', 'Quarta'),
              (3, 'Thursday', 'Quinta'), (4, 'Friday', 'Sexta'), (5, 'Saturday', 'Sábado'), (6, 'Sunday', 'Domingo'))
             cal(weekday_index, weekday, weekday_label)
        LEFT JOIN (SELECT CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS weekday_index, count(*) AS purchases
                   FROM s_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1) c
        ON cal.weekday_index = c.weekday_index""",
    "e8_late_pct_by_month": f"""SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month,
        {npr(f"avg(CAST(is_late AS INTEGER)) * {DBL('100.0')}", 6)} AS late_pct FROM s_orders GROUP BY 1""",
    "e9_approval_outliers": f"""SELECT month_year, outliers, regulars, out_min, out_q1, out_median, out_q3, out_max,
        outlier_ratio_pct FROM (
        SELECT t.month_year,
          count(*) FILTER (WHERE t.h < f.lo OR t.h > f.hi) AS outliers,
          count(*) FILTER (WHERE t.h >= f.lo AND t.h <= f.hi) AS regulars,
          {npr('min(t.h) FILTER (WHERE t.h < f.lo OR t.h > f.hi)', 6)} AS out_min,
          {npr('quantile_cont(t.h, 0.25) FILTER (WHERE t.h < f.lo OR t.h > f.hi)', 6)} AS out_q1,
          {npr('quantile_cont(t.h, 0.5) FILTER (WHERE t.h < f.lo OR t.h > f.hi)', 6)} AS out_median,
          {npr('quantile_cont(t.h, 0.75) FILTER (WHERE t.h < f.lo OR t.h > f.hi)', 6)} AS out_q3,
          {npr('max(t.h) FILTER (WHERE t.h < f.lo OR t.h > f.hi)', 6)} AS out_max,
          {npr(f"CASE WHEN count(*) FILTER (WHERE t.h >= f.lo AND t.h <= f.hi) = 0 THEN NULL ELSE count(*) FILTER (WHERE t.h < f.lo OR t.h > f.hi) * {DBL('100.0')} / count(*) FILTER (WHERE t.h >= f.lo AND t.h <= f.hi) END", 6)} AS outlier_ratio_pct
        FROM (SELECT * FROM {APPROVAL} WHERE h IS NOT NULL) t,
          (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
             SELECT quantile_cont(h, 0.25) AS q1, quantile_cont(h, 0.75) AS q3 FROM {APPROVAL})) f
        GROUP BY 1) WHERE outliers > 0""",
    "e10_days_to_arrive": f"""SELECT days_capped, count(*) AS count FROM (
        SELECT CASE WHEN d IS NULL THEN NULL ELSE least(greatest(d, 0), 50) END AS days_capped
        FROM (SELECT {DTA} AS d FROM s_orders)) WHERE days_capped IS NOT NULL GROUP BY 1""",
    "e10_undelivered": f"""SELECT count(*) AS total_orders, count(*) FILTER (WHERE d IS NULL) AS undelivered,
        {npr(f"count(*) FILTER (WHERE d IS NULL) * {DBL('100.0')} / count(*)", 6)} AS undelivered_pct
        FROM (SELECT {DTA} AS d FROM s_orders)""",
    "e11_capital_share": vc(f"""(SELECT CASE WHEN c.capital = strip_accents(lower(g.geolocation_city)) THEN 'Capital'
        ELSE 'Interior' END AS location FROM s_geolocation g LEFT JOIN (VALUES {CAP_VALUES}) c(st, capital)
        ON g.geolocation_state = c.st)""", "location"),
    "e12_interaction_stats": f"""SELECT count(implicit_score) AS count, {npr('avg(implicit_score)', 6)} AS mean,
        {npr('stddev_samp(implicit_score)', 6)} AS std, {npr('min(implicit_score)', 6)} AS min,
        {npr('quantile_cont(implicit_score, 0.25)', 6)} AS p25, {npr('quantile_cont(implicit_score, 0.5)', 6)} AS p50,
        {npr('quantile_cont(implicit_score, 0.75)', 6)} AS p75, {npr('max(implicit_score)', 6)} AS max,
        count(DISTINCT customer_unique_id) AS unique_users, count(DISTINCT product_id) AS unique_products,
        count(review_score) AS reviews_present, {npr(f"count(review_score) * {DBL('100.0')} / count(*)", 6)} AS reviews_pct
        FROM g_interactions""",
    "e12_implicit_histogram": hist("g_interactions", "implicit_score", 30),
    "e12_sentiment_mix": vc("g_interactions", "sentiment"),
    "e12_top_categories": top_counts("g_interactions", "product_category_name_english", 10),
    "e13_product_stats": f"""SELECT count(*) AS products, count(DISTINCT product_category_name_english) AS categories,
        {npr(xmean('avg_price', 4), 6)} AS mean_price, {npr(xmean('avg_review_score', 4), 6)} AS mean_review
        FROM g_product_features""",
    "e13_price_histogram": hist(f"""(SELECT CASE WHEN g.avg_price IS NULL THEN NULL ELSE least(g.avg_price, p.p) END AS avg_price
        FROM g_product_features g, (SELECT {npr('quantile_cont(avg_price, 0.95)', 6)} AS p FROM g_product_features) p)""",
                                "avg_price", 40),
    "e13_score_histogram": hist("g_product_features", "avg_review_score", 20),
    "e13_top_products": """SELECT *, concat(substr(CAST(product_id AS VARCHAR), 1, 8), '...') AS product_id_short FROM (
        SELECT product_id, product_category_name_english, total_orders, avg_review_score, avg_price,
          row_number() OVER (ORDER BY total_orders DESC, product_id) AS rank
        FROM g_product_features WHERE total_orders IS NOT NULL) WHERE rank <= 10""",
    "e14_customer_stats": f"""SELECT count(*) AS customers, count(DISTINCT customer_state) AS states,
        {npr(xmean('total_spent', 4), 6)} AS mean_spent FROM g_customer_profile""",
    "e14_top_states": top_counts("g_customer_profile", "customer_state", 15),
    "e14_top_preferred_categories": top_counts("g_customer_profile", "preferred_category", 10),
    "e14_payment_mix": vc("g_customer_profile", "preferred_payment_type"),
    "e14_installments_histogram": hist("g_customer_profile", "avg_installments", 20),
    "e15_affinity_stats": """SELECT count(*) AS pairs, count(DISTINCT product_category_name_english) AS categories,
        min(affinity_score) AS min_affinity, max(affinity_score) AS max_affinity FROM g_category_affinity""",
    "e15_affinity_histogram": hist("g_category_affinity", "affinity_score", 50),
    "e15_top_affinity_categories": f"""SELECT * FROM (SELECT product_category_name_english, mean_affinity,
        row_number() OVER (ORDER BY mean_affinity DESC, product_category_name_english) AS rank FROM (
        SELECT product_category_name_english, {npr(xmean('affinity_score', 4), 6)} AS mean_affinity
        FROM g_category_affinity GROUP BY 1)) WHERE rank <= 10""",
    "e16_top_cooccurrence": """SELECT *, concat(substr(CAST(product_id_a AS VARCHAR), 1, 8), '...') AS product_id_a_short,
        concat(substr(CAST(product_id_b AS VARCHAR), 1, 8), '...') AS product_id_b_short FROM (
        SELECT *, row_number() OVER (ORDER BY cooccurrence_score DESC, cooccurrence_count DESC, product_id_a, product_id_b) AS rank
        FROM g_product_cooccurrence) WHERE rank <= 10""",
    "e16_count_histogram": hist(
        "(SELECT least(cooccurrence_count, 20) AS cooccurrence_count FROM g_product_cooccurrence)", "cooccurrence_count", 20),
    "e16_score_histogram": hist("g_product_cooccurrence", "cooccurrence_score", 30),
    "e17_segment_coverage": """SELECT segment_type, count(DISTINCT segment_value) AS segments
        FROM g_top_products_by_segment GROUP BY 1""",
}

PRICE_BANDS_SQL = """CASE WHEN avg_price >= 0 AND avg_price < 50 THEN '0-50' WHEN avg_price >= 50 AND avg_price < 100 THEN '50-100'
  WHEN avg_price >= 100 AND avg_price < 200 THEN '100-200' WHEN avg_price >= 200 AND avg_price < 500 THEN '200-500'
  WHEN avg_price >= 500 AND avg_price < 1000 THEN '500-1000' WHEN avg_price >= 1000 THEN '1000+' END"""

D = {
    "d1_price_vs_rating": f"""SELECT b.price_band, count(*) AS total_products, {npr(xmean('b.avg_review_score', 4), 2)} AS avg_rating,
        o.band_order FROM (SELECT {PRICE_BANDS_SQL} AS price_band, avg_review_score FROM g_product_features
          WHERE avg_price IS NOT NULL AND avg_review_score IS NOT NULL) b
        JOIN (VALUES ('0-50', 0), ('50-100', 1), ('100-200', 2), ('200-500', 3), ('500-1000', 4), ('1000+', 5))
          o(price_band, band_order) ON b.price_band = o.price_band
        GROUP BY b.price_band, o.band_order""",
    "d2_top_categories": f"""SELECT * FROM (SELECT product_category_name_english, total_orders, avg_rating,
        row_number() OVER (ORDER BY total_orders DESC, product_category_name_english) AS rank FROM (
        SELECT product_category_name_english, CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders,
          {npr(xmean('avg_review_score', 4), 2)} AS avg_rating
        FROM g_product_features WHERE product_category_name_english IS NOT NULL GROUP BY 1)) WHERE rank <= 10""",
    "d3_by_state": f"""SELECT customer_state, count(customer_unique_id) AS total_customers,
        CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders, {npr(xmean('total_spent', 4), 2)} AS avg_spent
        FROM g_customer_profile WHERE customer_state IS NOT NULL GROUP BY 1""",
    "d4_by_payment": f"""SELECT p.payment_type, p.total_transactions, p.total_value, coalesce(l.label, p.payment_type) AS label
        FROM (SELECT payment_type, count(payment_type) AS total_transactions, {npr(fsum('payment_value', 4), 2)} AS total_value
              FROM m_payments WHERE payment_type IS DISTINCT FROM 'not_defined' AND payment_type IS NOT NULL GROUP BY 1) p
        LEFT JOIN (VALUES ('credit_card', 'Cartão de Crédito'), ('boleto', 'Boleto'), ('voucher', 'Voucher'),
                   ('debit_card', 'Cartão de Débito')) l(payment_type, label) ON p.payment_type = l.payment_type""",
    "d5_product_detail": """SELECT * FROM d_product_details WHERE product_id IN (SELECT product_id FROM m_order_items)""",
}

S = "CAST({} AS VARCHAR)".format
GRAPH = f"""
k_customer AS (SELECT {S('customer_id')} AS customer_id, {S('customer_unique_id')} AS unique_id, customer_city AS city,
  customer_state AS state, customer_zip_code_prefix AS zip_code FROM s_customers),
k_order AS (SELECT {S('order_id')} AS order_id, {S('customer_id')} AS customer_id FROM s_orders),
k_item AS (SELECT concat({S('order_id')}, '_', {S('order_item_id')}) AS item_id, {S('order_id')} AS order_id,
  {S('product_id')} AS product_id, {S('seller_id')} AS seller_id, price, freight_value FROM s_order_items),
k_product AS (SELECT {S('product_id')} AS product_id, product_category_name AS category FROM s_products),
k_seller AS (SELECT {S('seller_id')} AS seller_id, seller_state AS state, seller_zip_code_prefix AS zip_code FROM s_sellers),
k_payment AS (SELECT concat({S('order_id')}, '_', {S('payment_sequential')}) AS payment_id, {S('order_id')} AS order_id
  FROM s_payments),
k_review AS (SELECT DISTINCT {S('review_id')} AS review_id, {S('order_id')} AS order_id, review_score AS score FROM s_reviews),
k_category AS (SELECT product_category_name AS name, product_category_name_english AS name_en FROM s_translation),
k_geo AS (SELECT DISTINCT {'CASE WHEN length(geolocation_zip_code_prefix) < 5 THEN lpad(geolocation_zip_code_prefix, 5, ' + "'0'" + ') ELSE geolocation_zip_code_prefix END'} AS zip_code FROM s_geolocation),
k_nodes AS (
  SELECT 'Customer' AS label, customer_id AS node_key FROM k_customer UNION ALL
  SELECT 'Order', order_id FROM k_order UNION ALL SELECT 'OrderItem', item_id FROM k_item UNION ALL
  SELECT 'Product', product_id FROM k_product UNION ALL SELECT 'Seller', seller_id FROM k_seller UNION ALL
  SELECT 'Payment', payment_id FROM k_payment UNION ALL SELECT 'Review', review_id FROM k_review UNION ALL
  SELECT 'Category', name FROM k_category UNION ALL SELECT 'Geolocation', zip_code FROM k_geo
),
k_edges AS (
  SELECT DISTINCT 'PLACED' AS rel, 'Customer' AS src_label, c.customer_id AS src, 'Order' AS dst_label, o.order_id AS dst
    FROM k_order o JOIN k_customer c ON o.customer_id = c.customer_id
  UNION ALL SELECT DISTINCT 'CONTAINS', 'Order', o.order_id, 'OrderItem', i.item_id FROM k_item i JOIN k_order o ON i.order_id = o.order_id
  UNION ALL SELECT DISTINCT 'REFERENCES', 'OrderItem', i.item_id, 'Product', p.product_id FROM k_item i JOIN k_product p ON i.product_id = p.product_id
  UNION ALL SELECT DISTINCT 'FULFILLED_BY', 'OrderItem', i.item_id, 'Seller', s.seller_id FROM k_item i JOIN k_seller s ON i.seller_id = s.seller_id
  UNION ALL SELECT DISTINCT 'PAID_WITH', 'Order', o.order_id, 'Payment', p.payment_id FROM k_payment p JOIN k_order o ON p.order_id = o.order_id
  UNION ALL SELECT DISTINCT 'HAS_REVIEW', 'Order', o.order_id, 'Review', r.review_id FROM k_review r JOIN k_order o ON r.order_id = o.order_id
  UNION ALL SELECT DISTINCT 'BELONGS_TO', 'Product', p.product_id, 'Category', c.name FROM k_product p JOIN k_category c ON p.category = c.name
  UNION ALL SELECT DISTINCT 'LOCATED_IN', 'Customer', c.customer_id, 'Geolocation', g.zip_code FROM k_customer c JOIN k_geo g ON c.zip_code = g.zip_code
  UNION ALL SELECT DISTINCT 'LOCATED_IN', 'Seller', s.seller_id, 'Geolocation', g.zip_code FROM k_seller s JOIN k_geo g ON s.zip_code = g.zip_code
),
k_path AS (
  SELECT pl.src AS customer, pl.dst AS "order", co.dst AS item, rf.dst AS product
  FROM k_edges pl JOIN k_edges co ON co.rel = 'CONTAINS' AND co.src = pl.dst
  JOIN k_edges rf ON rf.rel = 'REFERENCES' AND rf.src = co.dst WHERE pl.rel = 'PLACED'
),
k_cat_basket AS (
  SELECT DISTINCT i.order_id, p.product_category_name AS cat FROM s_order_items i JOIN s_products p ON i.product_id = p.product_id
  WHERE p.product_category_name IS NOT NULL
)"""

K = {
    "k1_nodes": "SELECT * FROM k_nodes",
    "k2_edges": "SELECT * FROM k_edges",
    "k3_synthetic_keys": "SELECT payment_id, order_id FROM k_payment UNION ALL SELECT item_id, order_id FROM k_item",
    "k4_label_counts": "SELECT label, count(*) AS total FROM k_nodes GROUP BY 1",
    "k4_rel_counts": "SELECT rel, count(*) AS total FROM k_edges GROUP BY 1",
    "k5_path_sample": """SELECT * FROM (SELECT row_number() OVER (ORDER BY customer, "order", item, product) AS rank,
        customer, "order", item, product FROM k_path) WHERE rank <= 25""",
    "k6_products_by_person": """SELECT c.unique_id, p.product_id, p.category, i.price, r.score, i.item_id AS item, r.review_id AS review
        FROM k_customer c JOIN k_order o ON o.customer_id = c.customer_id JOIN k_item i ON i.order_id = o.order_id
        JOIN k_product p ON i.product_id = p.product_id JOIN k_review r ON r.order_id = o.order_id""",
    "k7_top_sellers": f"""SELECT * FROM (SELECT row_number() OVER (ORDER BY revenue DESC, seller_id) AS rank, seller_id, state,
        {npr('revenue', 2)} AS revenue FROM (SELECT s.seller_id, s.state, {fsum('i.price', 4)} AS revenue
        FROM k_item i JOIN k_seller s ON i.seller_id = s.seller_id GROUP BY 1, 2)) WHERE rank <= 10""",
    "k8_top_categories_by_review": f"""SELECT * FROM (SELECT row_number() OVER (ORDER BY avg_score DESC, total_reviews DESC, category) AS rank,
        category, avg_score, total_reviews FROM (
        SELECT c.name_en AS category, {npr(xmean('r.score', 4), 2)} AS avg_score, count(r.score) AS total_reviews
        FROM k_product p JOIN k_category c ON p.category = c.name JOIN k_item i ON i.product_id = p.product_id
        JOIN k_order o ON i.order_id = o.order_id JOIN k_review r ON r.order_id = o.order_id GROUP BY 1)) WHERE rank <= 15""",
    "k9_multi_state_buyers": """SELECT c.customer_id, c.state AS customer_state, x.n_states, x.states FROM (
        SELECT o.customer_id, count(DISTINCT s.state) AS n_states, string_agg(DISTINCT s.state, ',' ORDER BY s.state) AS states
        FROM k_order o JOIN k_customer c0 ON o.customer_id = c0.customer_id JOIN k_item i ON i.order_id = o.order_id
        JOIN k_seller s ON i.seller_id = s.seller_id WHERE s.state IS NOT NULL GROUP BY 1 HAVING count(DISTINCT s.state) >= 3) x
        JOIN k_customer c ON x.customer_id = c.customer_id""",
    "k10_expensive_freight": f"""SELECT count(*) AS items, {npr(xmean('(freight_value - price)', 4), 2)} AS avg_difference
        FROM k_item WHERE freight_value > price""",
    "k11_category_sales": f"""SELECT t.product_category_name_english, count(*) AS items, {npr(fsum('i.price', 4), 2)} AS revenue,
        {npr(xmean('i.price', 4), 2)} AS avg_ticket
        FROM s_order_items i LEFT JOIN s_products p ON i.product_id = p.product_id
        LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
        WHERE t.product_category_name_english IS NOT NULL GROUP BY 1""",
    "k12_category_pairs": """SELECT a.cat AS category_a, b.cat AS category_b, count(*) AS orders
        FROM k_cat_basket a JOIN k_cat_basket b ON a.order_id = b.order_id AND a.cat < b.cat GROUP BY 1, 2""",
    "k13_state_tickets": f"""SELECT c.customer_state, count(DISTINCT i.order_id) AS orders, {npr(xmean('i.price', 4), 2)} AS avg_ticket,
        {npr(xmean('i.freight_value', 4), 2)} AS avg_freight
        FROM s_order_items i JOIN s_orders o ON i.order_id = o.order_id JOIN s_customers c ON o.customer_id = c.customer_id
        WHERE c.customer_state IS NOT NULL GROUP BY 1""",
    "k14_payment_revenue": f"""SELECT payment_type, {npr(fsum('payment_value', 4), 2)} AS revenue FROM s_payments
        WHERE payment_type IS NOT NULL GROUP BY 1""",
}

E["e9_approval_outliers_narrow"] = E["e9_approval_outliers"].replace("1.5 *", "0.1 *")
E["e11_capital_share_accented"] = vc("""(SELECT CASE WHEN c.capital = lower(g.geolocation_city) THEN 'Capital'
    ELSE 'Interior' END AS location FROM s_geolocation g LEFT JOIN
    (SELECT geolocation_state AS st, min(geolocation_city) AS capital FROM s_geolocation GROUP BY 1) c
    ON g.geolocation_state = c.st)""", "location")
E["e17_segment_samples"] = """SELECT segment_type, segment_value, CAST(rank AS BIGINT) AS rank, product_id, total_orders
    FROM g_top_products_by_segment SEMI JOIN (
      SELECT segment_type, segment_value FROM (SELECT segment_type, segment_value,
          row_number() OVER (PARTITION BY segment_type ORDER BY segment_value) AS k
        FROM (SELECT DISTINCT segment_type, segment_value FROM g_top_products_by_segment)) WHERE k <= 3)
      USING (segment_type, segment_value) WHERE rank <= 5
    UNION ALL SELECT 'best', 'all', CAST(1 AS BIGINT), min(product_id), max(total_orders) FROM g_top_products_by_segment
      WHERE total_orders = (SELECT max(total_orders) FROM g_top_products_by_segment)"""
