"""SQL building blocks shared by the oracle statements: the test mapping,
the silver layer, and scalar helpers with the same semantics as the Spark
column functions (numpy rounding = ``round_even(x * 10^d, 0) / 10^d``)."""

from __future__ import annotations

from mercato.sources.fixtures import mapping_ctes

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


def npr(c: str, d: int) -> str:
    s = f"{10 ** d}.0"
    return f"(round_even(CAST({c} AS DOUBLE) * {s}, 0) / {s})"


def zip5(c: str) -> str:
    d = f"nullif(regexp_extract(CAST({c} AS VARCHAR), '(\\d+)', 1), '')"
    return f"(CASE WHEN length({d}) < 5 THEN lpad({d}, 5, '0') ELSE {d} END)"


def city(c: str) -> str:
    s = f"lower({strip(c)})"
    return f"(CASE WHEN {s} IN ('', 'nan') THEN NULL ELSE {s} END)"


def state(c: str) -> str:
    return f"nullif(upper({strip(c)}), '')"


def days(a: str, b: str) -> str:
    return f"CAST(floor(datediff('microsecond', {a}, {b}) / 86400000000) AS BIGINT)"


def cents_sum(c: str) -> str:
    return f"(CAST(sum(CAST(round_even({c} * 100.0, 0) AS BIGINT)) AS DOUBLE) / 100.0)"


def first_by(table: str, keys: str, order: str, cols: str) -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn "
            f"FROM {table}) WHERE _rn = 1")


def _nf(cols: str) -> str:
    return ", ".join(f"{c.strip()} NULLS FIRST" for c in cols.split(","))


SILVER = f"""
s_customers AS (
  {first_by(f'''(SELECT customer_id, customer_unique_id, {zip5('customer_zip_code_prefix')} AS customer_zip_code_prefix,
      {city('customer_city')} AS customer_city, {state('customer_state')} AS customer_state FROM m_customers
      WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL)''', 'customer_id',
      _nf('customer_unique_id, customer_zip_code_prefix, customer_city, customer_state'),
      'customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state')}
),
s_sellers AS (
  {first_by(f'''(SELECT seller_id, {zip5('seller_zip_code_prefix')} AS seller_zip_code_prefix,
      {city('seller_city')} AS seller_city, {state('seller_state')} AS seller_state FROM m_sellers
      WHERE seller_id IS NOT NULL)''', 'seller_id', _nf('seller_zip_code_prefix, seller_city, seller_state'),
      'seller_id, seller_zip_code_prefix, seller_city, seller_state')}
),
s_translation_0 AS (
  {first_by(f'''(SELECT * FROM (SELECT lower({strip('product_category_name')}) AS product_category_name,
      lower({strip('product_category_name_english')}) AS product_category_name_english FROM m_translation)
      WHERE product_category_name IS NOT NULL AND product_category_name_english IS NOT NULL)''',
      'product_category_name', _nf('product_category_name_english'),
      'product_category_name, product_category_name_english')}
),
s_translation AS (
  SELECT * FROM s_translation_0
  UNION ALL
  SELECT 'desconhecida', 'unknown' WHERE NOT EXISTS (
    SELECT 1 FROM s_translation_0 WHERE product_category_name = 'desconhecida'
      AND product_category_name_english IS NOT NULL)
),
s_products_0 AS (
  {first_by(f'''(SELECT product_id, CASE WHEN product_category_name IS NULL OR lower({strip('product_category_name')}) = 'nan'
      THEN 'desconhecida' ELSE lower({strip('product_category_name')}) END AS product_category_name,
      product_name_lenght, product_description_lenght, product_photos_qty, product_weight_g, product_length_cm,
      product_height_cm, product_width_cm FROM m_products)''', 'product_id',
      _nf('product_category_name, product_name_lenght, product_description_lenght, product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm'),
      'product_id, product_category_name, product_name_lenght, product_description_lenght, product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm')}
),
s_products_1 AS (
  SELECT p.product_id, p.product_category_name, p.product_name_lenght, p.product_description_lenght,
    coalesce(p.product_photos_qty, 0.0) AS product_photos_qty,
    coalesce(p.product_weight_g, m.w) AS product_weight_g, coalesce(p.product_length_cm, m.l) AS product_length_cm,
    coalesce(p.product_height_cm, m.h) AS product_height_cm, coalesce(p.product_width_cm, m.wd) AS product_width_cm
  FROM s_products_0 p, (SELECT median(product_weight_g) w, median(product_length_cm) l,
    median(product_height_cm) h, median(product_width_cm) wd FROM s_products_0) m
),
s_products_2 AS (
  SELECT * FROM s_products_1 WHERE product_weight_g > 0 AND product_weight_g <= 30000
    AND product_length_cm > 0 AND product_length_cm <= 200 AND product_height_cm > 0 AND product_height_cm <= 200
    AND product_width_cm > 0 AND product_width_cm <= 200
),
s_products AS (
  SELECT p.product_id, p.product_category_name,
    {npr('coalesce(p.product_name_lenght, m.nl)', 2)} AS product_name_lenght,
    {npr('coalesce(p.product_description_lenght, m.dl)', 2)} AS product_description_lenght,
    {npr('p.product_photos_qty', 2)} AS product_photos_qty, {npr('p.product_weight_g', 2)} AS product_weight_g,
    {npr('p.product_length_cm', 2)} AS product_length_cm, {npr('p.product_height_cm', 2)} AS product_height_cm,
    {npr('p.product_width_cm', 2)} AS product_width_cm
  FROM s_products_2 p, (SELECT median(product_name_lenght) nl, median(product_description_lenght) dl FROM s_products_2) m
),
s_orders AS (
  SELECT order_id, customer_id, lower({strip('order_status')}) AS order_status, order_purchase_timestamp,
    order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
    {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS delivery_days,
    {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS delivery_delay_days,
    order_delivered_customer_date IS NOT NULL AS is_delivered,
    coalesce({days('order_estimated_delivery_date', 'order_delivered_customer_date')} > 0, false) AS is_late
  FROM ({first_by('m_orders', 'order_id',
      _nf('customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date'),
      '*')})
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL
    AND (order_approved_at IS NULL OR order_approved_at >= order_purchase_timestamp)
),
s_items_0 AS (
  SELECT * FROM ({first_by('m_order_items', 'order_id, order_item_id',
      _nf('product_id, seller_id, shipping_limit_date, price, freight_value'), '*')})
  WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
    AND price IS NOT NULL AND price > 0
),
s_items_1 AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price,
    CASE WHEN coalesce(i.freight_value, m.mf) IS NULL THEN NULL ELSE greatest(coalesce(i.freight_value, m.mf), 0) END AS freight_value
  FROM s_items_0 i, (SELECT median(freight_value) mf FROM s_items_0) m
),
s_items_2 AS (
  SELECT *, price + freight_value AS total_item_value FROM s_items_1
),
s_order_items AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
    {npr('i.price', 2)} AS price, {npr('i.freight_value', 2)} AS freight_value,
    {npr('i.total_item_value', 2)} AS total_item_value, false AS is_price_outlier
  FROM s_items_2 i, (SELECT quantile_cont(price, 0.999) p FROM s_items_2) q
  WHERE NOT (i.price > q.p)
),
s_pay_0 AS (
  SELECT order_id, payment_sequential, lower({strip('payment_type')}) AS payment_type, payment_installments, payment_value
  FROM m_payments
),
s_pay_1 AS (
  SELECT * FROM s_pay_0 WHERE payment_type IS DISTINCT FROM 'not_defined' AND order_id IS NOT NULL
    AND payment_sequential IS NOT NULL AND payment_type IS NOT NULL AND payment_value IS NOT NULL AND payment_value > 0
),
s_pay_2 AS (
  SELECT p.order_id, p.payment_sequential, p.payment_type,
    CAST(round_even(CASE WHEN coalesce(p.payment_installments, m.mi) IS NULL THEN NULL
      ELSE greatest(coalesce(p.payment_installments, m.mi), 1) END, 0) AS INTEGER) AS payment_installments,
    p.payment_value
  FROM s_pay_1 p, (SELECT median(payment_installments) mi FROM s_pay_1) m
),
s_payments AS (
  SELECT order_id, payment_sequential, payment_type, payment_installments, {npr('payment_value', 2)} AS payment_value
  FROM ({first_by('s_pay_2', 'order_id, payment_sequential',
      _nf('payment_value, payment_type, payment_installments'), '*')})
),
s_reviews AS (
  SELECT review_id, order_id, review_score, review_comment_message, review_creation_date,
    review_comment_message IS NOT NULL AND {strip('review_comment_message')} <> '' AS has_comment,
    CASE review_score WHEN 1 THEN 'muito negativo' WHEN 2 THEN 'negativo' WHEN 3 THEN 'neutro'
      WHEN 4 THEN 'positivo' WHEN 5 THEN 'muito positivo' END AS sentiment
  FROM ({first_by('m_reviews', 'review_id',
      _nf('order_id, review_creation_date, order_id, review_score, review_comment_message, review_creation_date'), '*')})
  WHERE review_score BETWEEN 1 AND 5
),
s_geolocation AS (
  SELECT * FROM (
    SELECT {zip5('geolocation_zip_code_prefix')} AS geolocation_zip_code_prefix,
      {npr('geolocation_lat', 6)} AS geolocation_lat, {npr('geolocation_lng', 6)} AS geolocation_lng,
      {city('geolocation_city')} AS geolocation_city, {state('geolocation_state')} AS geolocation_state
    FROM m_geolocation
    WHERE geolocation_lat IS NOT NULL AND geolocation_lng IS NOT NULL
      AND geolocation_lat BETWEEN -33.8 AND 5.3 AND geolocation_lng BETWEEN -73.9 AND -34.7)
  WHERE geolocation_zip_code_prefix IS NOT NULL
)"""


def with_silver(body: str) -> str:
    """``WITH <mapping>, <silver>, <body>`` -- body continues the CTE list
    or is the final SELECT after a comma-less join by the caller."""
    return f"WITH {mapping_ctes()},\n{SILVER}\n{body}"


def silver_table(name: str) -> str:
    return with_silver(f"SELECT * FROM s_{name}")
