"""Oracle CTEs for the detail tables (H1-H10) over the bronze mapping."""

from __future__ import annotations

from oracles.base import days, npr

DBL = "CAST({} AS DOUBLE)".format


def zfill(c: str) -> str:
    s = f"CAST({c} AS VARCHAR)"
    return f"(CASE WHEN length({s}) < 5 THEN lpad({s}, 5, '0') ELSE {s} END)"


def micro_mean(c: str) -> str:
    return f"(CAST(sum(CAST(round_even({c} * 1000000.0, 0) AS BIGINT)) AS DOUBLE) / count({c}) / {DBL('1000000.0')})"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    r = "radians"
    a = (f"(pow(sin(({r}({lat2}) - {r}({lat1})) / 2), 2) + cos({r}({lat1})) * cos({r}({lat2})) * "
         f"pow(sin(({r}({lon2}) - {r}({lon1})) / 2), 2))")
    return f"({DBL('6371.0')} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _hexbin(name: str, keep: str, columns: int = 50, rows: int = 28) -> str:
    half = DBL("0.5")
    dist = lambda du, dv: f"(({du}) * ({du}) + 3 * (({dv}) * ({dv})))"
    return f"""{name}_points AS (
  SELECT distance_km AS x, CAST(delivery_time_days AS DOUBLE) AS y FROM d_delivery
  WHERE distance_km IS NOT NULL AND delivery_time_days IS NOT NULL AND {keep}
),
{name}_uv AS (
  SELECT x0, y0, sx, sy, CASE WHEN sx > 0 THEN (x - x0) / sx ELSE {DBL('0')} END AS u,
    CASE WHEN sy > 0 THEN (y - y0) / sy ELSE {DBL('0')} END AS v
  FROM {name}_points, (SELECT min(x) AS x0, min(y) AS y0, (max(x) - min(x)) / {DBL(columns)} AS sx,
                         (max(y) - min(y)) / {DBL(rows)} AS sy FROM {name}_points)
),
{name} AS (
  SELECT lattice, col, row, {npr(f'x0 + (col + (lattice - 1) * {half}) * sx', 6)} AS center_km,
    {npr(f'y0 + (row + (lattice - 1) * {half}) * sy', 6)} AS center_days, count(*) AS count
  FROM (SELECT x0, y0, sx, sy, CASE WHEN near THEN 1 ELSE 2 END AS lattice,
          CAST(CASE WHEN near THEN round_even(u, 0) ELSE floor(u) END AS INTEGER) AS col,
          CAST(CASE WHEN near THEN round_even(v, 0) ELSE floor(v) END AS INTEGER) AS row
        FROM (SELECT *, {dist('u - round_even(u, 0)', 'v - round_even(v, 0)')}
                     < {dist(f'u - floor(u) - {half}', f'v - floor(v) - {half}')} AS near FROM {name}_uv))
  GROUP BY lattice, col, row, x0, y0, sx, sy
)"""


def top1(src: str, key: str, val: str, out: str, cnt: str | None = None) -> str:
    extra = f", cnt AS {cnt}" if cnt else ""
    return (f"SELECT {key}, {val} AS {out}{extra} FROM (SELECT {key}, {val}, count(*) AS cnt, "
            f"row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {val}) AS rn FROM {src} "
            f"WHERE {key} IS NOT NULL AND {val} IS NOT NULL GROUP BY 1, 2) WHERE rn = 1")


DETAILS = f"""
d_geo AS (
  SELECT {zfill('geolocation_zip_code_prefix')} AS z, geolocation_lat AS lat, geolocation_lng AS lng,
    geolocation_city AS city, geolocation_state AS state FROM m_geolocation
),
d_zip_geo AS (
  SELECT m.z AS geolocation_zip_code_prefix, m.lat AS geolocation_lat, m.lng AS geolocation_lng,
    c.city AS geolocation_city, s.state AS geolocation_state
  FROM (SELECT z, {micro_mean('lat')} AS lat, {micro_mean('lng')} AS lng FROM d_geo GROUP BY z) m
  LEFT JOIN ({top1('d_geo', 'z', 'city', 'city')}) c ON m.z = c.z
  LEFT JOIN ({top1('d_geo', 'z', 'state', 'state')}) s ON m.z = s.z
),
d_zip_counts AS (
  SELECT c.geolocation_zip_code_prefix, c.count, t.unique_zip_prefixes, t.total_records
  FROM (SELECT geolocation_zip_code_prefix, count(*) AS count FROM m_geolocation
        WHERE geolocation_zip_code_prefix IS NOT NULL GROUP BY 1) c,
       (SELECT count(DISTINCT geolocation_zip_code_prefix) AS unique_zip_prefixes, count(*) AS total_records
        FROM m_geolocation) t
),
d_zip_inconsistent AS (
  SELECT * FROM (SELECT z AS geolocation_zip_code_prefix, count(DISTINCT lat) AS geolocation_lat,
      count(DISTINCT lng) AS geolocation_lng, count(DISTINCT city) AS geolocation_city,
      count(DISTINCT state) AS geolocation_state FROM d_geo GROUP BY z)
  WHERE geolocation_lat > 1 OR geolocation_lng > 1 OR geolocation_city > 1 OR geolocation_state > 1
),
d_delivery AS (
  SELECT o.*, c.customer_zip_code_prefix, i.seller_id, s.seller_zip_code_prefix,
    cg.geolocation_lat AS customer_lat, cg.geolocation_lng AS customer_lng,
    sg.geolocation_lat AS seller_lat, sg.geolocation_lng AS seller_lng,
    {days('o.order_delivered_carrier_date', 'o.order_delivered_customer_date')} AS delivery_time_days,
    {npr(haversine('sg.geolocation_lat', 'sg.geolocation_lng', 'cg.geolocation_lat', 'cg.geolocation_lng'), 6)} AS distance_km
  FROM m_orders o
  LEFT JOIN (SELECT customer_id, {zfill('customer_zip_code_prefix')} AS customer_zip_code_prefix FROM m_customers) c
    ON o.customer_id = c.customer_id
  LEFT JOIN (SELECT order_id, seller_id FROM m_order_items) i ON o.order_id = i.order_id
  LEFT JOIN (SELECT seller_id, {zfill('seller_zip_code_prefix')} AS seller_zip_code_prefix FROM m_sellers) s
    ON i.seller_id = s.seller_id
  LEFT JOIN d_zip_geo cg ON c.customer_zip_code_prefix = cg.geolocation_zip_code_prefix
  LEFT JOIN d_zip_geo sg ON s.seller_zip_code_prefix = sg.geolocation_zip_code_prefix
),
d_corr AS (
  SELECT {npr('corr(distance_km, CAST(delivery_time_days AS DOUBLE))', 6)} AS corr_all,
    {npr('''corr(CASE WHEN distance_km < 3000 AND delivery_time_days < 60 THEN distance_km END,
      CASE WHEN distance_km < 3000 AND delivery_time_days < 60 THEN CAST(delivery_time_days AS DOUBLE) END)''', 6)} AS corr_filtered
  FROM d_delivery
),
d_density AS (
  SELECT cell_x, cell_y, count(*) AS count FROM (
    SELECT CAST(CASE WHEN x1 = x0 THEN 0 ELSE least(floor((x - x0) / ((x1 - x0) / {DBL('50.0')})), 49) END AS INTEGER) AS cell_x,
      CAST(CASE WHEN y1 = y0 THEN 0 ELSE least(floor((y - y0) / ((y1 - y0) / {DBL('50.0')})), 49) END AS INTEGER) AS cell_y
    FROM (SELECT distance_km AS x, CAST(delivery_time_days AS DOUBLE) AS y FROM d_delivery
          WHERE distance_km IS NOT NULL AND delivery_time_days IS NOT NULL) d,
         (SELECT min(distance_km) AS x0, max(distance_km) AS x1, min(CAST(delivery_time_days AS DOUBLE)) AS y0,
            max(CAST(delivery_time_days AS DOUBLE)) AS y1 FROM d_delivery
          WHERE distance_km IS NOT NULL AND delivery_time_days IS NOT NULL) s)
  GROUP BY 1, 2
),
{_hexbin("d_hexbin", "true")},
{_hexbin("d_hexbin_bounded", "distance_km < 3000 AND delivery_time_days < 60")},
d_sellers AS (
  SELECT t.seller_id, t.specialized_product, t.times_sold, r.average_review_score, c.specialized_category
  FROM ({top1('m_order_items', 'seller_id', 'product_id', 'specialized_product', 'times_sold')}) t
  LEFT JOIN (SELECT i.seller_id, avg(r.review_score) AS average_review_score
             FROM m_order_items i LEFT JOIN m_reviews r ON i.order_id = r.order_id
             WHERE i.seller_id IS NOT NULL GROUP BY 1) r ON t.seller_id = r.seller_id
  LEFT JOIN ({top1('(SELECT i.seller_id, p.product_category_name FROM m_order_items i LEFT JOIN m_products p ON i.product_id = p.product_id)',
                   'seller_id', 'product_category_name', 'specialized_category')}) c ON t.seller_id = c.seller_id
),
d_person AS (
  SELECT o.order_id, c.customer_unique_id FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id
),
d_customer_details AS (
  SELECT g.*, CAST(coalesce(ts.total_sellers, 0) AS INTEGER) AS total_sellers, dist.avg_delivery_distance
  FROM g_customer_profile g
  LEFT JOIN (SELECT p.customer_unique_id, count(DISTINCT i.seller_id) AS total_sellers
             FROM d_person p LEFT JOIN m_order_items i ON p.order_id = i.order_id GROUP BY 1) ts
    ON g.customer_unique_id = ts.customer_unique_id
  LEFT JOIN (SELECT p.customer_unique_id,
               CAST(sum(CAST(round_even(d.distance_km * 1000000.0, 0) AS BIGINT)) AS DOUBLE)
                 / (count(d.distance_km) * {DBL('1000000.0')}) AS avg_delivery_distance
             FROM d_person p LEFT JOIN (SELECT order_id, distance_km FROM d_delivery) d ON p.order_id = d.order_id
             GROUP BY 1) dist ON g.customer_unique_id = dist.customer_unique_id
),
d_product_repeat AS (
  SELECT product_id, repeat_buyers, one_time_buyers,
    coalesce(CASE WHEN one_time_buyers = 0 THEN NULL ELSE {DBL('repeat_buyers')} / {DBL('one_time_buyers')} END,
      {DBL('0.0')}) AS repeat_product
  FROM (SELECT product_id, count(*) FILTER (WHERE n >= 2) AS repeat_buyers, count(*) FILTER (WHERE n = 1) AS one_time_buyers
        FROM (SELECT i.product_id, p.customer_unique_id, count(DISTINCT i.order_id) AS n
              FROM m_order_items i LEFT JOIN d_person p ON i.order_id = p.order_id
              WHERE i.product_id IS NOT NULL AND p.customer_unique_id IS NOT NULL GROUP BY 1, 2)
        GROUP BY 1)
),
d_repeat_summary AS (
  SELECT count(DISTINCT product_id) AS total_products,
    count(DISTINCT product_id) FILTER (WHERE repeat_buyers > 0) AS repeatable_products,
    count(DISTINCT product_id) - count(DISTINCT product_id) FILTER (WHERE repeat_buyers > 0) AS non_repeatable_products,
    {npr(f"{DBL('count(DISTINCT product_id) FILTER (WHERE repeat_buyers > 0)')} * {DBL('100.0')} / count(DISTINCT product_id)", 6)} AS repeatable_pct,
    {npr('avg(repeat_product) FILTER (WHERE repeat_buyers > 0)', 6)} AS average_repeat_chance
  FROM d_product_repeat
),
d_product_sellers AS (
  SELECT product_id, count(DISTINCT seller_id) AS total_sellers FROM m_order_items
  WHERE product_id IS NOT NULL GROUP BY 1
),
d_product_details AS (
  SELECT g.*, coalesce(r.repeat_product, {DBL('0.0')}) AS repeat_product,
    CAST(coalesce(s.total_sellers, 0) AS INTEGER) AS total_sellers
  FROM g_product_features g LEFT JOIN d_product_repeat r ON g.product_id = r.product_id
  LEFT JOIN d_product_sellers s ON g.product_id = s.product_id
),
d_multi_seller AS (
  SELECT count(*) AS total_products, count(*) FILTER (WHERE total_sellers > 1) AS multi_seller_products,
    {npr(f"{DBL('count(*) FILTER (WHERE total_sellers > 1)')} * {DBL('100.0')} / count(*)", 6)} AS multi_seller_pct
  FROM d_product_sellers
)"""
