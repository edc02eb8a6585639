"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracles.base import silver_table, strip, with_silver
from oracles.gold import GOLD, contract_sql
from oracles.details import DETAILS
from oracles.explore import D, E, GRAPH, K
from oracles.recommend import RECS, R
from oracles.quality import Q

ORACLE: dict[str, str] = {}

for _i, _t in enumerate(["customers", "sellers", "translation", "products", "orders", "order_items",
                         "payments", "reviews", "geolocation"], start=1):
    ORACLE[f"b{_i}_{_t}"] = silver_table(_t)


def gold_query(select: str) -> str:
    return with_silver(f",\n{GOLD},\n{DETAILS},\n{GRAPH},\n{RECS}\n{select}")


for _n, _t in [("g1_interactions", "interactions"), ("g2_product_features", "product_features"),
               ("g3_customer_profile", "customer_profile"), ("g4_category_affinity", "category_affinity"),
               ("g5_cooccurrence", "product_cooccurrence"), ("g6_top_by_segment", "top_products_by_segment")]:
    ORACLE[_n] = gold_query(f"SELECT * FROM g_{_t}")
ORACLE["g7_contract"] = gold_query(contract_sql())

for _n, _t in [("h1_zip_geo", "zip_geo"), ("h2_zip_counts", "zip_counts"), ("h2_zip_inconsistent", "zip_inconsistent"),
               ("h3_delivery", "delivery"), ("h4_distance_corr", "corr"), ("h5_density", "density"), ("h5_hexbin", "hexbin"), ("h5_hexbin_bounded", "hexbin_bounded"),
               ("h6_sellers", "sellers"), ("h7_customers", "customer_details"), ("h8_product_repeat", "product_repeat"),
               ("h9_repeat_summary", "repeat_summary"), ("h10_product_details", "product_details"),
               ("h10_multi_seller", "multi_seller")]:
    ORACLE[_n] = gold_query(f"SELECT * FROM d_{_t}")

for _n, _q in {**E, **D, **K}.items():
    ORACLE[_n] = gold_query(_q)

for _n, _q in R.items():
    ORACLE[_n] = gold_query(_q)

for _n, _q in Q.items():
    ORACLE[_n] = gold_query(_q)

ORACLE["s5_head_orders"] = gold_query("SELECT * FROM s_orders ORDER BY order_id LIMIT 5")
ORACLE["w6_ordered_interactions"] = gold_query("""SELECT *, row_number() OVER (
    ORDER BY customer_unique_id, implicit_score DESC, product_id) - 1 AS position FROM g_interactions""")
ORACLE["k1_order_items_loaded"] = gold_query("""SELECT concat(order_id, '_', order_item_id) AS item_id,
    CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
    price, freight_value, shipping_limit_date AS shipping_limit FROM s_order_items""")
ORACLE["p2_review_text"] = gold_query(f"""SELECT review_id, CASE WHEN {strip('raw')} IN ('', 'nan', 'None') THEN NULL ELSE {strip('raw')} END AS message
    FROM (SELECT review_id, CASE review_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN ' None' || chr(9)
            WHEN 2 THEN chr(10) || ' ' || review_comment_message || ' nan  ' ELSE review_comment_message END AS raw FROM m_reviews)""")
