"""Driver test tables -> marketplace bronze model.

The driver ships TPC-H-like tables; the model the engine works on is the
nine-table marketplace schema. These mapping statements derive every bronze
table deterministically from keys. They are valid Spark SQL and DuckDB
SQL alike, so the oracle uses the very same text as CTEs.

Fixed values: the statements below are the agreed test mapping and must stay
as they are for both engines to see identical input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("customer", "supplier", "part", "orders", "lineitem")

# The mapping statements (see FIXTURES.md section 4).
MAPPING_SQL: dict[str, str] = {
    "customers": (
        "select c_custkey as customer_id, c_custkey - c_custkey % 2 as customer_unique_id, "
        "lpad(cast(c_nationkey * 40 + c_custkey % 7 as string), 5, '0') as customer_zip_code_prefix, "
        "concat('city ', cast(c_nationkey as string)) as customer_city, "
        "lpad(cast(c_nationkey as string), 2, '0') as customer_state from customer"
    ),
    "sellers": (
        "select s_suppkey as seller_id, "
        "lpad(cast(s_nationkey * 40 + s_suppkey % 7 as string), 5, '0') as seller_zip_code_prefix, "
        "concat('city ', cast(s_nationkey as string)) as seller_city, "
        "lpad(cast(s_nationkey as string), 2, '0') as seller_state from supplier"
    ),
    "translation": (
        "select distinct lower(p_brand) as product_category_name, "
        "concat('cat_', substr(p_brand, 7)) as product_category_name_english "
        "from part where p_brand <> 'Brand#25'"
    ),
    "products": (
        "select p_partkey as product_id, case when p_partkey % 50 = 0 then null else lower(p_brand) end "
        "as product_category_name, cast(length(p_name) as double) as product_name_lenght, "
        "cast(p_partkey % 400 as double) as product_description_lenght, "
        "case when p_partkey % 31 = 0 then null else cast(p_partkey % 8 as double) end as product_photos_qty, "
        "case when p_partkey % 37 = 0 then null else p_size * 700.0e0 end as product_weight_g, "
        "p_size * 2.0e0 as product_length_cm, p_size * 1.0e0 as product_height_cm, "
        "p_size * 3.0e0 as product_width_cm from part"
    ),
    "orders": (
        "select o_orderkey as order_id, o_custkey as customer_id, case o_orderstatus when 'F' then 'delivered' "
        "when 'O' then 'shipped' else 'canceled' end as order_status, o_orderdate as order_purchase_timestamp, "
        "case when o_orderkey % 50 = 0 then null else o_orderdate + interval '1' hour * (o_orderkey % 97 - "
        "case when o_orderkey % 41 = 0 then 120 else 0 end) end as order_approved_at, "
        "o_orderdate + interval '1' hour * (o_orderkey % 60) as order_delivered_carrier_date, "
        "case when o_orderkey % 33 = 0 then null else o_orderdate + interval '1' hour * ((o_orderkey % 181) * 6) end "
        "as order_delivered_customer_date, o_orderdate + interval '24' day as order_estimated_delivery_date "
        "from orders"
    ),
    "order_items": (
        "select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id, "
        "l_suppkey as seller_id, l_shipdate as shipping_limit_date, l_extendedprice / 100 as price, "
        "case when (l_partkey + l_linenumber) % 29 = 0 then null else l_extendedprice * l_tax / 100 end "
        "as freight_value from lineitem"
    ),
    "payments": (
        "select o_orderkey as order_id, 1 as payment_sequential, case substr(o_orderpriority, 1, 1) "
        "when '1' then 'credit_card' when '2' then 'boleto' when '3' then 'voucher' when '4' then 'not_defined' "
        "else 'debit_card' end as payment_type, case when o_orderkey % 19 = 0 then null else "
        "cast(o_orderkey % 12 as double) end as payment_installments, o_totalprice as payment_value from orders "
        "union all "
        "select o_orderkey, 2, 'voucher', 1.0e0, o_totalprice / 10 from orders where o_orderkey % 5 = 0"
    ),
    "reviews": (
        "select o_orderkey as review_id, o_orderkey as order_id, cast(1 + (o_orderkey * 7) % 6 as double) "
        "as review_score, case o_orderkey % 3 when 0 then null when 1 then ' ' else 'ok' end "
        "as review_comment_message, o_orderdate as review_creation_date from orders where o_orderkey % 10 < 6 "
        "union all "
        "select o_orderkey + 1000000000, o_orderkey, 1.0e0, null, o_orderdate from orders where o_orderkey % 23 = 0"
    ),
    "geolocation": (
        "select lpad(cast(c_nationkey * 40 + c_custkey % 7 as string), 5, '0') as geolocation_zip_code_prefix, "
        "-34.0e0 + c_nationkey * 1.5e0 + (c_custkey % 11) * 0.01e0 as geolocation_lat, "
        "-72.0e0 + c_nationkey * 1.4e0 as geolocation_lng, concat('city ', cast(c_nationkey as string)) "
        "as geolocation_city, lpad(cast(c_nationkey as string), 2, '0') as geolocation_state from customer"
    ),
}

BRONZE_TABLES = tuple(MAPPING_SQL)

_FROM = re.compile(r"\bfrom (customer|supplier|part|orders|lineitem)\b")


def bronze_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze tables of the marketplace model, derived lazily from the
    driver parquet at ``sf_dir``. Only columns the mapping uses are read
    (Catalyst prunes the parquet scan)."""
    src = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES}
    out = {}
    for name, sql in MAPPING_SQL.items():
        templ = _FROM.sub(lambda m: "from {" + m.group(1) + "}", sql)
        used = {t: src[t] for t in set(_FROM.findall(sql))}
        out[name] = spark.sql(templ, **used)
    return out


def mapping_ctes() -> str:
    """The mapping as a DuckDB/ANSI ``WITH`` list (tables ``m_<name>``)."""
    return ",\n".join(f"m_{name} AS ({sql})" for name, sql in MAPPING_SQL.items())
