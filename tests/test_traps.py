"""Hand-made micro-fixtures for the semantic traps; expected values are
written by hand from the reference's documented behaviour."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from mercato.functions import haversine_km, norm_state, norm_zip, price_band
from mercato.plans import gold, silver
from mercato.plans.recommend import content

T0 = dt.datetime(2020, 1, 10, 12, 0, 0)


def _layer(spark, items, orders, customers, reviews, products=None, translation=None, sellers=None, payments=None):
    L = {
        "order_items": spark.createDataFrame(items, "order_id long, order_item_id int, product_id long, seller_id long, "
                                                    "price double, freight_value double, total_item_value double"),
        "orders": spark.createDataFrame(orders, "order_id long, customer_id long, delivery_days long, is_late boolean"),
        "customers": spark.createDataFrame(customers, "customer_id long, customer_unique_id long, customer_city string, "
                                                      "customer_state string"),
        "reviews": spark.createDataFrame(reviews, "review_id long, order_id long, review_score double, sentiment string"),
        "products": spark.createDataFrame(products or [(p, "c") for p in {i[2] for i in items}],
                                          "product_id long, product_category_name string"),
        "translation": spark.createDataFrame(translation or [("c", "cat")],
                                             "product_category_name string, product_category_name_english string"),
        "sellers": spark.createDataFrame(sellers or [(1, "SP")], "seller_id long, seller_state string"),
        "payments": spark.createDataFrame(payments or [(1, "boleto", 1)],
                                          "order_id long, payment_type string, payment_installments int"),
    }
    return L


def test_t1_floor_days(spark):
    est = T0
    cases = [(est - dt.timedelta(hours=5), -1, False), (est + dt.timedelta(hours=5), 0, False),
             (est + dt.timedelta(hours=24), 1, True), (est + dt.timedelta(hours=48), 2, True)]
    df = spark.createDataFrame([(1, 1, T0 - dt.timedelta(days=3), d, est) for d, _, _ in cases],
                               "order_id long, customer_id long, order_purchase_timestamp timestamp_ntz, "
                               "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    df = (df.withColumn("order_id", F.monotonically_increasing_id()).withColumn("order_status", F.lit("delivered"))
          .withColumn("order_approved_at", F.lit(None).cast("timestamp_ntz")))
    out = silver.clean_orders(df).orderBy("order_delivered_customer_date").collect()
    assert [r.delivery_delay_days for r in out] == [c[1] for c in cases]
    assert [r.is_late for r in out] == [c[2] for c in cases]


def test_t2_has_comment(spark):
    df = spark.createDataFrame([(1, 1, 5.0, None, T0), (2, 2, 5.0, "  ", T0), (3, 3, 5.0, "ok", T0)],
                               "review_id long, order_id long, review_score double, review_comment_message string, "
                               "review_creation_date timestamp_ntz")
    assert [r.has_comment for r in silver.clean_reviews(df).orderBy("review_id").collect()] == [False, False, True]
    assert [r.has_comment for r in silver.clean_reviews(df, legacy_has_comment=True).orderBy("review_id").collect()] \
        == [True, False, True]


def test_t3_t4_state_and_zip(spark):
    df = spark.createDataFrame([(None, "1001"), (" sp ", "ab-123"), ("rj", "1234567"), ("x", None)], "s string, z string")
    out = df.select(norm_state("s").alias("s"), norm_zip("z").alias("z")).collect()
    assert [r.s for r in out] == [None, "SP", "RJ", "X"]
    assert [r.z for r in out] == ["01001", "00123", "1234567", None]


def test_t8_bands(spark):
    pf = spark.createDataFrame([(1, None, None, None, 0.0, None)],
                               "product_id long, product_category_name_english string, avg_price double, "
                               "avg_review_score double, positive_sentiment_ratio double, seller_state string")
    assert content.product_text(pf).first().text == "unknown price_high score_unknown sentiment_unknown unknown"


def test_t10_positive_ratio(spark):
    items = [(1, 1, 7, 1, 10.0, 1.0, 11.0), (2, 1, 7, 1, 10.0, 1.0, 11.0), (3, 1, 7, 1, 10.0, 1.0, 11.0),
             (4, 1, 7, 1, 10.0, 1.0, 11.0)]
    reviews = [(1, 1, 4.0, "positivo"), (2, 2, 5.0, "muito positivo"), (3, 3, 1.0, "muito negativo")]
    L = _layer(spark, items, [(o, 1, 1, False) for o in range(1, 5)], [(1, 1, "x", "SP")], reviews)
    r = gold.product_features(L).first()
    assert r.positive_sentiment_ratio == 0.25
    assert r.total_reviews == 3
    assert r.avg_review_score == round(10 / 3, 4)


def test_t11_fanout_and_g1(spark):
    items = [(1, 1, 7, 1, 8.0, 2.0, 10.0)]
    reviews = [(1, 1, 5.0, "muito positivo"), (2, 1, 1.0, "muito negativo")]
    L = _layer(spark, items, [(1, 1, 1, False)], [(1, 1, "x", "SP")], reviews)
    aff = gold.category_affinity(L).first()
    assert (aff.purchase_count, aff.total_spent, aff.avg_review_score) == (2, 20.0, 3.0)
    it = gold.interactions(L).first()
    assert (it.purchase_count, it.total_spent, it.review_score) == (1, 10.0, 3.0)
    # A5: tie between the two labels -> smallest label
    assert it.sentiment == "muito negativo"


def test_g1_implicit_without_review(spark):
    items = [(1, 1, 7, 1, 8.0, 2.0, 10.0), (2, 1, 7, 1, 8.0, 2.0, 10.0)]
    L = _layer(spark, items, [(1, 1, 1, False), (2, 1, 1, False)], [(1, 1, "x", "SP")], [])
    r = gold.interactions(L).first()
    assert r.implicit_score == pytest.approx(2.3)
    assert r.sentiment is None


def test_g4_single_category_is_zero(spark):
    items = [(1, 1, 7, 1, 8.0, 2.0, 10.0)]
    L = _layer(spark, items, [(1, 1, 1, False)], [(1, 1, "x", "SP")], [])
    assert gold.category_affinity(L).first().affinity_score == 0.0


def test_g5_cooccurrence(spark):
    A, B, C = 1, 2, 3
    items = [(1, 1, A), (1, 2, B), (2, 1, A), (2, 2, B), (2, 3, C), (3, 1, A), (4, 1, A), (4, 2, A)]
    items = [(o, i, p, 1, 1.0, 1.0, 2.0) for o, i, p in items]
    L = _layer(spark, items, [(o, 1, 1, False) for o in range(1, 5)], [(1, 1, "x", "SP")], [])
    got = {(r.product_id_a, r.product_id_b): (r.cooccurrence_count, r.cooccurrence_score)
           for r in gold.cooccurrence(L, bucket_rows=1).collect()}
    assert got == {(A, B): (2, 0.666667), (A, C): (1, round(1 / 3, 6)), (B, C): (1, 0.5)}


def test_g6_tie_order(spark):
    items = [(1, 1, 10, 1, 1.0, 1.0, 2.0), (2, 1, 11, 1, 1.0, 1.0, 2.0), (3, 1, 12, 1, 1.0, 1.0, 2.0)]
    reviews = [(1, 1, 4.0, "positivo"), (3, 3, 4.5, None)]
    L = _layer(spark, items, [(o, 1, 1, False) for o in (1, 2, 3)], [(1, 1, "x", "SP")], reviews)
    top = gold.top_by_segment(L).where("segment_type = 'global'").orderBy("rank").collect()
    assert [r.product_id for r in top] == [12, 10, 11]


def test_f5_haversine(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0, 2.0), (None, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0)],
                               "a double, b double, c double, d double")
    out = [r.km for r in df.select(haversine_km("a", "b", "c", "d").alias("km")).collect()]
    assert out[0] == 0.0 and out[1] is None
    assert out[2] == pytest.approx(6371 * math.pi / 180)


def test_f7_price_bands(spark):
    df = spark.createDataFrame([(0.0,), (49.99,), (50.0,), (1000.0,), (-1.0,)], "p double")
    assert [r.b for r in df.select(price_band("p").alias("b")).collect()] == ["0-50", "0-50", "50-100", "1000+", None]


def test_h8_repeat_ratio(spark):
    from mercato.plans import details
    cust = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "customer_id long, customer_unique_id long")
    orders = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 3)], "order_id long, customer_id long")
    items = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (4, 7)], "order_id long, product_id long")
    r = details.product_repeat({"customers": cust, "orders": orders, "order_items": items}).first()
    assert r.repeat_product == 0.5
    items2 = spark.createDataFrame([(3, 8), (4, 8)], "order_id long, product_id long")
    r2 = details.product_repeat({"customers": cust, "orders": orders, "order_items": items2}).first()
    assert r2.repeat_product == 0.0


def test_r7_cold_start_priority(spark):
    from mercato.plans.recommend import cold_start
    top = spark.createDataFrame(
        [("state", "SP", 1, 100), ("category", "toys", 1, 200), ("global", "all", 1, 300)],
        "segment_type string, segment_value string, rank long, product_id long").withColumn(
        "product_category_name_english", F.lit("x")).withColumn("avg_review_score", F.lit(4.0)) \
        .withColumn("avg_price", F.lit(1.0)).withColumn("total_orders", F.lit(1))
    req = spark.createDataFrame([(1, "sp", None), (2, "XX", "TOYS"), (3, None, None)],
                                "customer_unique_id long, state string, category string")
    got = {r.customer_unique_id: r.product_id for r in cold_start.recommend(req, top).collect()}
    assert got == {1: 100, 2: 200, 3: 300}


def test_r21_r22_precision_and_split(spark):
    from mercato.plans.recommend import evaluate
    recs = spark.createDataFrame([(1, k, k) for k in range(1, 11)], "customer_unique_id long, rank long, rec_id long")
    rel = spark.createDataFrame([(1, 3), (1, 7), (1, 99)], "customer_unique_id long, rel_id long")
    assert evaluate.precision_at_k(recs, rel, 10).first().precision == 0.2
    hist = [(u, p, float(100 - p)) for u, n in ((1, 2), (2, 10), (3, 15)) for p in range(n)]
    inter = spark.createDataFrame(hist, "customer_unique_id long, product_id long, implicit_score double")
    split = evaluate.cf_split(inter).where("role = 'relevant'").groupBy("customer_unique_id").count()
    assert {r.customer_unique_id: r["count"] for r in split.collect()} == {1: 1, 2: 2, 3: 3}
