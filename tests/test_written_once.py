"""Tables that several steps read are made once; the steps count what plain Python counts."""

import itertools
import threading
from collections import Counter

from pyspark.sql import functions as F

from mercato.operators import histogram
from mercato.plans import gold, graph, queries, silver
from mercato.plans.recommend import als, cold_start


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def _items(spark):
    # (order, line, product, seller, price): a row twice with another seller, one without price
    rows = [(o, n, f"p{(o * 3 + n) % 7}", f"s{(o + n) % 3}", 1.0 + o) for o in range(12) for n in range(3)]
    rows += [(1, 1, "p9", "s0", 5.0), (2, 9, "p1", "s0", None)]
    df = spark.createDataFrame(rows, "order_id long, order_item_id int, product_id string, seller_id string, price double")
    return df.select("*", (F.col("price") / 10).alias("freight_value"), F.lit("2020-01-01").cast("timestamp_ntz").alias("shipping_limit_date"))


def test_items_are_deduplicated_once(spark):
    clean = silver.clean_order_items(_items(spark))
    plan = _plan(clean)
    # neither the keep-first nor the statistics are part of what a reader runs
    assert "percentile_approx" not in plan and "Aggregate" not in plan and "FileScan parquet" in plan
    got = {(r.order_id, r.order_item_id): r.product_id for r in clean.collect()}
    assert got[1, 1] == "p4" and (2, 9) not in got


def test_layer_makes_only_what_is_read():
    made = []
    layer = silver.Layer({n: (lambda n=n: made.append(n) or n.upper()) for n in "ab"})
    assert layer["b"] == "B" and layer["b"] == "B" and made == ["b"]
    assert dict(layer.items()) == {"a": "A", "b": "B"} and made == ["b", "a"]


def _layer(spark):
    c = spark.createDataFrame([(i, f"u{i // 2}", f"z{i}", "city", None if i == 5 else f"ST{i % 2}") for i in range(6)],
                              "customer_id long, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string")
    o = spark.createDataFrame([(i, i % 7, "delivered", 3, i % 2 == 0) for i in range(12)],
                              "order_id long, customer_id long, order_status string, delivery_days long, is_late boolean")
    o = o.select("*", *[F.lit("2020-01-01").cast("timestamp_ntz").alias(x) for x in ("order_purchase_timestamp", "order_delivered_customer_date")])
    p = spark.createDataFrame([(f"p{i}", None if i == 3 else f"c{i % 2}", 1.0, 1.0) for i in range(6)],
                              "product_id string, product_category_name string, product_weight_g double, product_photos_qty double")
    t = spark.createDataFrame([("c0", "cat0"), ("c1", "cat1")], "product_category_name string, product_category_name_english string")
    s = spark.createDataFrame([(f"s{i}", "city", None if i == 2 else f"S{i}", "z") for i in range(3)],
                              "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix string")
    r = spark.createDataFrame([(100 + i, i // 2, float(1 + i % 5), ["negativo", "neutro", "positivo"][i % 3]) for i in range(16)],
                              "review_id long, order_id long, review_score double, sentiment string")
    r = r.select("*", F.lit("x").alias("review_comment_message"), F.lit("2020-01-01").cast("timestamp_ntz").alias("review_creation_date"))
    return {"customers": c, "orders": o, "products": p, "translation": t, "sellers": s, "reviews": r, "order_items": silver.clean_order_items(_items(spark))}


def test_paths_equal_plain_loops_and_join_each_node_once(spark):
    layer = _layer(spark)
    n = graph.nodes(layer)
    tab = {k: v.collect() for k, v in layer.items()}
    cust = {r.customer_id: r for r in tab["customers"]}
    order = {r.order_id: cust.get(r.customer_id) for r in tab["orders"]}
    prod = {r.product_id: r for r in tab["products"]}
    state = {r.seller_id: r.seller_state for r in tab["sellers"]}
    want = Counter((order[i.order_id].customer_unique_id, i.product_id, prod[i.product_id].product_category_name, i.price, r.review_score,
                    f"{i.order_id}_{i.order_item_id}", str(r.review_id))
                   for i in tab["order_items"] for r in tab["reviews"]
                   if r.order_id == i.order_id and order.get(i.order_id) and i.product_id in prod)
    paths = graph.products_by_person(n)
    assert Counter(tuple(r) for r in paths.collect()) == want and want
    assert _plan(paths).count("Join") <= 5
    own = {}
    for i in tab["order_items"]:
        if order.get(i.order_id) and state.get(i.seller_id):
            own.setdefault(str(order[i.order_id].customer_id), set()).add(state[i.seller_id])
    got = {r.customer_id: r.states for r in graph.multi_state_buyers(n, 2).collect()}
    assert got == {k: ",".join(sorted(v)) for k, v in own.items() if len(v) >= 2} and got


def test_segments_and_features_equal_plain_loops(spark):
    layer = _layer(spark)
    tab = {k: v.collect() for k, v in layer.items()}
    cust = {r.customer_id: r.customer_state for r in tab["customers"]}
    buyer = {r.order_id: cust.get(r.customer_id) for r in tab["orders"]}
    cat = {r.product_id: {"c0": "cat0", "c1": "cat1"}.get(r.product_category_name) for r in tab["products"]}
    want = Counter()
    for i in tab["order_items"]:
        want["global", "all", i.product_id] += 1
        if buyer.get(i.order_id):
            want["state", buyer[i.order_id], i.product_id] += 1
        if cat.get(i.product_id):
            want["category", cat[i.product_id], i.product_id] += 1
    counts = {tuple(r)[:3]: r["_seg_orders"] for r in gold.segment_counts(layer).collect()}
    assert counts == dict(want)
    top = gold.top_by_segment(layer, n=2)
    # the counts are cut to n (and ties) before the features are joined, then ranked
    assert _plan(top).count("WindowGroupLimit") == 4
    feats = {r.product_id: r for r in gold.product_features(layer).collect()}
    for seg in {k[:2] for k in want}:
        best = sorted((k[2] for k in want if k[:2] == seg), key=lambda p: (
            -want[(*seg, p)], -(feats[p].avg_review_score if p in feats and feats[p].avg_review_score is not None else -1), p))[:2]
        assert [r.product_id for r in sorted(top.collect(), key=lambda r: r["rank"]) if tuple(r)[:2] == seg] == best
    sold = Counter((i.product_id, i.seller_id) for i in tab["order_items"])
    state = {r.seller_id: r.seller_state for r in tab["sellers"]}
    for p, f in feats.items():
        of = sorted(((-c, s) for (q, s), c in sold.items() if q == p))
        assert f.total_orders == (sum(-c for c, _ in of) or None) and f.seller_state == (state[of[0][1]] if of else None)


def test_models_take_the_tables_of_their_query(spark, tmp_path, monkeypatch):
    own = spark.createDataFrame([(f"u{i}", f"p{j}", 1.0 + (i * j) % 3) for i in range(8) for j in range(30) if (i + j) % 4 == 0],
                                "customer_unique_id string, product_id string, implicit_score double")
    monkeypatch.setattr(queries, "_assets", lambda *_: 1 / 0)
    a = {"inter": own}
    idx, model = queries._als(spark, str(tmp_path), a)
    lists = queries._candidates(spark, str(tmp_path), a)
    ten = als.recommend(model, idx, n=10)
    key = lambda d: sorted((r.customer_unique_id, r["rank"], r.product_id) for r in d.collect())
    assert key(lists.where("rank <= 10")) == key(ten)


def test_serving_lists_are_ranked_once_a_context(spark):
    # (segment type, segment value, product, category, orders): equal counts, a product in two segments, no count
    top = [("state", "A", "p1", "c1", 5), ("state", "A", "p2", "c2", 5), ("state", "A", "p3", "c1", 9), ("state", "B", "p4", "c2", None),
           ("category", "c1", "p1", "c1", 7), ("category", "c1", "p5", "c1", 7), ("global", "all", "p6", None, 20), ("global", "all", "p3", "c1", 9)]
    asked = [("u1", "A", "c1"), ("u2", "A", None), ("u3", "Z", "c1"), ("u4", None, None), ("u5", "B", "c1"), ("u6", "Z", "nope"), ("u1", "A", "c1"), ("u7", None, "c2")]
    req = spark.createDataFrame(asked, "customer_unique_id string, state string, category string")
    out = cold_start.recommend_serving(req, spark.createDataFrame(
        top, "segment_type string, segment_value string, product_id string, product_category_name_english string, total_orders long"), n=2)
    # the requests only look their list up
    assert "Window" not in _plan(out) and _plan(out).count("Join") == 1
    want = Counter()
    for u, st, cat in set(asked):
        for level, rows in (("state", [t for t in top if st is not None and t[1] == st]), ("category", [t for t in top if cat is not None and t[3] == cat]), ("global", top)):
            if rows:
                best = {}
                for t in rows:
                    best[t[2]] = max(best.get(t[2], -1), -1 if t[4] is None else t[4])
                want.update((u, level, i + 1, p) for i, (_, p) in enumerate(sorted((-c, p) for p, c in best.items())[:2]))
                break
    assert Counter((r.customer_unique_id, r.level, r["rank"], r.product_id) for r in out.collect()) == want


def test_histogram_reads_its_rows_once(spark):
    rows = [(float(i % 7), i) for i in range(50)] + [(None, 1), (float("nan"), 2)]
    df = spark.createDataFrame(rows, "x double, k int").join(spark.range(50).select(F.col("id").cast("int").alias("k")), "k")
    out = histogram(df, "x", 3)
    assert "k#" not in _plan(out)
    assert sorted((r.bin, r.bin_start, r.bin_end, r["count"]) for r in out.collect()) == [(0, 0.0, 2.0, 15), (1, 2.0, 4.0, 14), (2, 4.0, 6.0, 21)]


def test_pairs_carry_their_products_counts(spark):
    layer = _layer(spark)
    baskets = {}
    for i in layer["order_items"].collect():
        baskets.setdefault(i.order_id, []).append(i.product_id)
    baskets = [set(b) for b in baskets.values() if len(b) > 1]
    n, pairs = Counter(p for b in baskets for p in b), Counter(x for b in baskets for x in itertools.combinations(sorted(b), 2))
    want = {(a, b, c, round(c / (n[a] + n[b] - c), 6)) for (a, b), c in pairs.items()}
    for bucket_rows in (1, 2048):
        scores = gold.cooccurrence_scores(layer, bucket_rows)
        # nothing is joined to the counted pairs
        assert "Join" not in _plan(scores).split("Aggregate")[0] and _plan(scores).count("Join") == 3
        assert {tuple(r) for r in scores.collect()} == want and want
    cat = {r.product_id: {"c0": "cat0", "c1": "cat1"}.get(r.product_category_name) for r in layer["products"].collect()}
    assert {tuple(r) for r in gold.cooccurrence(layer).collect()} == {(a, b, cat.get(a), cat.get(b), c, s) for a, b, c, s in want}


def test_fits_run_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=60)  # broken unless both are inside
    count = lambda n: both.wait() is not None and spark.range(n).count()
    assert queries._together(lambda: count(3), lambda: count(5)) == [3, 5]
    a, made = queries._Assets(spark, "nowhere"), []
    a._make["bronze"] = lambda: made.append(1) or "b"
    assert queries._together(lambda: a["bronze"], lambda: a["bronze"]) == ["b", "b"] and made == [1]
