"""Registered queries beyond the silver jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.catalog import register, silver_layer
from mercato.plans import gold


def _gold(fn):
    def q(spark, sf_dir):
        return fn(silver_layer(spark, sf_dir))
    return q


register("g1_interactions")(_gold(gold.interactions))
register("g2_product_features")(_gold(gold.product_features))
register("g3_customer_profile")(_gold(gold.customer_profile))
register("g4_category_affinity")(_gold(gold.category_affinity))
register("g5_cooccurrence")(_gold(gold.cooccurrence))
register("g6_top_by_segment")(_gold(lambda layer: gold.top_by_segment(layer)))


@register("g7_contract")
def g7_contract(spark, sf_dir):
    layer = silver_layer(spark, sf_dir)
    return gold.contract({"user_product_interactions": gold.interactions(layer),
                          "product_features": gold.product_features(layer)})


# ---------------------------------------------------------------- details
from mercato.catalog import bronze  # noqa: E402
from mercato.plans import details  # noqa: E402


def _bronze(fn):
    def q(spark, sf_dir):
        return fn(bronze(spark, sf_dir))
    return q


register("h1_zip_geo")(_bronze(lambda b: details.zip_geo(b["geolocation"])))
register("h2_zip_counts")(_bronze(lambda b: details.zip_counts(b["geolocation"])))
register("h2_zip_inconsistent")(_bronze(lambda b: details.zip_inconsistent(b["geolocation"])))
register("h3_delivery")(_bronze(details.delivery))
register("h4_distance_corr")(_bronze(lambda b: details.distance_time_corr(details.delivery(b))))
register("h5_density")(_bronze(lambda b: details.density_grid(details.delivery(b))))
register("h5_hexbin")(_bronze(lambda b: details.hexbin(details.delivery(b))))
register("h5_hexbin_bounded")(_bronze(lambda b: details.hexbin(details.delivery(b), max_km=3000, max_days=60)))
register("h6_sellers")(_bronze(details.sellers_details))
register("h8_product_repeat")(_bronze(details.product_repeat))
register("h9_repeat_summary")(_bronze(lambda b: details.repeat_summary(details.product_repeat(b))))
register("h10_multi_seller")(_bronze(details.multi_seller_summary))


@register("h7_customers")
def h7_customers(spark, sf_dir):
    b = bronze(spark, sf_dir)
    profile = gold.customer_profile(silver_layer(spark, sf_dir))
    return details.customer_details(b, profile, details.delivery(b))


@register("h10_product_details")
def h10_product_details(spark, sf_dir):
    return details.product_details(bronze(spark, sf_dir), gold.product_features(silver_layer(spark, sf_dir)))


# ---------------------------------------------------------------- explorations
from mercato.operators import histogram  # noqa: E402
from mercato.plans import dashboards, explore, graph  # noqa: E402


def _silver(fn):
    def q(spark, sf_dir):
        return fn(silver_layer(spark, sf_dir))
    return q


register("e1_revenue_by_state")(_silver(explore.revenue_by_state))
register("e2_order_status")(_silver(explore.order_status))
register("e3_delivery_days_by_state")(_silver(explore.delivery_days_by_state))
register("e4_late_days_histogram")(_silver(explore.late_days_histogram))
register("e5_estimated_vs_real")(_silver(explore.estimated_vs_real))
register("e6_late_rate_by_state")(_silver(explore.late_rate_by_state))
register("e7_purchases_by_weekday")(_silver(explore.purchases_by_weekday))
register("e8_late_pct_by_month")(_silver(explore.late_pct_by_month))
register("e9_approval_outliers")(_silver(explore.approval_outliers))
register("e10_days_to_arrive")(_silver(explore.days_to_arrive))
register("e10_undelivered")(_silver(explore.undelivered))
register("e11_capital_share")(_silver(explore.capital_share))
register("e9_approval_outliers_narrow")(_silver(lambda s: explore.approval_outliers(s, fence=0.1)))


def _accented_capitals(s):
    """E11 with the first city of each state as its capital, cities accented."""
    g = s["geolocation"]
    caps = g.groupBy("geolocation_state").agg(F.min("geolocation_city").alias("capital"))
    accented = g.withColumn("geolocation_city", F.translate("geolocation_city", "aeiou", "áéíõü"))
    return explore.capital_share({"geolocation": accented}, caps)


register("e11_capital_share_accented")(_silver(_accented_capitals))
register("e12_interaction_stats")(_silver(lambda s: explore.interaction_stats(gold.interactions(s))))
register("e12_implicit_histogram")(_silver(lambda s: histogram(gold.interactions(s), "implicit_score", 30)))
register("e12_sentiment_mix")(_silver(lambda s: explore.sentiment_mix(gold.interactions(s))))
register("e12_top_categories")(_silver(
    lambda s: explore.top_counts(gold.interactions(s), "product_category_name_english", 10)))
register("e13_product_stats")(_silver(lambda s: explore.product_stats(gold.product_features(s))))
register("e13_price_histogram")(_silver(lambda s: explore.clipped_price_histogram(gold.product_features(s))))
register("e13_score_histogram")(_silver(lambda s: histogram(gold.product_features(s), "avg_review_score", 20)))
register("e13_top_products")(_silver(lambda s: explore.top_products(gold.product_features(s))))
register("e14_customer_stats")(_silver(lambda s: explore.customer_stats(gold.customer_profile(s))))
register("e14_top_states")(_silver(lambda s: explore.top_counts(gold.customer_profile(s), "customer_state", 15)))
register("e14_top_preferred_categories")(_silver(
    lambda s: explore.top_counts(gold.customer_profile(s), "preferred_category", 10)))
register("e14_payment_mix")(_silver(lambda s: explore.value_counts(gold.customer_profile(s), "preferred_payment_type")))
register("e14_installments_histogram")(_silver(lambda s: histogram(gold.customer_profile(s), "avg_installments", 20)))
register("e15_affinity_stats")(_silver(lambda s: explore.affinity_stats(gold.category_affinity(s))))
register("e15_affinity_histogram")(_silver(lambda s: histogram(gold.category_affinity(s), "affinity_score", 50)))
register("e15_top_affinity_categories")(_silver(lambda s: explore.top_affinity_categories(gold.category_affinity(s))))
register("e16_top_cooccurrence")(_silver(lambda s: explore.top_cooccurrence(gold.cooccurrence(s))))
register("e16_count_histogram")(_silver(lambda s: explore.cooccurrence_count_histogram(gold.cooccurrence_scores(s))))
register("e16_score_histogram")(_silver(lambda s: histogram(gold.cooccurrence_scores(s), "cooccurrence_score", 30)))
register("e17_segment_samples")(_silver(lambda s: explore.segment_samples(gold.top_by_segment(s))))
register("e17_segment_coverage")(_silver(lambda s: explore.segment_coverage(gold.top_by_segment(s))))

# ---------------------------------------------------------------- dashboards
register("d1_price_vs_rating")(_silver(lambda s: dashboards.price_vs_rating(gold.product_features(s))))
register("d2_top_categories")(_silver(lambda s: dashboards.top_categories(gold.product_features(s))))
register("d3_by_state")(_silver(lambda s: dashboards.by_state(gold.customer_profile(s))))
register("d4_by_payment")(_bronze(lambda b: dashboards.by_payment(b["payments"])))


@register("d5_product_detail")
def d5_product_detail(spark, sf_dir):
    b = bronze(spark, sf_dir)
    pd_ = details.product_details(b, gold.product_features(silver_layer(spark, sf_dir)))
    return dashboards.product_detail(b["order_items"].select("product_id"), pd_)


# ---------------------------------------------------------------- graph
def _graph(fn):
    def q(spark, sf_dir):
        s = silver_layer(spark, sf_dir)
        n = graph.nodes(s)
        return fn(s, n, graph.edges(n))
    return q


register("k1_nodes")(_graph(lambda s, n, e: graph.node_keys(n)))
register("k2_edges")(_graph(lambda s, n, e: e))
register("k3_synthetic_keys")(_graph(lambda s, n, e: n["Payment"].select("payment_id", "order_id").unionByName(
    n["OrderItem"].select(F.col("item_id").alias("payment_id"), "order_id"))))
register("k4_label_counts")(_graph(lambda s, n, e: graph.label_counts(n)))
register("k4_rel_counts")(_graph(lambda s, n, e: graph.rel_counts(e)))
register("k5_path_sample")(_graph(lambda s, n, e: graph.path_sample(e)))
register("k6_products_by_person")(_silver(lambda s: graph.products_by_person(graph.nodes(s))))
register("k7_top_sellers")(_graph(lambda s, n, e: graph.top_sellers_by_revenue(n, e)))
register("k8_top_categories_by_review")(_graph(lambda s, n, e: graph.top_categories_by_review(n, e)))
register("k9_multi_state_buyers")(_silver(lambda s: graph.multi_state_buyers(graph.nodes(s))))
register("k10_expensive_freight")(_graph(lambda s, n, e: graph.expensive_freight(n)))
register("k11_category_sales")(_silver(graph.category_sales))
register("k12_category_pairs")(_silver(graph.category_pairs))
register("k13_state_tickets")(_silver(graph.state_tickets))
register("k14_payment_revenue")(_silver(graph.payment_revenue))


# ---------------------------------------------------------------- recommenders
from mercato.operators import roc_auc  # noqa: E402
from mercato.plans.recommend import als, cold_start, content, copurchase, evaluate, hybrid, router, vectors  # noqa: E402
from mercato.plans.silver import Layer  # noqa: E402
from mercato.session import cut  # noqa: E402

from concurrent.futures import ThreadPoolExecutor  # noqa: E402
from threading import RLock  # noqa: E402

from pyspark.util import inheritable_thread_target  # noqa: E402

_FITTED: dict = {}
#: Fitted models and training sets kept at once; older ones are dropped.
_KEPT = 8


class _Assets(dict):
    """Gold/detail tables the recommenders read, built lazily on first use.
    Tables used by several branches of a plan are written once (``cut``, in
    ``spark.checkpoint.dir``, like a written silver or gold
    table): later stages read them instead of re-deriving them, and lineage
    stays short if executors are lost. A query hands its tables on to the models
    that it fits, so none is made twice; models may be fitted in threads (``_together``)."""

    CLEANED = {"customers", "orders", "payments", "reviews"}
    SHARED = {"pf", "profile", "inter", "top", "cooc", "aff", "cust_details", "prod_details"}

    def __init__(self, spark, sf_dir):
        super().__init__()
        self.spark, self.sf_dir, self._lock = spark, sf_dir, RLock()
        self._make = {
            "silver": self._silver,
            "bronze": lambda: bronze(spark, sf_dir),
            "pf": lambda: gold.product_features(self["silver"]),
            "profile": lambda: gold.customer_profile(self["silver"]),
            "inter": lambda: gold.interactions(self["silver"]),
            "top": lambda: gold.top_by_segment(self["silver"], self["pf"]),
            "cooc": lambda: gold.cooccurrence(self["silver"]),
            "aff": lambda: gold.category_affinity(self["silver"]),
            "cust_details": lambda: details.customer_details(self["bronze"], self["profile"],
                                                             details.delivery(self["bronze"])),
            "prod_details": lambda: details.product_details(self["bronze"], self["pf"]),
        }

    def __missing__(self, key):
        with self._lock:
            if key not in self:
                val = self._make[key]()
                self[key] = cut(val) if key in self.SHARED else val
            return self[key]

    def _silver(self):
        layer = silver_layer(self.spark, self.sf_dir)
        return Layer({t: (lambda t=t: cut(layer[t]) if t in self.CLEANED else layer[t]) for t in layer})


def _assets(spark, sf_dir):
    return _Assets(spark, sf_dir)


def _profile_requests(a):
    return a["profile"].select("customer_unique_id", F.col("customer_state").alias("state"),
                               F.col("preferred_category").alias("category"))


def _state_of(spark, sf_dir) -> tuple:
    """Name, length and modification time of every file under ``sf_dir``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def _fitted(spark, sf_dir, name, make):
    """A fitted model or training set of one application and one state of
    the files it is made of: changed data are fitted anew."""
    key = (spark.sparkContext.applicationId, name, _state_of(spark, sf_dir))
    if key not in _FITTED:
        value = make()
        while len(_FITTED) >= _KEPT:
            _FITTED.pop(next(iter(_FITTED)))
        _FITTED[key] = value
    return _FITTED[key]


def _als(spark, sf_dir, a=None):
    def make():
        idx = als.index_interactions((_assets(spark, sf_dir) if a is None else a)["inter"])
        return idx, als.written(als.fit(idx))
    return _fitted(spark, sf_dir, "als", make)


def _training(spark, sf_dir, own=None):
    """Sample, negatives, features, split (materialised once)."""
    def make():
        a = _assets(spark, sf_dir) if own is None else own
        ft = hybrid.feature_tables(a["cust_details"], a["prod_details"])
        ft = hybrid.FeatureTables(cut(ft.customers), cut(ft.products), ft.codes)
        sample = hybrid.user_sample(a["profile"], a["inter"])
        pos = a["inter"].join(sample, "customer_unique_id", "left_semi").select("customer_unique_id", "product_id").distinct()
        neg = hybrid.negatives(pos, a["inter"].select("product_id"))
        return ft, cut(hybrid.stratified_split(cut(hybrid.training_set(pos, neg, ft))))
    return _fitted(spark, sf_dir, "training", make)


def _ranker(spark, sf_dir, a=None, trees: int = 200):
    def make():
        ft, split = _training(spark, sf_dir, a)
        return ft, split, hybrid.train(split.where(~F.col("is_test")), trees=trees)
    return _fitted(spark, sf_dir, f"gbt{trees}", make)


@register("r1_product_text")
def r1(spark, sf_dir):
    return content.product_text(_assets(spark, sf_dir)["pf"])


@register("r2_tfidf")
def r2(spark, sf_dir):
    from mercato.functions import np_round
    t = content.product_tfidf(_assets(spark, sf_dir)["pf"])
    return t.withColumn("weight", np_round("weight", 12))


@register("r3_similar_products")
def r3(spark, sf_dir):
    return content.similar(_assets(spark, sf_dir)["pf"], n=10)


def words_features(pf):
    """Product features with several words a category, a repeated token, and
    products without category, without seller state, or without both."""
    pid = F.col("product_id").cast("string")
    words = F.concat(F.replace("product_category_name_english", F.lit("_"), F.lit(" ")), F.lit(" unknown line of unknown make"))
    return (pf.withColumn("product_category_name_english", F.when(pid.endswith("7"), None).otherwise(words))
            .withColumn("seller_state", F.when(pid.endswith("7") | pid.endswith("3"), None).otherwise(F.col("seller_state"))))


@register("r3_similar_words")
def r3_words(spark, sf_dir):
    return content.similar(words_features(_assets(spark, sf_dir)["pf"]), n=10)


@register("r4_density")
def r4_density(spark, sf_dir):
    return als.density_report(als.index_interactions(_assets(spark, sf_dir)["inter"]))


@register("r4_item_index")
def r4_index(spark, sf_dir):
    return als.index_interactions(_assets(spark, sf_dir)["inter"]).items


@register("r6_cf_recommendations")
def r6(spark, sf_dir):
    return _cf(spark, sf_dir, _assets(spark, sf_dir))


def _cf(spark, sf_dir, a):
    idx, model = _als(spark, sf_dir, a)
    recs = als.recommend(model, idx, n=10)
    return als.with_product_attributes(recs, a["pf"]).drop("user_idx", "item_idx")


@register("r7_cold_start")
def r7(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return cold_start.recommend(_profile_requests(a), a["top"], n=10)


@register("r8_cold_start_serving")
def r8(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return cold_start.recommend_serving(_profile_requests(a), a["top"], n=10)


def _mixed_requests(a):
    """Requests with missing and unknown states and categories, by the last
    character of the customer id, so that every level answers some."""
    last = F.substring(F.col("customer_unique_id").cast("string"), -1, 1)
    r = _profile_requests(a)
    return (r.withColumn("state", F.when(last.isin("0", "1", "3"), None).when(last == "2", "ZZ").otherwise(F.col("state")))
            .withColumn("category", F.when(last == "1", None).when(last == "3", "nope").otherwise(F.col("category"))))


@register("r7_cold_start_mixed")
def r7_mixed(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return cold_start.recommend(_mixed_requests(a), a["top"], n=10)


@register("r8_cold_start_serving_mixed")
def r8_mixed(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return cold_start.recommend_serving(_mixed_requests(a), a["top"], n=10)


@register("r9_also_bought")
def r9(spark, sf_dir):
    return copurchase.also_bought(_assets(spark, sf_dir)["cooc"], n=10)


@register("r10_user_sample")
def r10(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return hybrid.user_sample(a["profile"], a["inter"])


@register("r11_negatives")
def r11(spark, sf_dir):
    a = _assets(spark, sf_dir)
    sample = hybrid.user_sample(a["profile"], a["inter"])
    pos = a["inter"].join(sample, "customer_unique_id", "left_semi").select("customer_unique_id", "product_id").distinct()
    return hybrid.negatives(pos, a["inter"].select("product_id"))


@register("r12_label_codes")
def r12(spark, sf_dir):
    a = _assets(spark, sf_dir)
    ft = hybrid.feature_tables(a["cust_details"], a["prod_details"])
    parts = [c.select(F.lit(name).alias("column_name"), "value", "code") for name, c in ft.codes.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("r13_training_set")
def r13(spark, sf_dir):
    return _training(spark, sf_dir)[1].drop("is_test")


@register("r14_split_counts")
def r14(spark, sf_dir):
    return _training(spark, sf_dir)[1].groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("rows"))


@register("r16_ranker_evaluation")
def r16(spark, sf_dir):
    ft, split, model = _ranker(spark, sf_dir)
    return hybrid.evaluate(model, split.where(F.col("is_test")))


@register("r16_popularity_auc")
def r16_popularity(spark, sf_dir):
    """What ranking by a product's number of orders alone would reach: few values, many ties."""
    return roc_auc(_training(spark, sf_dir)[1], "label", "produto_total_orders")


@register("r17_feature_importance")
def r17(spark, sf_dir):
    return hybrid.importances(_ranker(spark, sf_dir)[2])


def _together(*makes):
    """The results of functions that run at the same time, each in a thread: the
    many small jobs of one fit leave cores to the other."""
    with ThreadPoolExecutor(len(makes)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(m)) for m in makes]]


def _ranked(spark, sf_dir, a, *also):
    """(feature tables, ranker, candidates): the ranker is fitted while the candidates,
    then the tables ``also``, are made."""
    a["inter"]  # both begin with it

    def lists():
        found = _candidates(spark, sf_dir, a)
        for key in also:
            a[key]
        return found

    (ft, _, ranker), candidates = _together(lambda: _ranker(spark, sf_dir, a), lists)
    return ft, ranker, candidates


def _hybrid_recs(spark, sf_dir, a, n=10, also=()):
    ft, ranker, candidates = _ranked(spark, sf_dir, a, *also)
    return hybrid.rerank(candidates, ft, ranker, n)


@register("r18_hybrid")
def r18(spark, sf_dir):
    a = _assets(spark, sf_dir)
    hyb = _hybrid_recs(spark, sf_dir, a).withColumn("strategy", F.lit("hybrid"))
    routed = router.route(_profile_requests(a), a["inter"], a["profile"])
    cold = cold_start.recommend(routed.where(F.col("strategy") == "cold_start"), a["top"], n=10)
    lists = hyb.select("customer_unique_id", "rank", "product_id", "strategy", "score_hybrid").unionByName(
        cold.select("customer_unique_id", "rank", "product_id", F.lit("cold_start").alias("strategy"),
                    F.lit(None).cast("double").alias("score_hybrid")))
    return als.with_product_attributes(lists, a["pf"])


@register("r19_serving_hybrid")
def r19(spark, sf_dir):
    a = _assets(spark, sf_dir)
    ft, ranker, candidates = _ranked(spark, sf_dir, a)
    req = _profile_requests(a).withColumn("price", F.lit(None).cast("double"))
    return hybrid.rerank_with_context(candidates, req, ft, ranker)


@register("r19_serving_mixed")
def r19_mixed(spark, sf_dir):
    """Serving with gaps in the context, and customers never seen."""
    a = _assets(spark, sf_dir)
    ft, ranker, candidates = _ranked(spark, sf_dir, a, "top")
    idx, model = _als(spark, sf_dir, a)
    text = lambda d: d.withColumn("customer_unique_id", F.col("customer_unique_id").cast("string"))
    req = text(_mixed_requests(a)).withColumn("price", F.lit(99.9))
    req = req.unionByName(req.withColumn("customer_unique_id", F.concat(F.lit("new-"), F.col("customer_unique_id"))))
    own = hybrid.FeatureTables(text(ft.customers), ft.products, ft.codes)
    return hybrid.serve(req, text(candidates), text(idx.users),
                        cold_start.recommend_serving(req, a["top"], n=10), own, ranker)


def _candidates(spark, sf_dir, a=None):
    """The 50 best of collaborative filtering, written once: R18 and R19 rank them,
    the first ten are R20's own lists of that kind."""
    def make():
        idx, model = _als(spark, sf_dir, a)
        return cut(als.recommend(model, idx, n=50).select("customer_unique_id", "rank", "product_id"))
    return _fitted(spark, sf_dir, "candidates", make)


def _repeated_requests(a):
    """Two requests of every customer, at two prices, with a known rating in the second."""
    r = _profile_requests(a)
    key = lambda k: F.concat(F.col("customer_unique_id").cast("string"), F.lit(f"/{k}")).alias("request_id")
    one = r.select("*", key(1), F.lit(10.0).alias("price"), F.lit(None).cast("double").alias("rating"))
    return one.unionByName(r.select("*", key(2), F.lit(999.0).alias("price"), F.lit(1.0).alias("rating")))


@register("r19_serving_repeated")
def r19_repeated(spark, sf_dir):
    a = _assets(spark, sf_dir)
    ft, ranker, candidates = _ranked(spark, sf_dir, a)
    return hybrid.rerank_with_context(candidates, _repeated_requests(a), ft, ranker)


@register("r20_routing")
def r20_routing(spark, sf_dir):
    a = _assets(spark, sf_dir)
    req = a["bronze"]["customers"].select(F.col("customer_unique_id")).distinct()
    return router.route(req, a["inter"], a["profile"])


@register("r20_routing_mixed")
def r20_routing_mixed(spark, sf_dir):
    """Routing with customers that lost their profile, and ids never seen."""
    return _routing_mixed(_assets(spark, sf_dir))


def _routing_mixed(a):
    ids = a["bronze"]["customers"].select(F.col("customer_unique_id").cast("string").alias("customer_unique_id")).distinct()
    unseen = ids.select(F.concat(F.lit("new-"), F.col("customer_unique_id")).alias("customer_unique_id"))
    text = lambda d: d.withColumn("customer_unique_id", F.col("customer_unique_id").cast("string"))
    profile = text(a["profile"]).where(~F.col("customer_unique_id").endswith("4"))
    return router.route(ids.unionByName(unseen), text(a["inter"]), profile)


@register("r20_recommendations")
def r20(spark, sf_dir):
    a = _assets(spark, sf_dir)
    req = a["bronze"]["customers"].select("customer_unique_id").distinct()
    routed = cut(router.route(req, a["inter"], a["profile"]).join(
        a["inter"].groupBy("customer_unique_id").agg(F.min("product_id").alias("current_product_id")),
        "customer_unique_id", "left"))
    hyb = _hybrid_recs(spark, sf_dir, a, also=("top", "cooc"))
    cf = _candidates(spark, sf_dir, a).where("rank <= 10")
    cold = cold_start.recommend(
        routed.where("strategy = 'cold_start'").join(a["profile"].select("customer_unique_id", F.col("customer_state").alias("state"),
                                        F.col("preferred_category").alias("category")), "customer_unique_id", "left"),
        a["top"], n=10)
    return router.combine(routed, hyb, cf, cold, copurchase.also_bought(a["cooc"]))


@register("r20_recommendations_mixed")
def r20_mixed(spark, sf_dir):
    """Every strategy at work: customers that lost their profile, and ids never seen."""
    a = _assets(spark, sf_dir)
    text = lambda d: d.withColumn("customer_unique_id", F.col("customer_unique_id").cast("string"))
    routed = cut(_routing_mixed(a))
    known = F.col("customer_unique_id").cast("string")
    context = a["profile"].select(known.alias("_id"), F.col("customer_state").alias("state"), F.col("preferred_category").alias("category"))
    cold = routed.where("strategy = 'cold_start'").withColumn("_id", F.replace("customer_unique_id", F.lit("new-"), F.lit("")))
    return router.combine(routed, text(_hybrid_recs(spark, sf_dir, a, also=("top",))), text(_candidates(spark, sf_dir, a).where("rank <= 10")),
                          cold_start.recommend(cold.join(context, "_id", "left"), a["top"], n=10))


@register("r21_content_precision")
def r21(spark, sf_dir):
    return _content_precision(_assets(spark, sf_dir))


def _content_precision(a):
    return evaluate.content_eval(a["inter"], content.similar(a["pf"], n=10), k=10)


@register("r22_cf_evaluation")
def r22(spark, sf_dir):
    return _cf_summary(spark, sf_dir, _assets(spark, sf_dir))


def _cf_summary(spark, sf_dir, a):
    per_user = _fitted(spark, sf_dir, "cf_eval", lambda: cut(evaluate.cf_eval(a["inter"])))
    return evaluate.summary(per_user, "collaborative_filtering_als")


@register("r23_content_evaluation")
def r23(spark, sf_dir):
    return evaluate.summary(r21(spark, sf_dir), "content_tfidf")


@register("r24_method_comparison")
def r24(spark, sf_dir):
    a = _assets(spark, sf_dir)
    # the first is written before the second begins: its tables are not on disk beside the fit's
    content_ = cut(evaluate.summary(_content_precision(a), "content_tfidf"))
    return content_.unionByName(_cf_summary(spark, sf_dir, a))


@register("r26_cross_category")
def r26(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return router.cross_category(a["aff"], a["top"], a["inter"])


@register("r27_similar_vectors")
def r27(spark, sf_dir):
    return vectors.similar_vectors(_assets(spark, sf_dir)["pf"], n=10)


def _rough(pf):
    """Product features in coarse steps, with gaps: many products alike, and products without any number."""
    pid = F.col("product_id").cast("string")
    return (pf.withColumn("avg_price", F.when(pid.endswith("7"), None).otherwise(F.floor(F.col("avg_price") / 100) * 100.0))
            .withColumn("avg_freight_value", F.lit(10.0)).withColumn("total_orders", F.col("total_orders") % 3)
            .withColumn("total_reviews", F.when(pid.endswith("3"), F.col("total_reviews")))
            .withColumn("product_category_name_english", F.when(~pid.endswith("7"), F.col("product_category_name_english"))))


@register("r27_similar_vectors_rough")
def r27_rough(spark, sf_dir):
    return vectors.similar_vectors(_rough(_assets(spark, sf_dir)["pf"]), n=10)


# What must hold of the learned outputs whatever the model: each has a SQL twin.
def _lists(recs, *by):
    """Users, rows, and users whose ranks are not 1 .. n without gaps."""
    per = recs.groupBy(*by, "customer_unique_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"),
                                                     F.count_distinct("product_id").alias("items"))
    return per.groupBy(*by).agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("rows"),
                                F.count_if((F.col("top") != F.col("n")) | (F.col("items") != F.col("n"))).alias("broken"))


@register("r6_cf_invariants")
def r6_invariants(spark, sf_dir):
    a = _assets(spark, sf_dir)
    recs = cut(_cf(spark, sf_dir, a))  # read twice
    bought = recs.join(a["inter"], ["customer_unique_id", "product_id"], "left_semi")
    return _lists(recs).crossJoin(F.broadcast(bought.agg(F.count(F.lit(1)).alias("bought"))))


@register("r16_ranker_invariants")
def r16_invariants(spark, sf_dir):
    ok = lambda c: F.col(c).isNull() | F.col(c).between(0, 1)
    return r16(spark, sf_dir).select("class", "support", (ok("precision") & ok("recall") & ok("f1")
                                                          & F.col("roc_auc").between(0, 1)).alias("valid"))


@register("r17_importance_invariants")
def r17_invariants(spark, sf_dir):
    imp = r17(spark, sf_dir)
    return imp.crossJoin(F.broadcast(imp.agg(F.round(F.sum("importance"), 6).alias("total")))).select(
        "feature", (F.col("importance") >= 0).alias("valid"), "total")


@register("r18_hybrid_invariants")
def r18_invariants(spark, sf_dir):
    return _lists(r18(spark, sf_dir), "strategy")


@register("r19_serving_invariants")
def r19_invariants(spark, sf_dir):
    return _lists(r19(spark, sf_dir))


@register("r19_serving_repeated_invariants")
def r19_repeated_invariants(spark, sf_dir):
    """Lists of ten different products per request; the context moves some score of some customer."""
    recs = r19_repeated(spark, sf_dir)
    per = recs.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"), F.count_distinct("product_id").alias("items"))
    sums = per.agg(F.count(F.lit(1)).alias("requests"), F.sum("n").alias("rows"),
                   F.count_if((F.col("top") != F.col("n")) | (F.col("items") != F.col("n"))).alias("broken"))
    scores = recs.groupBy("customer_unique_id", "product_id").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    return sums.crossJoin(F.broadcast(scores.agg((F.count_if(F.col("lo") < F.col("hi")) > 0).alias("differ"))))


@register("r20_recommendations_mixed_invariants")
def r20_mixed_invariants(spark, sf_dir):
    return _lists(r20_mixed(spark, sf_dir), "strategy")


@register("r19_serving_mixed_invariants")
def r19_mixed_invariants(spark, sf_dir):
    return _lists(r19_mixed(spark, sf_dir), "strategy")


@register("r20_recommendation_invariants")
def r20_invariants(spark, sf_dir):
    return _lists(r20(spark, sf_dir).where("strategy <> 'also_bought'"), "strategy")


@register("r22_evaluation_invariants")
def r22_invariants(spark, sf_dir):
    return r24(spark, sf_dir).select("method", "users_evaluated", F.col("precision_at_k").between(0, 1).alias("valid"))


# ---------------------------------------------------------------- quality
from mercato.plans import quality  # noqa: E402


@register("q1_profile_items")
def q1(spark, sf_dir):
    return quality.profile(silver_layer(spark, sf_dir)["order_items"], "order_items")


@register("q1_profile_all")
def q1_all(spark, sf_dir):
    """Every table before and after cleaning."""
    parts = [quality.profile(df, f"{when}.{name}") for when, layer in (("before", bronze(spark, sf_dir)),
                                                                      ("after", silver_layer(spark, sf_dir)))
             for name, df in layer.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("q2_missing_share")
def q2(spark, sf_dir):
    b = bronze(spark, sf_dir)["products"]
    s = silver_layer(spark, sf_dir)["products"]
    return quality.missing_share(b, "before").unionByName(quality.missing_share(s, "after"))


@register("q2_quality_score")
def q2s(spark, sf_dir):
    return quality.quality_score(silver_layer(spark, sf_dir)["products"])


@register("q3_layer_overview")
def q3(spark, sf_dir):
    return quality.layer_overview(gold.build(_assets(spark, sf_dir)["silver"]))


@register("q4_rules")
def q4(spark, sf_dir):
    return quality.rules(gold.build(silver_layer(spark, sf_dir)))


@register("q5_customer_assertions")
def q5(spark, sf_dir):
    return quality.customer_assertions(silver_layer(spark, sf_dir)["customers"])


# ---------------------------------------------------------------- sources
from mercato.sources import io as _io  # noqa: E402

register("s5_head_orders")(_silver(lambda s: _io.head(s["orders"], ["order_id"], 5)))


# ------------------------------------------------- what is written and read again
import uuid  # noqa: E402

from mercato.functions.columns import norm_text  # noqa: E402
from mercato.plans import graph as _graph  # noqa: E402
from mercato.session import ensure_checkpoint_dir  # noqa: E402
from mercato.sources import ordered as _ordered  # noqa: E402
from mercato.sources.keyed import KeyedTable  # noqa: E402


@register("w6_ordered_interactions")
def w6(spark, sf_dir):
    """The interactions written in the reference's order and read with their places, without a sort."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    _ordered.write_ordered(_assets(spark, sf_dir)["inter"], path, ["customer_unique_id", ("implicit_score", False), "product_id"])
    return _ordered.read_ordered(spark, path)


@register("k1_order_items_loaded")
def k1_loaded(spark, sf_dir):
    """The item nodes with all their attributes after three loads into a keyed
    table: a third of them, all of them, all of them again."""
    items = cut(_graph.nodes(silver_layer(spark, sf_dir))["OrderItem"])
    tag = uuid.uuid4().hex
    t = KeyedTable.open(spark, f"items_{tag}", f"{ensure_checkpoint_dir(spark).rstrip('/')}/items-{tag}", items.schema,
                        ["item_id"], "order_id", buckets=8)
    for batch in (items.where(F.crc32("item_id") % 3 == 0), items, items):
        t.upsert(batch)
    return t.rows()


@register("p2_review_text")
def p2(spark, sf_dir):
    """Review messages normalised as text: blanks and the spelled-out nulls of text files become null."""
    rest = F.col("review_id") % 5
    raw = (F.when(rest == 0, F.lit("nan")).when(rest == 1, F.lit(" None\t"))
           .when(rest == 2, F.concat(F.lit("\n "), F.col("review_comment_message"), F.lit(" nan  "))).otherwise(F.col("review_comment_message")))
    return bronze(spark, sf_dir)["reviews"].select("review_id", norm_text(raw).alias("message"))
