"""The batch job users run: bronze -> silver -> gold -> details ->
reports -> recommendations, each layer written as Parquet and read back by
the next (so every stage starts from a short lineage and a failed stage can
be re-run alone).

    python -m mercato.jobs --bronze <dir of table.csv | table/> --out <dir>

``bronze`` may also be given as a dict of DataFrames (tests, the driver's
mapping views). Steps are ``(name, fn)`` pairs; ``timer`` receives each
step's name and seconds.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans import dashboards, details, explore, gold, graph, silver
from mercato.plans.recommend import als, cold_start, content, copurchase, evaluate, hybrid, publish, router, vectors
from mercato.sources.io import load_layer, write_table


USER, ITEM = als.USER, als.ITEM


def _noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def steps(spark: SparkSession, bronze: dict[str, DataFrame], out: str, reports: bool = True,
          ml: bool = True, trees: int = 200, fit: dict | None = None) -> list[tuple[str, Callable[[], None]]]:
    """The ordered steps; each reads what earlier steps wrote. ``trees`` of the
    ranker; ``fit`` goes to ``als.fit``."""
    st: list[tuple[str, Callable[[], None]]] = []
    for name, df in silver.build(bronze).items():
        st.append((f"silver_{name}", lambda df=df, name=name: write_table(df, f"{out}/silver/{name}")))
    cache: dict[str, DataFrame] = {}

    class _Layer(dict):
        """Tables of a written layer, each read once on first use."""

        def __init__(self, name):
            super().__init__()
            self.name = name

        def __missing__(self, table):
            key = f"{self.name}/{table}"
            if key not in cache:
                cache[key] = spark.read.parquet(f"{out}/{key}")
            return cache[key]

    silver_l, gold_l = _Layer("silver"), _Layer("gold")
    S = lambda: silver_l
    G = lambda: gold_l
    for name, fn in [("user_product_interactions", gold.interactions), ("product_features", gold.product_features),
                     ("customer_profile", gold.customer_profile), ("category_affinity", gold.category_affinity),
                     ("product_cooccurrence", gold.cooccurrence)]:
        st.append((f"gold_{name}", lambda fn=fn, name=name: write_table(fn(S()), f"{out}/gold/{name}")))
    st.append(("gold_top_products_by_segment", lambda: write_table(
        gold.top_by_segment(S(), G()["product_features"]), f"{out}/gold/top_products_by_segment")))
    st.append(("details_delivery", lambda: write_table(details.delivery(bronze), f"{out}/details/delivery")))
    D = lambda: spark.read.parquet(f"{out}/details/delivery")
    st.append(("details_sellers", lambda: write_table(details.sellers_details(bronze), f"{out}/details/sellers")))
    st.append(("details_customers", lambda: write_table(
        details.customer_details(bronze, G()["customer_profile"], D()), f"{out}/details/customers")))
    st.append(("details_products", lambda: write_table(
        details.product_details(bronze, G()["product_features"]), f"{out}/details/products")))
    if reports:
        st.append(("details_density_corr", lambda: (_noop(details.density_grid(D())),
                                                    _noop(details.distance_time_corr(D())))))
        st.append(("explore_silver", lambda: [_noop(f(S())) for f in (
            explore.revenue_by_state, explore.delivery_days_by_state, explore.late_rate_by_state,
            explore.purchases_by_weekday, explore.late_pct_by_month, explore.approval_outliers,
            explore.days_to_arrive)]))
        st.append(("dashboards", lambda: [_noop(dashboards.price_vs_rating(G()["product_features"])),
                                          _noop(dashboards.top_categories(G()["product_features"])),
                                          _noop(dashboards.by_state(G()["customer_profile"])),
                                          _noop(dashboards.by_payment(bronze["payments"]))]))
        loaded: dict[str, object] = {}
        st.append(("graph_nodes", lambda: loaded.update(nodes=graph.load_nodes(spark, S(), f"{out}/graph"))))
        st.append(("graph_edges", lambda: loaded.update(graph=graph.load(spark, S(), f"{out}/graph", found=loaded["nodes"]))))

        def graph_queries():
            n, e = loaded["graph"].nodes, loaded["graph"].edges
            for df in (graph.top_sellers_by_revenue(n, e), graph.top_categories_by_review(n, e),
                       graph.multi_state_buyers(n), graph.category_pairs(S())):
                _noop(df)
        st.append(("graph_queries", graph_queries))
    st.append(("rec_content_similar", lambda: write_table(content.similar(G()["product_features"], 10),
                                                          f"{out}/rec/similar")))

    def requests():
        return G()["customer_profile"].select("customer_unique_id", F.col("customer_state").alias("state"),
                                              F.col("preferred_category").alias("category"))
    st.append(("rec_cold_start", lambda: write_table(cold_start.recommend(requests(), G()["top_products_by_segment"]),
                                                     f"{out}/rec/cold_start")))
    st.append(("rec_also_bought", lambda: write_table(copurchase.also_bought(G()["product_cooccurrence"]),
                                                      f"{out}/rec/also_bought")))
    st.append(("rec_cross_category", lambda: write_table(router.cross_category(
        G()["category_affinity"], G()["top_products_by_segment"], G()["user_product_interactions"]),
        f"{out}/rec/cross_category")))
    st.append(("rec_vector_similar", lambda: write_table(vectors.similar_vectors(G()["product_features"], 10),
                                                         f"{out}/rec/similar_vectors")))
    if ml:
        st += _learned_steps(spark, out, G, trees, fit or {})
    return st


def _learned_steps(spark: SparkSession, out: str, gold_layer: Callable, trees: int, fit: dict) -> list[tuple[str, Callable[[], None]]]:
    """Collaborative filtering, the ranker, the routed lists, the evaluation, and the published version of it all."""
    G = gold_layer
    kept: dict = {}
    rec = lambda name: spark.read.parquet(f"{out}/rec/{name}")
    inter = lambda: G()["user_product_interactions"]

    def cf():
        kept["idx"] = als.index_interactions(inter())
        kept["als"] = als.fit(kept["idx"], **fit)
        write_table(als.recommend(kept["als"], kept["idx"], 10), f"{out}/rec/cf")

    def ranker():
        ft = hybrid.feature_tables(spark.read.parquet(f"{out}/details/customers"), spark.read.parquet(f"{out}/details/products"))
        sample = hybrid.user_sample(G()["customer_profile"], inter())
        pos = inter().join(sample, USER, "left_semi").select(USER, ITEM).distinct().checkpoint()
        neg = hybrid.negatives(pos, inter().select(ITEM))
        split = hybrid.stratified_split(hybrid.training_set(pos, neg, ft)).checkpoint()
        kept.update(ft=ft, split=split, ranker=hybrid.train(split.where("NOT is_test"), trees=trees))

    def hybrid_lists():
        candidates = als.recommend(kept["als"], kept["idx"], 50)
        write_table(hybrid.rerank(candidates, kept["ft"], kept["ranker"], 10), f"{out}/rec/hybrid")

    def routed():
        everyone = spark.read.parquet(f"{out}/silver/customers").select("customer_unique_id").distinct()
        r = router.route(everyone, inter(), G()["customer_profile"])
        write_table(router.combine(r, rec("hybrid"), rec("cf"), rec("cold_start")), f"{out}/rec/routed")

    def evaluation():
        content_ = evaluate.summary(evaluate.content_eval(inter(), rec("similar")), "content_tfidf")
        cf_ = evaluate.summary(evaluate.cf_eval(inter(), **fit), "collaborative_filtering_als")
        write_table(content_.unionByName(cf_), f"{out}/rec/evaluation")
        write_table(hybrid.evaluate(kept["ranker"], kept["split"].where("is_test")), f"{out}/rec/ranker_report")
        write_table(hybrid.importances(kept["ranker"]), f"{out}/rec/ranker_importances")

    def published():
        ft, idx = kept["ft"], kept["idx"]
        publish.publish(spark, f"{out}/published", {"als": kept["als"], "ranker": kept["ranker"]},
                        {"customer_features": ft.customers, "product_features": ft.products, "users": idx.users, "items": idx.items,
                         **{f"codes_{k}": v for k, v in ft.codes.items()}})

    return [("rec_als_fit_recommend", cf), ("rec_ranker_fit", ranker), ("rec_hybrid", hybrid_lists), ("rec_routed", routed),
            ("rec_evaluation", evaluation), ("rec_publish", published)]


def run(spark: SparkSession, bronze: dict[str, DataFrame], out: str, timer: Callable[[str, float], None] | None = None,
        **kw) -> None:
    for name, fn in steps(spark, bronze, out, **kw):
        t = time.time()
        fn()
        if timer:
            timer(name, time.time() - t)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--bronze", required=True, help="folder with one CSV (or Parquet) per bronze table")
    ap.add_argument("--format", default="csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--name", action="append", default=[], metavar="FILE=TABLE",
                    help="file or folder name of a bronze table, where it differs from the table's name")
    ap.add_argument("--no-ml", action="store_true")
    ap.add_argument("--no-reports", action="store_true")
    a = ap.parse_args(argv)
    from mercato.session import get_session
    spark = get_session()
    bronze = load_layer(spark, a.bronze, fmt=a.format, names=dict(x.split("=", 1) for x in a.name),
                        expected=silver.CLEANERS)
    run(spark, bronze, a.out, timer=lambda n, s: print(f"{n}: {s:.1f}s"), ml=not a.no_ml,
        reports=not a.no_reports)


if __name__ == "__main__":
    main()
