"""R3 against brute force: repeated tokens, long categories, many ties."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from mercato.plans.recommend import content


def pf_rows():
    cats = ["home garden tools", "unknown", None, "one two three four five six seven", "unknown parts unknown", "home",
            "garden"]
    rows = []
    for i in range(60):
        rows.append((f"p{i:02d}", cats[i % 7], float([10, 100, 300, 900][i % 4]), [None, 4.5, 3.5, 1.0][i % 4 if i % 3 else 0],
                     [0.0, 0.7, 0.4, None][i % 2], ["SP", None, "RJ", "unknown"][i % 5 % 4]))
    return rows


def brute(texts, n):
    tok = {p: Counter(re.findall(r"\b\w\w+\b", t.lower())) for p, t in texts.items()}
    df = Counter(x for c in tok.values() for x in c)
    vec = {}
    for p, c in tok.items():
        w = {x: k * (math.log((1 + len(tok)) / (1 + df[x])) + 1) for x, k in c.items()}
        size = math.sqrt(sum(v * v for v in w.values()))
        vec[p] = {x: v / size for x, v in w.items()}
    out = []
    for p in texts:
        cos = [(-round(sum(v * vec[q].get(x, 0) for x, v in vec[p].items()), 12), q) for q in texts if q != p]
        out += [(p, k, q, round(-c, 4)) for k, (c, q) in enumerate(sorted(x for x in cos if x[0] < 0)[:n], 1)]
    return sorted(out)


def test_similar_products_match_brute_force(spark):
    pf = spark.createDataFrame(pf_rows(), "product_id string, product_category_name_english string, avg_price double, "
                                          "avg_review_score double, positive_sentiment_ratio double, seller_state string")
    texts = {r.product_id: r.text for r in content.product_text(pf).collect()}
    for n in (3, 10):
        got = sorted(tuple(r) for r in content.similar(pf, n).collect())
        assert [g[:3] for g in got] == [w[:3] for w in brute(texts, n)]
        assert all(abs(g[3] - w[3]) < 1e-4 for g, w in zip(got, brute(texts, n), strict=True))


def test_twin_with_repeated_token_is_found(spark):
    rows = [(1, "unknown", 10.0, 4.5, 0.7, "SP"), (2, "unknown", 10.0, 4.5, 0.7, "unknown")]
    rows += [(10 + i, "tools", 10.0, 4.5, 0.7, "RJ") for i in range(12)]
    pf = spark.createDataFrame(rows, "product_id long, product_category_name_english string, avg_price double, "
                                     "avg_review_score double, positive_sentiment_ratio double, seller_state string")
    got = [r.similar_product_id for r in content.similar(pf, 5).where("product_id = 1").orderBy("rank").collect()]
    assert got == [2, 10, 11, 12, 13]


def test_a_token_of_all_texts_reads_few_blocks(spark):
    # 600 texts of one shared token, some pairs of rare tokens, and noise of many sizes
    rows = []
    for i in range(600):
        own = [f"pair{i // 3}", f"half{i // 3}"] + [f"noise{(i * 7 + k) % 50}" for k in range(i % 5)]
        rows += [(f"t{i:03d}", t) for t in ["shared", *own]]
    tokens = spark.createDataFrame(rows, "text string, token string")
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    raw = tokens.join(held, "token").withColumn("_w", F.log(601 / (1 + F.col("k"))) + 1)
    size = raw.groupBy("text").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("norm"))
    sig = raw.join(size, "text").select("text", "token", (F.col("_w") / F.col("norm")).alias("weight"), "norm").checkpoint()
    lead = sig.select(F.col("text").alias("s2"), F.col("text").alias("_lead")).distinct()
    none = spark.createDataFrame([], "s1 string, s2 string, cos double")
    best, state = content.best_texts(sig, none, lead, 3, size=8)
    vec = {}
    for r in sig.collect():
        vec.setdefault(r.text, {})[r.token] = r.weight
    got = {}
    for r in best.collect():
        got.setdefault(r.s1, []).append((-r.cos, r.s2))
    for t, v in vec.items():
        cos = sorted((-round(sum(w * vec[u].get(x, 0) for x, w in v.items()), 12), u) for u in vec)[:3]
        assert [u for _, u in sorted(got[t])] == [u for _, u in cos]
    read = state.where("token = 'shared'").agg(F.sum("next"), F.max("next")).first()
    assert read[0] <= 600 * 4 and state.where("token = 'shared'").count() == 600  # of 75 blocks each


def test_a_text_with_nothing_but_the_common_token(spark):
    rows = [(0, None, 10.0, 4.5, 0.7, None)] + [(i, f"cat{i}", 10.0, 4.5, 0.7, "SP") for i in range(1, 40)]
    pf = spark.createDataFrame(rows, "product_id long, product_category_name_english string, avg_price double, "
                                     "avg_review_score double, positive_sentiment_ratio double, seller_state string")
    texts = {r.product_id: r.text for r in content.product_text(pf).collect()}
    got = sorted(tuple(r)[:3] for r in content.similar(pf, 4).collect())
    assert got == [w[:3] for w in brute(texts, 4)]
