"""Oracle SQL for the deterministic recommenders (R1-R4, R7-R9, R12, R20,
R21, R23, R26), written by brute force where the Spark plan prunes."""

from __future__ import annotations

import re

from oracles.base import npr

DBL = "CAST({} AS DOUBLE)".format

RECS = f"""
r_text AS (
  SELECT product_id, concat_ws(' ', coalesce(product_category_name_english, 'unknown'),
    CASE WHEN avg_price < 50 THEN 'price_very_low' WHEN avg_price < 150 THEN 'price_low'
         WHEN avg_price < 500 THEN 'price_medium' ELSE 'price_high' END,
    CASE WHEN avg_review_score IS NULL OR isnan(avg_review_score) THEN 'score_unknown'
         WHEN avg_review_score >= 4.0 THEN 'score_high' WHEN avg_review_score >= 3.0 THEN 'score_medium'
         ELSE 'score_low' END,
    CASE WHEN positive_sentiment_ratio IS NULL OR isnan(positive_sentiment_ratio) OR positive_sentiment_ratio = 0
         THEN 'sentiment_unknown' WHEN positive_sentiment_ratio >= 0.6 THEN 'sentiment_positive'
         WHEN positive_sentiment_ratio >= 0.3 THEN 'sentiment_neutral' ELSE 'sentiment_negative' END,
    coalesce(seller_state, 'unknown')) AS text
  FROM g_product_features
),
r_texts AS (SELECT text, count(*) AS k FROM r_text GROUP BY 1),
r_tf AS (
  SELECT text, token, count(*) AS tf, any_value(k) AS k FROM (
    SELECT text, k, unnest(regexp_extract_all(lower(text), '\\b\\w\\w+\\b')) AS token FROM r_texts) GROUP BY 1, 2
),
r_w0 AS (
  SELECT t.text, t.token, t.tf * (ln((1 + n.n) / (1 + d.df)) + 1) AS w
  FROM r_tf t JOIN (SELECT token, sum(k) AS df FROM r_tf GROUP BY 1) d ON t.token = d.token,
       (SELECT count(*) AS n FROM r_text) n
),
r_sig AS (SELECT text, token, w / sqrt(sum(w * w) OVER (PARTITION BY text)) AS weight FROM r_w0),
r_tfidf AS (SELECT p.product_id, s.token, {npr('s.weight', 12)} AS weight FROM r_text p JOIN r_sig s ON p.text = s.text),
r_cos AS (
  SELECT a.text AS s1, b.text AS s2, {npr('sum(a.weight * b.weight)', 12)} AS cos
  FROM r_sig a JOIN r_sig b ON a.token = b.token GROUP BY 1, 2
),
r_similar AS (
  SELECT product_id, rank, similar_product_id, {npr('cos', 4)} AS similarity FROM (
    SELECT p.product_id, q.product_id AS similar_product_id, c.cos,
      row_number() OVER (PARTITION BY p.product_id ORDER BY c.cos DESC, q.product_id) AS rank
    FROM r_text p JOIN r_cos c ON c.s1 = p.text JOIN r_text q ON q.text = c.s2 WHERE q.product_id <> p.product_id)
  WHERE rank <= 10
),
r_req AS (
  SELECT customer_unique_id, customer_state AS state, preferred_category AS category FROM g_customer_profile
),
r_cold AS (
  SELECT l.customer_unique_id, l.segment_type AS level, t.rank, t.product_id, t.product_category_name_english,
    t.avg_review_score, t.avg_price, t.total_orders
  FROM (SELECT r.customer_unique_id,
          CASE WHEN st.k IS NOT NULL THEN 'state' WHEN ct.k IS NOT NULL THEN 'category' ELSE 'global' END AS segment_type,
          CASE WHEN st.k IS NOT NULL THEN upper(r.state) WHEN ct.k IS NOT NULL THEN lower(r.category) ELSE 'all' END AS v
        FROM r_req r
        LEFT JOIN (SELECT DISTINCT upper(segment_value) AS k FROM g_top_products_by_segment WHERE segment_type = 'state') st
          ON upper(r.state) = st.k
        LEFT JOIN (SELECT DISTINCT lower(segment_value) AS k FROM g_top_products_by_segment WHERE segment_type = 'category') ct
          ON lower(r.category) = ct.k) l
  JOIN (SELECT *, CASE segment_type WHEN 'state' THEN upper(segment_value) WHEN 'category' THEN lower(segment_value)
                  ELSE segment_value END AS v FROM g_top_products_by_segment WHERE rank <= 10) t
    ON l.segment_type = t.segment_type AND l.v = t.v
),
r8_cand AS (
  SELECT customer_unique_id, lvl, product_id, max(total_orders) AS total_orders FROM (
    SELECT r.customer_unique_id, 1 AS lvl, p.product_id, p.total_orders FROM r_req r
      JOIN g_top_products_by_segment p ON r.state = p.segment_value
    UNION ALL
    SELECT r.customer_unique_id, 2, p.product_id, p.total_orders FROM r_req r
      JOIN g_top_products_by_segment p ON r.category = p.product_category_name_english)
  GROUP BY 1, 2, 3
),
r8_ranked AS (
  SELECT * FROM (
    SELECT c.customer_unique_id, CASE c.lvl WHEN 1 THEN 'state' ELSE 'category' END AS level,
      row_number() OVER (PARTITION BY c.customer_unique_id ORDER BY c.total_orders DESC NULLS LAST, c.product_id) AS rank,
      c.product_id
    FROM r8_cand c JOIN (SELECT customer_unique_id, min(lvl) AS lvl FROM r8_cand GROUP BY 1) m
      ON c.customer_unique_id = m.customer_unique_id AND c.lvl = m.lvl)
  WHERE rank <= 10
),
r8_global AS (
  SELECT * FROM (SELECT product_id, row_number() OVER (ORDER BY total_orders DESC NULLS LAST, product_id) AS rank
                 FROM (SELECT DISTINCT product_id, total_orders FROM g_top_products_by_segment)) WHERE rank <= 10
),
r_cold_serving AS (
  SELECT customer_unique_id, level, rank, product_id FROM r8_ranked
  UNION ALL
  SELECT r.customer_unique_id, 'global', g.rank, g.product_id
  FROM (SELECT DISTINCT customer_unique_id FROM r_req
        WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM r8_ranked)) r, r8_global g
),
r_also AS (
  SELECT product_id, rank, other_product_id, category, jaccard, bought_together FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY jaccard DESC, bought_together DESC, other_product_id) AS rank
    FROM (SELECT product_id_a AS product_id, product_id_b AS other_product_id, category_b AS category,
            cooccurrence_score AS jaccard, cooccurrence_count AS bought_together FROM g_product_cooccurrence
          UNION ALL
          SELECT product_id_b, product_id_a, category_a, cooccurrence_score, cooccurrence_count FROM g_product_cooccurrence))
  WHERE rank <= 10
),
r_codes AS (
  SELECT column_name, value, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT 'customer_state' AS column_name, coalesce(CAST(customer_state AS VARCHAR), 'unknown') AS value FROM d_customer_details
        UNION SELECT DISTINCT 'preferred_category', coalesce(CAST(preferred_category AS VARCHAR), 'unknown') FROM d_customer_details
        UNION SELECT DISTINCT 'preferred_payment_type', coalesce(CAST(preferred_payment_type AS VARCHAR), 'unknown') FROM d_customer_details
        UNION SELECT DISTINCT 'product_category_name_english', coalesce(CAST(product_category_name_english AS VARCHAR), 'unknown') FROM d_product_details
        UNION SELECT DISTINCT 'seller_state', coalesce(CAST(seller_state AS VARCHAR), 'unknown') FROM d_product_details)
),
r_routing AS (
  SELECT r.customer_unique_id,
    CASE WHEN h.customer_unique_id IS NOT NULL AND p.customer_unique_id IS NOT NULL THEN 'hybrid'
         WHEN h.customer_unique_id IS NOT NULL THEN 'cf' ELSE 'cold_start' END AS strategy
  FROM (SELECT DISTINCT customer_unique_id FROM m_customers) r
  LEFT JOIN (SELECT DISTINCT customer_unique_id FROM g_interactions) h ON r.customer_unique_id = h.customer_unique_id
  LEFT JOIN (SELECT DISTINCT customer_unique_id FROM g_customer_profile) p ON r.customer_unique_id = p.customer_unique_id
),
r_hist AS (
  SELECT customer_unique_id, product_id,
    row_number() OVER (PARTITION BY customer_unique_id ORDER BY implicit_score DESC, product_id) AS pos,
    count(*) OVER (PARTITION BY customer_unique_id) AS n
  FROM g_interactions
),
r_content_precision AS (
  SELECT q.customer_unique_id,
    count(rel.product_id) FILTER (WHERE rec.similar_product_id IS NOT NULL) / {DBL('10.0')} AS precision
  FROM (SELECT customer_unique_id, product_id FROM r_hist WHERE n >= 2 AND pos = 1) q
  JOIN (SELECT DISTINCT product_id FROM r_similar) hasrec ON q.product_id = hasrec.product_id
  JOIN (SELECT customer_unique_id, product_id FROM r_hist WHERE n >= 2 AND pos > 1) rel
    ON q.customer_unique_id = rel.customer_unique_id
  LEFT JOIN r_similar rec ON rec.product_id = q.product_id AND rec.similar_product_id = rel.product_id AND rec.rank <= 10
  GROUP BY 1
),
r_cross AS (
  SELECT customer_unique_id, rank, product_id, product_category_name_english FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY crank, srank, product_id) AS rank FROM (
      SELECT * FROM (
        SELECT c.customer_unique_id, s.product_id, c.crank, s.srank, c.product_category_name_english,
          row_number() OVER (PARTITION BY c.customer_unique_id, s.product_id
                             ORDER BY c.crank, s.srank, c.product_category_name_english) AS best
        FROM (SELECT * FROM (SELECT customer_unique_id, product_category_name_english,
                row_number() OVER (PARTITION BY customer_unique_id ORDER BY affinity_score DESC, product_category_name_english) AS crank
              FROM g_category_affinity) WHERE crank <= 3) c
        JOIN (SELECT segment_value AS product_category_name_english, rank AS srank, product_id
              FROM g_top_products_by_segment WHERE segment_type = 'category') s
          ON c.product_category_name_english = s.product_category_name_english
        WHERE NOT EXISTS (SELECT 1 FROM g_interactions i WHERE i.customer_unique_id = c.customer_unique_id
                          AND i.product_id = s.product_id))
      WHERE best = 1))
  WHERE rank <= 10
)"""

# the similarity chain over features with several words a category (see words_features)
_WORDS = re.sub(r"\br_", "rw_", RECS[RECS.index("r_text AS"):RECS.index("r_req AS")].rstrip().rstrip(","))
_WORDS = _WORDS.replace("g_product_features", "rw_features")
RECS += f""",
rw_features AS (
  SELECT * REPLACE (
    CASE WHEN CAST(product_id AS VARCHAR) LIKE '%7' THEN NULL
         ELSE replace(product_category_name_english, '_', ' ') || ' unknown line of unknown make' END
      AS product_category_name_english,
    CASE WHEN CAST(product_id AS VARCHAR) LIKE '%7' OR CAST(product_id AS VARCHAR) LIKE '%3' THEN NULL
         ELSE seller_state END AS seller_state)
  FROM g_product_features
),
{_WORDS}"""

# the cold-start chain over requests with gaps (see _mixed_requests)
_GAPS = re.sub(r"\br(8?)_", r"rq\1_", RECS[RECS.index("r_cold AS"):RECS.index("r_also AS")].rstrip().rstrip(","))
_LAST = "right(CAST(customer_unique_id AS VARCHAR), 1)"
RECS += f""",
rq_req AS (
  SELECT customer_unique_id,
    CASE WHEN {_LAST} IN ('0', '1', '3') THEN NULL WHEN {_LAST} = '2' THEN 'ZZ' ELSE customer_state END AS state,
    CASE WHEN {_LAST} = '1' THEN NULL WHEN {_LAST} = '3' THEN 'nope' ELSE preferred_category END AS category
  FROM g_customer_profile
),
{_GAPS}"""

# the ranker's sample, negatives, training set and split: the same seeded order, written set-wise
_CODED = {"customer_state": "d_customer_details", "preferred_category": "d_customer_details",
          "preferred_payment_type": "d_customer_details", "product_category_name_english": "d_product_details",
          "seller_state": "d_product_details"}


def _code(alias: str, col: str) -> str:
    return (f"(SELECT code FROM r_codes k WHERE k.column_name = '{col}' "
            f"AND k.value = coalesce(CAST({alias}.{col} AS VARCHAR), 'unknown'))")


def _features() -> str:
    cust = {"customer_state": "customer_state", "cliente_total_orders": "total_orders", "total_spent": "total_spent",
            "cliente_avg_review_score": "avg_review_score", "preferred_category": "preferred_category",
            "preferred_payment_type": "preferred_payment_type", "avg_installments": "avg_installments",
            "avg_delivery_distance": "avg_delivery_distance"}
    prod = {"product_category_name_english": "product_category_name_english", "avg_price": "avg_price",
            "produto_avg_review_score": "avg_review_score", "produto_total_orders": "total_orders",
            "positive_sentiment_ratio": "positive_sentiment_ratio", "seller_state": "seller_state",
            "repeat_product": "repeat_product", "total_sellers": "total_sellers"}
    out = []
    for alias, cols in (("c", cust), ("p", prod)):
        for name, col in cols.items():
            value = f"CASE WHEN {alias}.id IS NOT NULL THEN {_code(alias, col)} END" if col in _CODED else f"{alias}.{col}"
            out.append(f"coalesce(CAST({value} AS DOUBLE), CAST(0 AS DOUBLE)) AS {name}")
    return ",\n    ".join(out)


def _shuffle(rounds: int = 24, prime: int = 2_147_483_647) -> str:
    """Every step of every user's walk over the whole catalogue: the swap-or-not shuffle, one level of SELECT a round."""
    part = lambda r, first, digits: (
        f"CAST('0x' || substr(md5('42:' || CAST(customer_unique_id AS VARCHAR) || ':{r}'), {first}, {digits}) AS BIGINT)")
    keys = ", ".join(f"{part(r, 1, 12)} % n AS k{r}, 1 + {part(r, 13, 7)} % {prime - 1} AS a{r}, {part(r, 20, 7)} AS b{r}"
                     for r in range(rounds))
    walk = "SELECT u.*, j, j AS x FROM rt_keys u, range(0, (SELECT count(*) FROM rt_cat)) g(j)"
    for r in range(rounds):
        other = f"((k{r} - x) % n + n) % n"
        line = f"((a{r} * greatest(x, {other}) + b{r}) % {prime})"
        walk = f"SELECT * REPLACE (CASE WHEN ({line} * {line}) % {prime} % 2 = 1 THEN {other} ELSE x END AS x) FROM ({walk})"
    return f"""rt_keys AS (
  SELECT customer_unique_id, k, n, {keys}
  FROM (SELECT customer_unique_id, count(*) AS k FROM rt_pos GROUP BY 1), (SELECT count(*) AS n FROM rt_cat)
),
rt_walk AS ({walk})"""


RECS += f""",
rt_users AS (
  SELECT customer_unique_id FROM (SELECT customer_unique_id FROM g_customer_profile
                                  INTERSECT SELECT customer_unique_id FROM g_interactions)
  ORDER BY md5('42:' || CAST(customer_unique_id AS VARCHAR)), customer_unique_id LIMIT 5000
),
rt_pos AS (SELECT DISTINCT customer_unique_id, product_id FROM g_interactions SEMI JOIN rt_users USING (customer_unique_id)),
rt_cat AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS i FROM (SELECT DISTINCT product_id FROM g_interactions)),
{_shuffle()},
rt_neg AS (
  SELECT customer_unique_id, product_id FROM (
    SELECT w.customer_unique_id, c.product_id, w.k, row_number() OVER (PARTITION BY w.customer_unique_id ORDER BY w.j) AS pos
    FROM rt_walk w JOIN rt_cat c ON c.i = w.x
    WHERE NOT EXISTS (SELECT 1 FROM rt_pos b WHERE b.customer_unique_id = w.customer_unique_id AND b.product_id = c.product_id))
  WHERE pos <= k
),
rt_set AS (
  SELECT r.customer_unique_id, r.product_id, CAST(r.label AS DOUBLE) AS label,
    {_features()}
  FROM (SELECT *, 1 AS label FROM rt_pos UNION ALL SELECT *, 0 FROM rt_neg) r
  LEFT JOIN (SELECT customer_unique_id AS id, * FROM d_customer_details) c ON r.customer_unique_id = c.id
  LEFT JOIN (SELECT product_id AS id, * FROM d_product_details) p ON r.product_id = p.id
),
rt_split AS (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY
      md5('42:' || CAST(customer_unique_id AS VARCHAR) || ':' || CAST(product_id AS VARCHAR)), customer_unique_id, product_id)
    <= ceil(count(*) OVER (PARTITION BY label) * CAST(0.2 AS DOUBLE)) AS is_test
  FROM rt_set
)"""

# R27 by brute force: every product against every other, in the same fixed point
_NUMERIC = ["avg_price", "avg_freight_value", "total_orders", "avg_review_score", "total_reviews", "positive_sentiment_ratio"]


def _vectors(out: str, features: str) -> str:
    z = [f"CAST(coalesce(floor((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), CAST(0 AS DOUBLE)) "
         f"* 10000 + CAST(0.5 AS DOUBLE)), 0) AS BIGINT) AS z{k}" for k, c in enumerate(_NUMERIC)]
    dot = " + ".join(f"a.z{k} * b.z{k}" for k in range(len(_NUMERIC)))
    length = " + ".join(f"z{k} * z{k}" for k in range(len(_NUMERIC)))
    return f"""
{out}_vec AS (SELECT *, sqrt(CAST({length} + 100000000 AS DOUBLE)) AS size FROM (
  SELECT product_id, coalesce(product_category_name_english, 'unknown') AS cat, {", ".join(z)} FROM {features})),
{out}_similar AS (
  SELECT product_id, rank, similar_product_id, {npr("cos", 4)} AS similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY cos DESC, similar_product_id) AS rank FROM (
      SELECT a.product_id, b.product_id AS similar_product_id,
        CAST({dot} + CASE WHEN a.cat = b.cat THEN 100000000 ELSE 0 END AS DOUBLE) / (a.size * b.size) AS cos
      FROM {out}_vec a JOIN {out}_vec b ON a.product_id <> b.product_id))
  WHERE rank <= 10)"""


_PID = "CAST(product_id AS VARCHAR)"
RECS += f""",{_vectors("rv", "g_product_features")},
rvr_features AS (
  SELECT * REPLACE (CASE WHEN {_PID} LIKE '%7' THEN NULL ELSE floor(avg_price / 100) * CAST(100 AS DOUBLE) END AS avg_price,
    CAST(10 AS DOUBLE) AS avg_freight_value, total_orders % 3 AS total_orders,
    CASE WHEN {_PID} LIKE '%3' THEN total_reviews END AS total_reviews,
    CASE WHEN {_PID} NOT LIKE '%7' THEN product_category_name_english END AS product_category_name_english)
  FROM g_product_features
),{_vectors("rvr", "rvr_features")}"""

R = {
    "r27_similar_vectors": "SELECT * FROM rv_similar",
    "r27_similar_vectors_rough": "SELECT * FROM rvr_similar",
    "r1_product_text": "SELECT * FROM r_text",
    "r2_tfidf": "SELECT * FROM r_tfidf",
    "r3_similar_products": "SELECT * FROM r_similar",
    "r3_similar_words": "SELECT * FROM rw_similar",
    "r4_density": f"""SELECT users, items, interactions, CAST(interactions AS DOUBLE) * {DBL('100.0')} / (users * items) AS density_pct
        FROM (SELECT count(DISTINCT customer_unique_id) AS users, count(DISTINCT product_id) AS items, count(*) AS interactions
              FROM g_interactions)""",
    "r4_item_index": """SELECT product_id, CAST(row_number() OVER (ORDER BY product_id) - 1 AS INTEGER) AS item_idx
        FROM (SELECT DISTINCT product_id FROM g_interactions WHERE product_id IS NOT NULL)""",
    "r7_cold_start": "SELECT * FROM r_cold",
    "r8_cold_start_serving": "SELECT * FROM r_cold_serving",
    "r7_cold_start_mixed": "SELECT * FROM rq_cold",
    "r8_cold_start_serving_mixed": "SELECT * FROM rq_cold_serving",
    "r20_routing_mixed": """SELECT r.customer_unique_id,
        CASE WHEN h.id IS NOT NULL AND p.id IS NOT NULL THEN 'hybrid' WHEN h.id IS NOT NULL THEN 'cf'
             ELSE 'cold_start' END AS strategy
      FROM (SELECT DISTINCT CAST(customer_unique_id AS VARCHAR) AS customer_unique_id FROM m_customers
            UNION ALL SELECT DISTINCT 'new-' || CAST(customer_unique_id AS VARCHAR) FROM m_customers) r
      LEFT JOIN (SELECT DISTINCT CAST(customer_unique_id AS VARCHAR) AS id FROM g_interactions) h ON r.customer_unique_id = h.id
      LEFT JOIN (SELECT DISTINCT CAST(customer_unique_id AS VARCHAR) AS id FROM g_customer_profile
                 WHERE CAST(customer_unique_id AS VARCHAR) NOT LIKE '%4') p ON r.customer_unique_id = p.id""",
    "r9_also_bought": "SELECT * FROM r_also",
    "r6_cf_invariants": """SELECT count(*) AS users, CAST(sum(least(10, p - h)) AS BIGINT) AS rows,
        CAST(0 AS BIGINT) AS broken, CAST(0 AS BIGINT) AS bought
      FROM (SELECT customer_unique_id, count(DISTINCT product_id) AS h FROM g_interactions GROUP BY 1),
           (SELECT count(DISTINCT product_id) AS p FROM g_interactions) WHERE p > h""",
    "r16_ranker_invariants": """SELECT CAST(CAST(label AS INTEGER) AS VARCHAR) AS class, count(*) AS support, true AS valid
      FROM rt_split WHERE is_test GROUP BY 1""",
    "r17_importance_invariants": "SELECT column_name AS feature, true AS valid, CAST(1 AS DOUBLE) AS total FROM (VALUES "
        + ", ".join(f"('{c}')" for c in (
            "customer_state", "cliente_total_orders", "total_spent", "cliente_avg_review_score", "preferred_category",
            "preferred_payment_type", "avg_installments", "avg_delivery_distance", "product_category_name_english",
            "avg_price", "produto_avg_review_score", "produto_total_orders", "positive_sentiment_ratio", "seller_state",
            "repeat_product", "total_sellers")) + ") v(column_name)",
    "r18_hybrid_invariants": """SELECT 'hybrid' AS strategy, count(*) AS users, CAST(sum(least(10, p - h)) AS BIGINT) AS rows,
        CAST(0 AS BIGINT) AS broken
      FROM (SELECT customer_unique_id, count(DISTINCT product_id) AS h FROM g_interactions GROUP BY 1),
           (SELECT count(DISTINCT product_id) AS p FROM g_interactions) WHERE p > h""",
    "r19_serving_invariants": """SELECT count(*) AS users, CAST(sum(least(10, p - h)) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS broken
      FROM (SELECT customer_unique_id, count(DISTINCT product_id) AS h FROM g_interactions GROUP BY 1),
           (SELECT count(DISTINCT product_id) AS p FROM g_interactions) WHERE p > h""",
    "r19_serving_mixed_invariants": """SELECT 'xgboost_hybrid' AS strategy, count(*) AS users,
        CAST(sum(least(10, p - h)) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS broken
      FROM (SELECT customer_unique_id, count(DISTINCT product_id) AS h FROM g_interactions SEMI JOIN g_customer_profile
              USING (customer_unique_id) GROUP BY 1),
           (SELECT count(DISTINCT product_id) AS p FROM g_interactions) WHERE p > h
      UNION ALL SELECT 'cold_start', count(DISTINCT customer_unique_id), count(*), CAST(0 AS BIGINT) FROM rq_cold_serving""",
    "r20_recommendation_invariants": """SELECT strategy, count(*) AS users, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS broken
      FROM (SELECT r.strategy, r.customer_unique_id, CASE WHEN strategy = 'cold_start' THEN c.n ELSE least(10, p - h) END AS n
            FROM r_routing r
            LEFT JOIN (SELECT customer_unique_id, count(DISTINCT product_id) AS h FROM g_interactions GROUP BY 1) i
              ON r.customer_unique_id = i.customer_unique_id
            LEFT JOIN (SELECT customer_unique_id, count(*) AS n FROM r_cold GROUP BY 1) c
              ON r.customer_unique_id = c.customer_unique_id,
            (SELECT count(DISTINCT product_id) AS p FROM g_interactions)) WHERE n > 0 GROUP BY 1""",
    "r22_evaluation_invariants": """SELECT 'content_tfidf' AS method, count(*) AS users_evaluated, true AS valid FROM r_content_precision
      UNION ALL SELECT 'collaborative_filtering_als', count(*), true FROM
        (SELECT customer_unique_id FROM g_interactions GROUP BY 1 HAVING count(*) >= 2)""",
    "r16_popularity_auc": """SELECT CAST(sum(CASE WHEN label = 1 THEN 2 * below + ties ELSE 0 END) AS DOUBLE)
          / (2 * (CAST(any_value(positives) AS DOUBLE) * any_value(negatives))) AS roc_auc,
        any_value(positives) AS positives, any_value(negatives) AS negatives
      FROM (SELECT label, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) OVER (ORDER BY produto_total_orders
                            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ties AS below, ties, positives, negatives
            FROM (SELECT *, count(*) FILTER (WHERE label = 0) OVER (PARTITION BY produto_total_orders) AS ties,
                    count(*) FILTER (WHERE label = 1) OVER () AS positives, count(*) FILTER (WHERE label = 0) OVER () AS negatives
                  FROM rt_set))""",
    "r19_serving_repeated_invariants": """SELECT 2 * count(*) AS requests, CAST(2 * sum(least(10, p - h)) AS BIGINT) AS rows,
        CAST(0 AS BIGINT) AS broken, true AS differ
      FROM (SELECT customer_unique_id, count(DISTINCT product_id) AS h FROM g_interactions SEMI JOIN g_customer_profile
              USING (customer_unique_id) GROUP BY 1),
           (SELECT count(DISTINCT product_id) AS p FROM g_interactions) WHERE p > h""",
    "r10_user_sample": "SELECT * FROM rt_users",
    "r11_negatives": "SELECT * FROM rt_neg",
    "r13_training_set": "SELECT * FROM rt_set",
    "r14_split_counts": "SELECT label, is_test, count(*) AS rows FROM rt_split GROUP BY 1, 2",
    "r12_label_codes": "SELECT * FROM r_codes",
    "r20_routing": "SELECT * FROM r_routing",
    "r21_content_precision": "SELECT * FROM r_content_precision",
    "r23_content_evaluation": f"""SELECT 'content_tfidf' AS method, {npr('avg(precision)', 6)} AS precision_at_k,
        count(*) AS users_evaluated FROM r_content_precision""",
    "r26_cross_category": "SELECT * FROM r_cross",
}

R["r20_recommendations_mixed_invariants"] = f"""SELECT strategy, count(*) AS users, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS broken
  FROM (SELECT r.strategy, CASE WHEN r.strategy = 'cold_start' THEN c.n ELSE least(10, p - h) END AS n
        FROM ({R["r20_routing_mixed"]}) r
        LEFT JOIN (SELECT CAST(customer_unique_id AS VARCHAR) AS id, count(DISTINCT product_id) AS h FROM g_interactions GROUP BY 1) i
          ON i.id = r.customer_unique_id
        LEFT JOIN (SELECT CAST(customer_unique_id AS VARCHAR) AS id, count(*) AS n FROM r_cold GROUP BY 1) c
          ON c.id = replace(r.customer_unique_id, 'new-', ''),
        (SELECT count(DISTINCT product_id) AS p FROM g_interactions)) WHERE n > 0 GROUP BY 1"""
