"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

_SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

#: Sizes, water-filled targets, finish times and the cut of the global order.
MIX = f"""
WITH d AS (SELECT doc_id, source, CAST({_SIZE} AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM {{docs}}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             CAST(source_size * 3 AS DOUBLE) AS cap FROM r),
o AS (SELECT *, row_number() OVER z AS k,
             coalesce(sum(cap) OVER (z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS cap_before,
             coalesce(sum(weight) OVER (z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS w_before,
             CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS w_all
      FROM w WINDOW z AS (ORDER BY cap / weight, rank)),
l AS (SELECT *, (total - cap_before) / (w_all - w_before) AS own FROM o),
lev AS (SELECT arg_min(own, k) AS level FROM l WHERE own <= cap / weight),
t AS (SELECT source, source_size, rank, least(cap, coalesce(level * weight, cap)) AS target FROM l, lev),
c AS (SELECT d.*, source_size, target, rank,
             sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT c.*, epoch, CAST(served + (epoch - 1) * source_size AS DOUBLE) / target AS finish
      FROM c, (VALUES (1), (2), (3)) v(epoch) WHERE size > 0 AND target > 0),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, key, doc_id, size, epoch
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM e),
n AS (SELECT rank, served, count(*) AS copies FROM g WHERE upto <= (SELECT sum(size) FROM d) GROUP BY rank, served)
"""

#: Five-word shingles (alphanumeric words, A-Z lowered); fewer words make one shingle.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = f"""(SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS g
  FROM (SELECT {{id}} AS id, regexp_extract_all({_LOWER}, '[a-z0-9\\x{{{{80}}}}-\\x{{{{10FFFF}}}}]+') AS w FROM {{table}}))"""

#: Runs of one to four words of documents, of those word counts that items have.
_SHORT_RUNS = f"""(SELECT id, unnest([array_to_string(w[k:k + size - 1], ' ') for k in range(1, len(w) - size + 2)]) AS g
  FROM (SELECT doc_id AS id, regexp_extract_all({_LOWER}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
       (SELECT DISTINCT len(string_split(g, ' ')) AS size FROM i WHERE len(string_split(g, ' ')) < 5))"""

#: Runs of letters, digits and non-ASCII characters in lowered text.
_TERM = r"[a-z0-9\x{80}-\x{10FFFF}]+"

ORACLE: dict[str, str] = {
    "op4_jaccard_join": f"""
WITH RECURSIVE s AS {_SHINGLES.format(id="doc_id", table="documents")},
n AS (SELECT id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2)
      JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE 10 * k >= 8 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY 1)
SELECT c.doc_id, class_id, coalesce(k.n, 0) AS n_links, class_size, c.doc_id = class_id AS kept
FROM c LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) k ON k.a = c.doc_id""",
    "op8_decontaminate": f"""
WITH d5 AS {_SHINGLES.format(id="doc_id", table="documents")}, i AS {_SHINGLES.format(id="item_id", table="benchmark")},
d AS (SELECT id, g FROM d5 WHERE len(string_split(g, ' ')) = 5 UNION {_SHORT_RUNS}),
n AS (SELECT id, count(*) AS n_item FROM i GROUP BY 1)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM d JOIN i ON d.g = i.g GROUP BY 1, 2)
JOIN n ON n.id = item_id WHERE n_shared / n_item >= CAST(0.8 AS DOUBLE)""",
    "op12_ranked_search": f"""
WITH t AS (SELECT id, row, term, count(*) AS tf FROM (
         SELECT doc_id AS id, row_number() OVER () AS row, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents)
       GROUP BY ALL),
i AS (SELECT id, row, term, count(*) AS repeats FROM (
         SELECT item_id AS id, row_number() OVER () AS row, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark)
       GROUP BY ALL),
l AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY row),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM l),
m AS (SELECT row, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM l, c),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
s AS (SELECT i.row AS item, i.id AS item_id, t.row, t.id AS doc_id,
             CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM i JOIN t USING (term) JOIN w USING (term) JOIN m ON m.row = t.row GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, row) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10""",
    "op2_mixing": MIX.format(docs="documents") + """
SELECT doc_id, source, size, source_size, target,
       CAST(coalesce(CASE WHEN size > 0 THEN copies END, 0) AS BIGINT) AS copies,
       CAST(coalesce(CASE WHEN size > 0 THEN copies END, 0) * size AS BIGINT) AS taken
FROM c LEFT JOIN n USING (rank, served)""",
    "op9_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d""",
}
