import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from mercato.llm import exact_dedup

from .util import docs, edge_rows


def brute(rows):
    groups = defaultdict(list)
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    for r in rows:
        groups[norm(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = groups[norm(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_match_brute_force(spark):
    rows = edge_rows()
    got = sorted((tuple(r) for r in exact_dedup.groups(docs(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_hash_collisions_are_chained(spark):
    rows = edge_rows()
    weak = lambda c: (F.length(c) % 3).cast("long")  # noqa: E731  nearly everything collides
    d = docs(spark, rows)
    got = sorted((tuple(r) for r in exact_dedup.groups(d, key=weak).collect()), key=repr)
    assert got == brute(rows)
    index = exact_dedup.build_index(d, key=weak).entries
    assert index.agg(F.max("chain")).first()[0] > 1


def test_directory_doubles_where_buckets_are_full(spark):
    rows = [(i, f"text {i}") for i in range(600)]
    index = exact_dedup.build_index(docs(spark, rows), capacity=50, max_depth=10).entries
    sizes = [r["count"] for r in index.groupBy("bucket").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 50 and len(sizes) > 600 / 50
    # each leaf is a prefix of its own: no cell belongs to two buckets
    assert index.groupBy("bucket").agg(F.countDistinct("depth").alias("d")).filter("d > 1").count() == 0


def test_result_goes_through_the_directory(spark):
    d = docs(spark, [(i, f"text {i % 500}") for i in range(600)])
    index = exact_dedup.build_index(d, capacity=50)
    assert index.lookup().count() == 600
    assert index.entries.filter(F.expr("bucket <> shiftright(shiftrightunsigned(key, 1), 63 - depth) + shiftleft(1L, depth)")).count() == 0
    lost = index.leaves.orderBy("cell").first()["bucket"]
    index.leaves = index.leaves.filter(F.col("bucket") != lost)
    inside = index.entries.filter(F.col("bucket") == lost).agg(F.sum("group_size")).first()[0]
    assert index.lookup().count() == 600 - inside


def test_capacity_grows_beyond_the_deepest_directory(spark):
    rows = [(i, f"text {i}") for i in range(600)]
    index = exact_dedup.build_index(docs(spark, rows), capacity=1, max_depth=5)
    assert index.leaves.count() <= 32
    assert index.lookup().filter("doc_id = keep_id and group_size = 1").count() == 600


def test_deduplicate_keeps_rows_and_columns(spark):
    rows = edge_rows()
    d = docs(spark, rows)
    out = exact_dedup.deduplicate(d)
    assert out.schema == d.schema
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    lower = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    best = {}
    for r in rows:
        old = best.get(lower(r[1]))
        if old is None or old[0] is None or (r[0] is not None and r[0] > old[0]):
            best[lower(r[1])] = (r[0], r[1])
    assert got == sorted(best.values(), key=repr)


def test_empty_table_and_no_python(spark, capsys):
    d = docs(spark, [])
    assert exact_dedup.groups(d).count() == 0
    assert exact_dedup.deduplicate(d).count() == 0
    exact_dedup.groups(docs(spark, edge_rows())).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
