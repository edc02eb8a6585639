import random

from mercato.llm import decontaminate as dc

from .util import ALNUM, docs, edge_rows, prose, shingles, words


def make():
    rng = random.Random(6)
    items = [(i, prose(rng, rng.choice([5, 6, 9, 14, 25, 40, 60, 200]), 5000)) for i in range(30)]
    items += [(90, None), (91, ""), (92, "only three words"), (None, prose(rng, 20, 5000)), (93, items[4][1]), (94, "Zebra quokka"),
              (95, "lemur"), (96, "one two three four"), (97, "quokka zebra")]
    rows = edge_rows() + [(50, "only Three words"), (51, "three words"), (52, prose(rng, 300) + " zebra, QUOKKA " + prose(rng, 200)),
                          (53, "a lemur"), (54, "lemurs"), (55, "one two three, four five"), (56, "zebra"), (57, "zebra quokka zebra")]
    for k in range(60):
        body = prose(rng, rng.choice([10, 100, 1500])).split()
        t = items[rng.randrange(30)][1].split()
        if k % 4 == 1:  # damaged passage
            t[rng.randrange(len(t))] = "damaged"
        if k % 4 == 2:  # half a passage
            t = t[:len(t) // 2]
        if k % 4 != 3:
            at = rng.randrange(len(body))
            body[at:at] = t
        rows.append((100 + k, " ".join(body).upper() if k % 5 == 0 else " ".join(body)))
    return rows, items


def brute(rows, items):
    out = []
    for i, t in items:
        q = shingles(t)
        size = len(next(iter(q))) if q else 0
        for r in rows if q else []:
            w = words(r[1], ALNUM)
            n = len(q & {tuple(w[k:k + size]) for k in range(len(w) - size + 1)})
            out += [(r[0], i, len(q), n)] if n / len(q) >= 0.8 else []
    return sorted(out, key=repr)


def test_leaks_match_brute_force(spark):
    rows, items = make()
    got = dc.leaks(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got), key=repr) == brute(rows, items)


def test_clean_keeps_the_rest(spark):
    rows, items = make()
    d = docs(spark, rows)
    out = dc.clean(d, spark.createDataFrame(items, "item_id long, text string"))
    assert out.schema == d.schema
    bad = {b[0] for b in brute(rows, items)}
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted((r[0] for r in rows if r[0] not in bad), key=repr)


def test_empty_sides(spark):
    rows, items = make()
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.leaks(docs(spark, rows[:5]), none).count() == 0
    assert dc.leaks(docs(spark, []), spark.createDataFrame(items[:3], "item_id long, text string")).count() == 0
    assert dc.clean(docs(spark, rows[:5]), none).count() == 5


def test_sql_twin_finds_short_items(spark):
    import duckdb

    from mercato.llm.sql import ORACLE

    rows, items = make()
    rows, items = [(i, r[1]) for i, r in enumerate(rows)], [(i, t[1]) for i, t in enumerate(items)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    got = con.execute(f"SELECT doc_id, item_id, n_item, n_shared FROM ({ORACLE['op8_decontaminate']})").fetchall()
    assert sorted(got) == brute(rows, items)
    assert any(n == 1 and len((rows[d][1] or "").split()) > 400 for d, i, n, _ in got if i in (34, 35))
