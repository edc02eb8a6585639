"""Rows of the pipeline against plain Python on planted rejects, copies, near copies and benchmark passages."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
from mercato.llm import quality_fm as fm

from .test_decontaminate import brute as leaked
from .test_mixing import fill
from .util import docs, prose, shingles, words


def corpus():
    rng = random.Random(21)
    items = [(i, prose(rng, n, 5000)) for i, n in enumerate([6, 12, 30, 60])]
    rows, labels, junk = [], [], set()
    for i in range(240):
        body = prose(rng, rng.randint(60, 160), 3000).split()
        if i % 4 == 0:  # rejects
            junk.add(i)
            body = [w + rng.choice(["###", "$$$", "%%%"]) for w in body]
        elif i % 12 == 1:  # benchmark passages
            at = rng.randrange(len(body))
            body[at:at] = items[i % 4][1].split()
        rows.append((i, " ".join(body), "en", rng.choice(["a", "a", "b", "c", None])))
        if i % 5:
            labels.append((i, int(i not in junk)))
    clean = [r for r in rows if r[0] % 4 == 2]
    for k, r in enumerate(clean[:12]):  # exact copies but for case, of one text many
        rows += [(300 + 10 * k + c, r[1].upper() if c % 2 else r[1], "en", r[3]) for c in range(8 if k == 0 else 1)]
    for k, r in enumerate(clean[12:24]):  # one word of a long text changed
        w = r[1].split()
        w[len(w) // 2] = "changed"
        rows.append((500 + k, " ".join(w), "en", r[3]))
    return rows, labels, items, junk


def near(rows):
    """Smallest id of each class of texts linked at a shingle Jaccard of 0.8."""
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in sets}
    for _ in rows:
        old = dict(root)
        for a in sets:
            for b in sets:
                if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if old == root:
            return [r for r in rows if root[r[0]] == r[0]]


def mixed(rows):
    """(id, copies) of weighted fair queueing over three epochs."""
    size = {r[0]: len(words(r[1])) for r in rows}
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += size[r[0]]
    goal, queue = fill(total), []
    served = defaultdict(int)
    for key, r in sorted((hashlib.md5(str(r[0]).encode()).hexdigest(), r) for r in rows):
        served[r[3]] += size[r[0]]
        queue += [((served[r[3]] + e * total[r[3]]) / goal[r[3]], key, r[0]) for e in range(3)]
    out, left = Counter(), sum(total.values())
    for _, _, i in sorted(queue):
        left -= size[i]
        if left < 0:
            break
        out[i] += 1
    return out


def test_run_matches_plain_python(spark, tmp_path):
    rows, labels, items, junk = corpus()
    d = docs(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    for name, table in (("documents", d), ("labels", lab),
                        ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = {r.doc_id for r in fm.score(d, fm.train(d, lab)).collect() if r.score >= 0.5}
    assert not kept & junk and len(kept) == len(rows) - len(junk)
    want = [r for r in rows if r[0] in kept]
    last = {r[1].lower(): r for r in sorted(want)}
    want = [r for r in want if last[r[1].lower()] is r]
    assert len(want) == len(kept) - 19
    want = near(want)
    leaks = {i for i, *_ in leaked(want, items)}
    assert {i for i in range(240) if i % 12 == 1} <= leaks
    want = [r for r in want if r[0] not in leaks]
    assert Counter(r.doc_id for r in got) == mixed(want)
    texts = {r[0]: r[1] for r in rows}
    assert all(r.text == texts[r.doc_id] for r in got)


def test_run_on_empty_tables(spark, tmp_path):
    for name, schema in (("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
