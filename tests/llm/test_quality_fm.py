import random

import numpy as np

from mercato.llm import quality_fm as fm
from mercato.llm.common import text_bytes

from .util import crc, docs, edge_rows, prose


def corpus():
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.6
        text = prose(rng, rng.randint(20, 200))
        if not good:
            text = " ".join(w + rng.choice(["###", "$$$", "", "%%%"]) for w in text.split())
        rows.append((i, text))
        if i % 5:
            labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    d = docs(spark, rows + edge_rows()[:6])
    lab = spark.createDataFrame(labels + [(3, None), (None, 1), (5, 1), (5, 1)], "doc_id long, quality int")
    model = fm.train(d, lab)
    score = {r.doc_id: r.score for r in fm.score(d, model).collect() if r.doc_id is not None}
    held = [(score[i] >= 0.5) == bool(y) for i, y in labels if crc(i, 3) == 1 and i > 6]
    assert np.mean(held) > 0.95
    assert all(0 <= s <= 1 for s in score.values())


def test_pair_term_matches_all_pairs():
    rng = np.random.default_rng(0)
    m = fm.Model(np.zeros(fm.N_STATS), np.ones(fm.N_STATS), 0.3, rng.normal(size=fm.N_COLS),
                 rng.normal(0, 0.3, (fm.N_COLS, fm.FACTORS)))
    data, off = text_bytes(__import__("pyarrow").array(["a few words a few", "other ones here"]))
    r, c, x, stats, bucket = fm.features(data, off)
    stats = np.clip(stats, -1, 1)
    got = m.score(r, c, x, stats, bucket)
    for t in range(2):
        full = np.zeros(fm.N_COLS)
        full[c[r == t]] = x[r == t]
        full[fm.WORD_COLS:fm.WORD_COLS + fm.N_STATS] = stats[t]
        full[fm.WORD_COLS + fm.N_STATS + bucket[t]] = 1
        on = np.flatnonzero(full)
        y = m.w0 + full @ m.w + sum(full[i] * full[j] * (m.v[i] @ m.v[j]) for a, i in enumerate(on) for j in on[a + 1:])
        assert np.isclose(got[t], 1 / (1 + np.exp(-y)))


def test_gradient_lowers_the_loss_and_single_class(spark):
    rows, labels = corpus()
    one = spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, quality int")
    d = docs(spark, rows)
    assert all(r.score > 0.9 for r in fm.score(d, fm.train(d, one)).collect())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.score == 0.5 for r in fm.score(d, fm.train(d, none)).collect())


def test_keep_filters_rows(spark):
    rows, labels = corpus()
    d = docs(spark, rows + edge_rows())
    model = fm.train(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    out = fm.keep(d, model)
    assert out.schema == d.schema
    want = sorted((r.doc_id for r in fm.score(d, model).collect() if r.score >= 0.5), key=repr)
    assert sorted((r.doc_id for r in out.collect()), key=repr) == want
    assert fm.keep(docs(spark, []), model).count() == 0


def test_an_id_is_learned_from_once(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    hot = next(rows[i] for i, _ in labels if crc(i, 3) != 1)
    model, again = (fm.train(docs(spark, r), lab) for r in (rows, rows + [hot] * 200))
    assert np.array_equal(model.w, again.w) and np.array_equal(model.v, again.v)
