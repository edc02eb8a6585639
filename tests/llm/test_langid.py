import random

import numpy as np

from mercato.llm import langid

from .util import crc, docs, edge_rows

SYLLABLES = {"aa": ["ka", "lo", "mi", "tun"], "bb": ["sch", "eit", "ung", "er"], "cc": ["eau", "oi", "ché", "ment"]}


def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(300):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
                                 for _ in range(rng.randint(8, 200))), lang))
    return rows


def test_held_out_accuracy_and_und(spark):
    rows = corpus()
    extra = [(1000, None, "aa"), (1001, "123 ...", "aa"), (1002, "", None), (1003, rows[0][1], None)]
    d = docs(spark, rows + extra)
    got = {r.doc_id: r for r in langid.predict(d, langid.train(d)).collect()}
    held = [got[i].lang_pred == lang for i, _, lang in rows if crc(i, 5) == 0]
    assert np.mean(held) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == rows[0][2]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    net = langid.fit(windows, np.array([0, 1, 0, 1, 1]), ["x", "y"], epochs=1)
    h = []
    for w, b, width in zip(net.conv, net.bias, langid.WIDTHS, strict=True):
        e = net.embed[windows]
        cols = np.concatenate([e[:, k:langid.WINDOW - width + 1 + k] for k in range(width)], 2)
        h.append(np.maximum((cols @ w).max(1) + b, 0))
    z = np.concatenate(h, 1) @ net.out + net.out_bias
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(net.probabilities(windows), p, atol=1e-4)


def test_windows_cover_the_whole_text():
    data = np.frombuffer(b"ab" * 1000, np.uint8)
    windows, text, n = langid.cut_windows(data, np.array([0, 0, 700, 2000]))
    assert n.sum() == 2000 and list(np.bincount(text, weights=n, minlength=3)) == [0, 700, 1300]
    assert windows[text == 1].tobytes().rstrip(b"\0") == b"ab" * 350


def test_edges(spark):
    rows = edge_rows()
    d = docs(spark, rows)
    assert langid.predict(d, langid.train(d)).count() == len(rows)
    unlabelled = docs(spark, [(1, "some text", None)])
    assert langid.train(unlabelled) is None
    assert [tuple(r) for r in langid.predict(unlabelled, None).collect()] == [(1, "und", 0.0)]
    empty = docs(spark, [])
    assert langid.predict(empty, langid.train(empty)).count() == 0


def test_an_id_is_learned_from_once(spark):
    rows = corpus()
    net = langid.train(docs(spark, rows))
    hot = next(r for r in rows if crc(r[0], 5) != 0)
    again = langid.train(docs(spark, rows + [hot] * 200))
    assert np.array_equal(net.embed, again.embed) and np.array_equal(net.out, again.out)
