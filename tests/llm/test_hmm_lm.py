import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from mercato.llm import hmm_lm as lm

from .util import crc, docs, edge_rows, prose, words


def small_model(rng):
    draw = lambda *s: (x := rng.random(s) + 0.1) / x.sum(-1, keepdims=True)
    return lm.Hmm(draw(lm.STATES), draw(lm.STATES, lm.STATES), draw(lm.STATES, lm.CLASSES))


def test_forward_equals_sum_over_paths(monkeypatch):
    monkeypatch.setattr(lm, "STATES", 3)
    monkeypatch.setattr(lm, "CLASSES", 4)
    m = small_model(np.random.default_rng(0))
    seqs = [[0], [1, 2, 0], [3, 3, 1, 0, 2], [2, 0]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    got = lm.likelihoods(m, np.concatenate(seqs), first)
    for s, g in zip(seqs, got, strict=True):
        p = sum(m.start[z[0]] * m.emit[z[0], s[0]]
                * math.prod(m.move[z[t - 1], z[t]] * m.emit[z[t], s[t]] for t in range(1, len(s)))
                for z in itertools.product(range(3), repeat=len(s)))
        assert g == pytest.approx(math.log10(p))
    # expected counts: as many starts as texts, moves as steps, emissions as tokens
    start, moves, counts = lm.expected(m, np.concatenate(seqs).astype(np.int64), first)
    assert start.sum() == pytest.approx(4, rel=1e-4) and moves.sum() == pytest.approx(first[-1] - 4, rel=1e-4)
    assert np.allclose(counts.sum(0), np.bincount(np.concatenate(seqs), minlength=4), rtol=1e-3)


def test_baum_welch_raises_the_likelihood(monkeypatch):
    rng = np.random.default_rng(1)
    seqs = [rng.integers(1, 50, rng.integers(3, 40)) + 60 * (k % 2) for k in range(40)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    flat = np.concatenate(seqs)
    few = lm.likelihoods(lm.first_model(seqs, rounds=1), flat, first).sum()
    assert lm.likelihoods(lm.first_model(seqs, rounds=12), flat, first).sum() > few


def test_scores_match_brute_force_counts(spark):
    rng = random.Random(7)
    rows = edge_rows() + [(200 + i, prose(rng, rng.randint(1, 80), 300 if i % 2 else 30)) for i in range(80)]
    got = sorted((tuple(r) for r in lm.score(docs(spark, rows)).collect()), key=repr)
    tokens = [[*words(r[1]), "END"] for r in rows]
    held = [crc(r[0], 7) == 2 for r in rows]
    count = Counter()
    for r, t, h in zip(rows, tokens, held, strict=True):
        if r[0] is not None and not h:
            count.update(t)
    n, v = sum(count.values()), len(count)
    want = sorted(((r[0], h, len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))
                   for r, t, h in zip(rows, tokens, held, strict=True)), key=repr)
    assert [(g[0], g[1], g[2], g[3], g[4]) for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(g[6] < 0 for g in got)


def test_every_round_counts_all_texts_until_the_gain_falls(spark):
    # a rare vocabulary and an id of many rows, among more texts than a small sample holds
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(5, 30), 200)) for i in range(600)]
    rows += [(1000 + i, " ".join(rng.choice(["zu", "xo", "qy"]) for _ in range(20))) for i in range(3)]
    rows += [(2000, "same words " * 4)] * 300
    got = sorted((r.doc_id, r.score) for r in lm.score(docs(spark, rows)).collect())

    tokens = [words(r[1]) for r in rows]
    learn = [crc(r[0], 7) != 2 for r in rows]
    count = Counter(w for t, ok in zip(tokens, learn, strict=True) if ok for w in t)

    def cls(w):
        return int(lm.word_classes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])

    of = {w: cls(w) for t in tokens for w in t}
    base, spread = np.zeros(lm.CLASSES), np.ones(lm.CLASSES)
    for w, c in count.items():
        base[of[w]] += c
        spread[of[w]] += c + 1
    base[lm.END] = sum(learn)
    seqs = [np.array([of[w] for w in t] + [lm.END]) for t in tokens]
    own = [q for q, ok in zip(seqs, learn, strict=True) if ok]
    flat = np.concatenate(own).astype(np.int64), np.concatenate([[0], np.cumsum([len(q) for q in own])])
    m, logs = lm.seeded(base), []
    while len(logs) < 2 or logs[-1] - logs[-2] > lm.START_TOLERANCE * abs(logs[-2]):
        start, counts, log = np.zeros(lm.STATES), np.zeros((lm.STATES, lm.CLASSES)), 0.0
        for q in own:
            for i in range(0, len(q), lm.WINDOW):
                p = np.log(m.start) + np.log(m.emit[:, q[i:i + lm.WINDOW]]).sum(1)
                share = np.exp(p - p.max()) / np.exp(p - p.max()).sum()
                log += p.max() + math.log(np.exp(p - p.max()).sum())
                start += share
                for c in q[i:i + lm.WINDOW]:
                    counts[:, c] += share
        logs.append(log)
        m = lm.normalised(start, np.eye(lm.STATES) * lm.STAY, counts)
    logs = []
    while len(logs) < 2 or logs[-1] - logs[-2] > lm.TOLERANCE * abs(logs[-2]):
        logs.append(lm.likelihoods(m, *flat).sum())
        m = lm.normalised(*lm.expected(m, *flat))
    assert len(logs) > 3
    want = lm.likelihoods(m, np.concatenate(seqs).astype(np.int64), np.concatenate([[0], np.cumsum([len(q) for q in seqs])]))
    want = sorted((r[0], v + sum(math.log10(count[w] + 1) - math.log10(spread[of[w]]) for w in t))
                  for r, t, v in zip(rows, tokens, want, strict=True))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-3)


def test_word_distribution_is_proper():
    # shares of the words of one class and its unknown word add up to 1
    counts = {1: [3, 0, 5], 2: [1]}
    for own in counts.values():
        known = [c for c in own if c]
        spread = 1 + sum(known) + len(known)
        assert sum((c + 1) / spread for c in known) + 1 / spread == pytest.approx(1)


def test_nothing_to_learn_and_empty(spark):
    assert lm.score(docs(spark, [])).count() == 0
    out = lm.score(docs(spark, [(None, None), (None, "a b")])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in out) == [(1, 0, 0), (3, 0, 0)]
    out = lm.score(docs(spark, [(1, None), (2, "")])).collect()
    assert [r.n_tokens for r in out] == [1, 1]


def test_unscaled_steps_give_the_same_counts():
    # long and short texts; emissions so uneven that sums of unscaled steps leave the range
    rng = np.random.default_rng(4)
    seqs = [np.append(rng.integers(1, 60, n), lm.END) for n in (0, 1, 2, 3, 4, 5, 8, 700, 9, 4)]
    flat, first = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(q) for q in seqs])])
    for spread in (1.0, 30.0):
        m = small_model(rng)
        emit = np.exp(spread * rng.normal(size=m.emit.shape).clip(-1, 1))
        m = lm.Hmm(m.start, m.move, emit / emit.sum(1, keepdims=True))
        one, four = lm._expected(m, flat, first, 1), lm._expected(m, flat, first)
        assert four[3] == pytest.approx(lm.likelihoods(m, flat, first).sum() * math.log(10), rel=1e-5)
        for a, b in zip(one, four, strict=True):
            assert np.allclose(a, b, rtol=1e-3, atol=1e-4)


def test_patterned_long_words_are_told_apart(spark):
    one = "a"
    while len(one) < 2048:
        one += one.translate({97: "b", 98: "a"})
    other = one.translate({97: "b", 98: "a"})
    known, unseen = (next(i for i in range(99) if (crc(i, 7) == 2) is held) for held in (False, True))
    out = {r.doc_id: r for r in lm.score(docs(spark, [(known, one), (unseen, other)])).collect()}
    assert (out[known].n_known, out[unseen].n_known) == (2, 1)
