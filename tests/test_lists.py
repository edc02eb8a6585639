"""Scores that can't enter a list are not put in order; cosines are exact by either way."""

import numpy as np

from mercato.operators import nearest, topk


def test_full_lists_only_look_at_what_reaches_them(monkeypatch):
    rng = np.random.default_rng(0)
    s = rng.normal(size=(40, 300)).round(2)
    ids, best = topk.empty_lists(40, 5)
    topk.merge_best(ids, best, np.arange(40), np.arange(200), s[:, :200])
    monkeypatch.setattr(topk.np, "partition", lambda *_, **__: 1 / 0)
    topk.merge_best(ids, best, np.arange(40), np.arange(200, 300), s[:, 200:])
    for r in range(40):
        assert ids[r].tolist() == np.lexsort((np.arange(300), -s[r]))[:5].tolist()


def test_products_are_exact_for_small_and_huge_vectors():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 4, (60, 1))
    for scale in (10_000, 40_000_000):  # the second is past what floats hold exactly
        z = rng.normal(0, scale, (60, 6)).astype(np.int64)
        size = nearest.sizes(z, codes)
        want = np.array([[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in z] for x in z], np.int64)
        want = (want + nearest.SCALE**2 * (codes == codes.T)) / (size[:, None] * size[None, :])
        assert (nearest.cosines(z, codes, size, z, codes, size) == want).all()
