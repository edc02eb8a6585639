"""Distributed exact quantiles against numpy."""

import numpy as np
import pytest

from mercato.operators import quantiles

SPECS = {f"q{k}": ("v", q) for k, q in enumerate((0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0))}


@pytest.mark.parametrize("accuracy", [100_000, 50])
def test_matches_numpy(spark, accuracy):
    rng = np.random.default_rng(0)
    cases = {"one": [3.5], "two": [1.0, 2.0], "ties": [2.0] * 50 + [7.0] * 3, "small": rng.normal(size=9).tolist(),
             "wide": rng.lognormal(0, 3, 4000).tolist(), "ints": rng.integers(0, 20, 999).astype(float).tolist()}
    rows = [(g, float(v)) for g, vs in cases.items() for v in vs] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in quantiles(df, SPECS, by=["g"], accuracy=accuracy).collect()}
    for g, vs in cases.items():
        assert [got[g][k] for k in SPECS] == pytest.approx([np.quantile(vs, q) for _, q in SPECS.values()], rel=1e-12)
    whole = quantiles(df, SPECS, accuracy=accuracy).first()
    every = [v for vs in cases.values() for v in vs]
    assert [whole[k] for k in SPECS] == pytest.approx([np.quantile(every, q) for _, q in SPECS.values()], rel=1e-12)


def test_empty_gives_null(spark):
    r = quantiles(spark.createDataFrame([], "v double"), {"m": ("v", 0.5)}).first()
    assert r.m is None
