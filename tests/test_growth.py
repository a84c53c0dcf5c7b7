"""Steps that must not grow faster than their input: nothing is broadcast, repeated or held that a larger table would multiply."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.vectors import vectors
from pulsegrid.operators import density, distribution, entropy, trend
from pulsegrid.operators import ranges as R

SCHEMA = "series string, w long, t double, x double, i int"


def frame(spark, windows):
    return spark.createDataFrame([(s, 0, float(i), float(x), i) for s, xs in windows.items() for i, x in enumerate(xs)], SCHEMA)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_boxes_of_crowded_windows_are_not_broadcast(spark):
    r = np.random.default_rng(3)
    o = frame(spark, {"a": np.cumsum(r.normal(size=3000)), "b": r.normal(size=700), "short": r.normal(size=20)})
    sizes = trend.power_sizes()
    spread = trend.large_fluctuation(o, sizes, "dfa", F.log2, block=64)
    got = {x.series: x.dfa for x in spread.collect()}
    want = {x.series: x.dfa for x in trend.detrended_fluctuation(o, sizes, "dfa", F.log2).collect()}
    assert set(got) == {"a", "b"}  # a window shorter than every box has no row
    assert all(got[s] == pytest.approx(want[s], rel=1e-7) for s in got)
    assert "Join" not in executed(trend._assigned(trend._segments(trend._profile(o, 64).localCheckpoint(), 512), sizes))


def some(n=4):
    r = np.random.default_rng(5)
    return {f"{kind}{k}": xs for k in range(n) for kind, xs in (
        ("normal", r.normal(size=40 + k)), ("ties", np.round(r.normal(size=70), 1)), ("walk", np.cumsum(r.normal(size=130))))} | {
        "constant": np.ones(30), "two": np.array([1.0, 2.0]), "one": np.ones(1)}


OPERATORS = {
    "sampen": entropy.sample_entropy, "apen": entropy.approximate_entropy,
    "scales": lambda o: entropy.multiscale_entropy(o, [2, 3, 5])[0], "mse": lambda o: entropy.multiscale_entropy(o, [2, 3, 5])[1]}


@pytest.mark.parametrize("name", OPERATORS)
def test_small_windows_make_no_rows_for_ranges(spark, monkeypatch, name):
    made, run = [], R.running
    monkeypatch.setattr(R, "running", lambda rows, *a: (made.append(rows.count()), run(rows, *a))[1])
    o = frame(spark, some())
    rows = lambda: {tuple(r[c] for c in ("series", "scale") if c in r): r.asDict() for r in OPERATORS[name](o).collect()}
    at_once = rows()
    assert sum(made) == 0
    monkeypatch.setattr(entropy, "SMALL", 1)
    by_ranges = rows()
    assert sum(made) > 0 and set(at_once) == set(by_ranges)
    for key, want in by_ranges.items():
        assert at_once[key] == {c: v if v is None or isinstance(v, str) else pytest.approx(v, abs=1e-9) for c, v in want.items()}


def test_densities_return_in_small_batches(spark, monkeypatch):
    vec = vectors(frame(spark, some(30)))
    want = {r.series: r.f for r in density.kernel_density(vec, 50).collect()}
    plan = executed(density.kernel_density(vec, 50))
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    monkeypatch.setattr(density, "ROWS", 3)
    assert {r.series: r.f for r in density.kernel_density(vec, 50).collect()} == want and set(want) == set(some(30)) - {"constant", "one"}


@pytest.mark.parametrize("how", ["abs", "p", "n"])
def test_outlier_thresholds_sort_nothing_by_threshold(spark, how):
    windows = some(2)
    out = distribution.outlier_thresholds(frame(spark, windows), how, 0.25)
    assert not re.search(r"(Sort|Window|hashpartitioning)[^\n]*step", executed(out))
    got = {(r.series, round(r.th, 4)): r for r in out.collect()}
    seen = 0
    for s, y in windows.items():
        if not y.std() > 0:
            continue
        z = (y - y.mean()) / y.std()
        z = {"abs": abs(z), "p": z, "n": -z}[how]
        for th in np.arange(0, z.max(), 0.25):
            at = np.flatnonzero(z >= th)
            r, seen = got[s, round(float(th), 4)], seen + 1
            assert r.mean_at == pytest.approx(at.mean() / (len(y) / 2) - 1) and r.median_at == pytest.approx(np.median(at) / (len(y) / 2) - 1)
            assert r.std_at == pytest.approx(at.std() / np.sqrt(len(at)), abs=1e-9)
            assert r.pct == pytest.approx((len(at) - 1) / (z >= 0).sum() * 100)
            if len(at) > 1:
                assert r.mean_gap == pytest.approx(np.diff(at).mean())
                assert r.std_gap == pytest.approx(np.diff(at).std() / np.sqrt(len(at)), abs=1e-9)
            else:
                assert r.mean_gap is None and r.std_gap is None
    assert seen == len(got)


def test_spread_finds_only_its_quantiles(spark, monkeypatch):
    from suite import queries as Q

    sought, run = [], distribution.large_quantiles
    monkeypatch.setattr(distribution, "large_quantiles", lambda rows, probs, *a, **k: (sought.append(set(probs)), run(rows, probs, *a, **k))[1])
    Q.QUERIES["dn_spread"](spark, "/root/testdata/sf0.001")
    assert sought == [{"med"}, {"dn__spread_mead"}]
