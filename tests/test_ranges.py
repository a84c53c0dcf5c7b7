"""Entropies by range counting against all pairs in numpy, and how their rows grow."""

import numpy as np
import pytest

from pulsegrid.operators import blocks as B
from pulsegrid.operators import entropy as E
from pulsegrid.operators import ranges as R

SCHEMA = "series string, w long, t double, x double, i int"


def frame(spark, windows):
    return spark.createDataFrame([(s, 0, float(i), float(x), i) for s, xs in windows.items() for i, x in enumerate(xs)], SCHEMA)


@pytest.fixture(scope="module")
def windows():
    r = np.random.default_rng(0)
    out = {}
    for n in (3, 4, 10, 45, 200, 700):
        out[f"normal{n}"] = r.normal(size=n)
        out[f"ties{n}"] = np.round(r.normal(size=n), 1)
        out[f"walk{n}"] = np.cumsum(r.normal(size=n))
    out["grid"] = np.tile([0.1, 0.2, 0.3, 0.4], 20) + np.repeat([0.0, 0.2], 40)  # differences that equal a tolerance
    out["constant"] = np.ones(30)
    out["far"] = 1e9 + r.normal(size=100)
    return out


@pytest.mark.parametrize("m,rth,absolute", [(2, 0.2, False), (1, 0.2, False), (3, 0.5, False), (2, 1.0, False), (2, 3.0, False), (2, 0.2, True)])
def test_sample_entropy_equals_all_pairs(spark, windows, m, rth, absolute):
    got = {x.series: x.en_sample_entropy for x in E.sample_entropy(frame(spark, windows), m, rth, absolute=absolute).collect()}
    for s, xs in windows.items():
        r = rth if absolute else xs.std() * rth
        if not r > 0 or len(xs) <= m:
            assert s not in got
            continue
        t = np.stack([xs[k:len(xs) - m + k] for k in range(m + 1)], 1)
        near = np.abs(t[:, None] - t[None]) < r
        a, b = near.all(2).sum() - len(t), near[:, :, :m].all(2).sum() - len(t)
        if s == "far":  # deviations differ in their last places
            assert got[s] == pytest.approx(-np.log(a / b), abs=0.05)
        else:
            assert got[s] == (None if b == 0 else float("inf") if a == 0 else pytest.approx(-np.log(a / b), abs=1e-9)), s


def test_approximate_entropy_equals_all_pairs(spark, windows):
    got = {x.series: x.en_apen for x in E.approximate_entropy(frame(spark, windows)).collect()}
    for s, xs in windows.items():
        def phi(m):
            t = np.stack([xs[k:len(xs) - m + 1 + k] for k in range(m)], 1)
            return np.log((np.abs(t[:, None] - t[None]) <= xs.std() * 0.2).all(2).mean(1)).mean()

        if xs.std() > 0 and s != "far":
            assert got[s] == pytest.approx(phi(1) - phi(2), abs=1e-9), s


def test_runs_are_covered_once(spark):
    runs = [(lo, hi) for lo in range(0, 70) for hi in range(lo, 140, 3)]
    rows = spark.createDataFrame(runs, "lo long, hi long").selectExpr("lo", "hi", R.cover("lo", "hi", "0D", "1D") + " AS rows",
                                                                     R.levels("lo", "hi") + " AS top").collect()
    for r in rows:
        got = []
        for n in r.rows:
            got += [n.j] if n.kind == R.SINGLE else range(n.j << n.k, (n.j + 1) << n.k) if n.kind == R.OPEN else []
            assert n.k == 0 or n.k - R.BITS <= r.top
        assert sorted(got) == list(range(r.lo, r.hi)) and sum(n.kind == R.SINGLE for n in r.rows) <= 14


def test_rows_grow_slower_than_pairs(spark, monkeypatch):
    """Twice the points make about 2.3 times the rows for two coordinates and less than 3 for three; pairs are 4 times as many."""
    made, run = [], R.running
    monkeypatch.setattr(R, "running", lambda rows, *a: (made.append(rows.count()), run(rows, *a))[1])
    r = np.random.default_rng(1)

    def rows(operator, n):
        made.clear()
        operator(frame(spark, {"a": r.normal(size=n)}))
        return sum(made)

    assert rows(E.approximate_entropy, 4000) < 2.5 * rows(E.approximate_entropy, 2000)
    assert rows(E.sample_entropy, 4000) < 3 * rows(E.sample_entropy, 2000)


def pairs(xs, r, m):
    """All pairs of templates, also with themselves: those that match in all values, and in the first ``m``."""
    n = len(xs) - m
    with np.errstate(invalid="ignore"):
        near = np.abs(xs[:, None] - xs) < r
    np.fill_diagonal(near, True)
    both = np.ones((n, n), bool)
    for k in range(m):
        both &= near[k:k + n, k:k + n]
    return [int((both & near[m:, m:]).sum()), int(both.sum())]


def test_blocks_hold_every_pair_once(windows):
    r = np.random.default_rng(4)
    more = {"copies": np.repeat(np.round(r.exponential(50, 500), 2), 4), "infinite": np.where(r.random(400) < 0.02, np.inf, r.normal(size=400)),
            "long": np.round(r.exponential(50, 2500), 2)}
    for s, xs in (windows | more).items():
        sd = xs[np.isfinite(xs)].std()
        for m in (m for m in (1, 2, 3) if len(xs) > m):
            for tolerance in (t for t in (0.2 * sd, 3 * sd, 0.2, np.nan) if not t <= 0):
                want = pairs(xs, tolerance, m)
                for most in (64, 500, R.PACKED):
                    found = [(a, b, *B.block_pairs(points, asked, m)) for a, b, points, asked in B.window_blocks(xs, tolerance, m, most)]
                    assert [sum(a + 2 * x for a, _, x, _ in found), sum(b + 2 * x for _, b, _, x in found)] == want, (s, m, tolerance, most)


def test_large_windows_make_fewer_rows_than_values(spark, monkeypatch):
    made, run = [], R.running
    monkeypatch.setattr(R, "running", lambda rows, *a: (made.append(rows.count()), run(rows, *a))[1])
    r = np.random.default_rng(2)
    large = {"plain": np.round(r.exponential(50, 3000), 2), "copies": np.repeat(np.round(r.exponential(50, 60), 2), 30), "walk": np.cumsum(r.normal(size=1500))}
    for most, rows in ((R.PACKED, len(large)), (256, 300)):
        made.clear()
        monkeypatch.setattr(R, "PACKED", most)
        got = {x.series: x for x in E.sample_entropy(frame(spark, large)).collect()}
        assert len(large) <= sum(made) <= rows  # 6,300 values
        for s, xs in large.items():
            a, b = (x - len(xs) + 2 for x in pairs(xs, 0.2 * xs.std(), 2))
            assert got[s].en_sample_entropy == pytest.approx(-np.log(a / b), abs=1e-9)
            assert got[s].en_quadratic_entropy == pytest.approx(-np.log(a / b) + np.log(0.4 * xs.std()), abs=1e-9)


def test_steps_in_a_block_grow_slower_than_pairs(monkeypatch):
    """Twice the points make less than 3 times the steps; pairs are 4 times as many."""
    made, compared, between = [], B._compared, B._between
    monkeypatch.setattr(B, "_compared", lambda c, ranks, w, *a: (made.append(len(c) * len(w)), compared(c, ranks, w, *a))[1])
    monkeypatch.setattr(B, "_between", lambda c, v, w, *a: (made.append((len(c) + 2 * len(w)) * int(v.max() + 1).bit_length()), between(c, v, w, *a))[1])
    r = np.random.default_rng(1)

    def steps(n):
        made.clear()
        xs = r.normal(size=n)
        for _, _, points, asked in B.window_blocks(xs, 0.2 * xs.std(), 2, R.PACKED):
            B.block_pairs(points, asked, 2)
        return sum(made)

    assert steps(32000) < 3 * steps(16000)
