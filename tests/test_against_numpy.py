"""Each feature of hand-made series against a direct computation from its definition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import names as N
from pulsegrid.functions.vectors import vectors
from pulsegrid.operators import density, dependence, distribution, entropy, lags, symbolic, trend
from pulsegrid.plans import windows as W
from pulsegrid.plans.features import features
from pulsegrid.plans.leads import own_lag_leads, window_leads

RNG = np.random.default_rng(7)
SERIES = {
    "ramp": np.arange(40.0), "sine": 3 + np.sin(np.arange(60) * 0.4), "alternating": np.tile([1.0, -1.0], 20),
    "outlier": np.r_[RNG.normal(size=30), 40.0, RNG.normal(size=10)], "tied": RNG.integers(0, 4, 50).astype(float),
    "noise": RNG.normal(2, 3, 57), "eleven": RNG.normal(size=11), "sixteen": RNG.normal(size=16),
    "seventeen": RNG.normal(size=17), "walk": np.cumsum(RNG.normal(size=120)),
}


@pytest.fixture(scope="module")
def frames(make):
    # one window holds the whole series: points at 1..n, frame points without a reading around them
    points = make({s: [(0, None), *[(k + 1, v) for k, v in enumerate(y)], (1000.5, None), (1001, None)]
                   for s, y in SERIES.items()})
    win = W.windowed(points, 1000, 600, impute=False).where("w = 0")
    rows, o = W.observed(win).cache(), W.ordered(win).cache()
    return {"rows": rows, "o": o, "vec": vectors(o), "led": window_leads(o, range(1, 27))}


def check(df, expected, tol=1e-8):
    """``expected``: function of the series giving {column: value}; NaN or None stands for NULL."""
    got = {r.series: r.asDict() for r in df.collect()}
    for s, y in SERIES.items():
        want = expected(y)
        for c, v in want.items():
            g = got[s][c] if s in got else None
            if v is None or (isinstance(v, float) and math.isnan(v)):
                assert g is None, (s, c, g)
            else:
                assert g == pytest.approx(v, rel=tol, abs=tol), (s, c)


def acf(y):
    d = y - y.mean()
    return np.array([np.sum(d[:len(d) - k] * d[k:]) for k in range(len(d))]) / np.sum(d * d)


def zero(y):
    a = acf(y)
    return next((k for k in range(1, len(y) - 1) if a[k] < 0), len(y))


def skew(y):
    return np.mean((y - y.mean()) ** 3) / np.std(y) ** 3


def kurt(y):
    return np.mean((y - y.mean()) ** 4) / np.std(y) ** 4


def q(a, b):
    with np.errstate(all="ignore"):
        v = np.float64(a) / np.float64(b)
    return float("nan") if np.isinf(v) else float(v)


@pytest.mark.parametrize("large", [False, True])
def test_distribution(frames, large):
    def expected(y):
        mu, sd = y.mean(), y.std()
        values, counts = np.unique(y, return_counts=True)
        p = counts / len(y)
        out = {"dn_mean": mu, "dn_range": np.ptp(y), "dn_iqr": np.quantile(y, .75) - np.quantile(y, .25),
               "dn_mode": values[counts.argmax()], "dn_unique": len(values) / len(y), "dn_skew1": skew(y),
               "dn_kurt1": kurt(y) - 3, "en_shannonentropy": -np.sum(p * np.log2(p)),
               "dn_withinp_1": np.mean((y >= mu - sd) & (y <= mu + sd)),
               "dn_pleft": np.quantile(abs(y - mu), .9) / sd, "dn_customskewness": (3 * mu - np.median(y)) / sd,
               "dn_highlowmu": (y[y > mu].mean() - mu) / (mu - y[y < mu].mean()),
               "dn_nlogl_norm": 0.5 + math.log(math.sqrt(2 * math.pi) * sd),
               "dn_spread_mad": np.mean(abs(y - mu)), "dn__spread_mead": np.median(abs(y - np.median(y))),
               "dn_cv_2": q(sd ** 2, mu ** 2)}
        out |= {f"dn_moment_{k}": np.mean((y - mu) ** k) / sd for k in range(2, 7)}
        out |= {f"dn_quantile_{k}": np.quantile(y, k / 100) for k in (50, 75, 90, 95, 99)}
        for k in (25, 50, 75):
            cut = int(np.round(len(y) * k / 100 / 2))
            out[f"dn_trimmedmean_{k}"] = np.sort(y)[cut:len(y) - cut].mean()
        if np.isclose(mu, 0, atol=1e-12):  # ratios to a mean of 0 are left out
            out.pop("dn_cv_2")
        return out
    check(distribution.distribution(frames["rows"], large), expected)


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("how,p", [("absfar", .5), ("absclose", .6), ("min", .1), ("max", .3)])
def test_remove_points(frames, how, p, large):
    def expected(y):
        key = {"absfar": abs(y), "absclose": -abs(y), "min": -y, "max": y}[how]
        keep = np.sort(np.argsort(key, kind="stable")[:int(np.round(len(y) * (1 - p)))])
        z = y[keep]
        a, b = acf(y), acf(z) if z.std() > 0 else np.full(len(z), np.nan)
        out = {"mean": z.mean(), "median": np.median(z), "std": z.std(ddof=1),
               "ac1rat": q(b[1], a[1]), "ac2diff": abs(b[2] - a[2]), "ac3rat": q(b[3], a[3])}
        if z.std() > 0:
            out["fzcacrat"] = zero(z) / zero(y)
        return {"dn_removepoints_" + c: v for c, v in out.items()}
    if large:  # short pieces and blocks, so that windows of forty points are spread
        check(distribution.large_remove_points(frames["rows"], how, p, pieces=5, block=9), expected)
    else:
        check(distribution.remove_points(frames["rows"], how, p), expected)


def test_autocorrelation_and_first_lags(frames):
    def per_lag(y):
        a = acf(y)
        return {f"co_autocorr_lag_{k}": (a[k] if k < len(y) else None) for k in range(1, 26)}
    check(dependence.autocorrelation(frames["led"]), per_lag)

    def first(y):
        a, n = acf(y), len(y)
        fm = n
        for i in range(1, n - 1):
            if i == 2 and a[2] > a[1]:
                fm = 1
                break
            if i > 2 and a[i - 2] > a[i - 1] < a[i]:
                fm = i - 1
                break
        fe = n
        for k in range(1, n - 1):
            u, v = y[:-k], y[k:]
            if u.std() > 1e-12 and v.std() > 1e-12 and np.corrcoef(u, v)[0, 1] < 1 / math.e:
                fe = k
                break
        return {"co_firstzero": zero(y), "co_firstmin": fm, "co_f1ecac": fe}
    check(lags.first_lags(frames["o"]), first)
    check(lags.first_lags(frames["o"], block=4), first)


def test_lagged_products(frames):
    def expected(y):
        t, n = zero(y), len(y)
        u, v = abs(y[:n - t]), abs(y[t:])
        out = {}
        for a, b in ((1, 1), (2, 3), (4, 4)):
            top = np.mean(u ** a * v ** b) - np.mean(u ** a) * np.mean(v ** b)
            bottom = np.std(u ** a) * np.std(v ** b)
            out[f"co_glscf_{a}_{b}"] = float("inf") if bottom < 1e-12 else top / bottom
        d = y[t:] - y[:n - t]
        out["co_trev"] = q(np.mean(d ** 3), np.mean(d ** 2) ** 1.5)
        if 2 * t < n:
            p = y[:n - 2 * t] * y[t:n - t]
            out["co_tc3"] = q(np.mean(p * y[2 * t:]), abs(p.mean()) ** 1.5)
        else:
            out["co_tc3"] = None
        return out
    found = lags.first_lags(frames["o"], ["co_firstzero"])
    check(dependence.lagged_products(own_lag_leads(frames["o"], found, "co_firstzero", 2)), expected, 1e-6)


def test_entropies(frames):
    def apen(y):
        r, n = .2 * y.std(), len(y)
        phi = []
        for m in (1, 2):
            t = np.array([y[i:i + m] for i in range(n - m + 1)])
            c = (abs(t[:, None] - t[None]).max(axis=2) <= r).sum(axis=1) / (n - m + 1)
            phi.append(np.log(c).mean())
        return {"en_apen": phi[0] - phi[1]}
    check(entropy.approximate_entropy(frames["o"]), apen)

    def sampen(y):
        r, n = .2 * y.std(), len(y)
        t = np.array([y[i:i + 3] for i in range(n - 2)])
        d = abs(t[:, None] - t[None])
        a, b = (d.max(axis=2) < r).sum() - len(t), (d[:, :, :2].max(axis=2) < r).sum() - len(t)
        e = None if b == 0 else float("inf") if a == 0 else -math.log(a / b)
        return {"en_sample_entropy": e, "en_quadratic_entropy": None if e is None else e + math.log(2 * r)}
    check(entropy.sample_entropy(frames["o"]), sampen)

    def cid(y):
        d, s = np.diff(y), np.diff(np.sort(y))
        return {"en_cid_ce1": np.sqrt(np.mean(1 + d ** 2)), "en_cid_mince2": np.mean(np.sqrt(1 + s ** 2)),
                "en_cid_ce2_norm": np.mean(np.sqrt(1 + d ** 2)) / np.mean(np.sqrt(1 + s ** 2))}
    check(entropy.complexity_invariant(frames["o"]), cid)

    def permen(y):
        words = [tuple(np.argsort(y[i:i + 5:2], kind="stable")) for i in range(len(y) - 4)]
        p = np.array([words.count(w) for w in set(words)]) / len(words)
        return {"en_permen_3_2": -np.sum(p * np.log2(p))}
    check(entropy.permutation_entropy(frames["led"], 3, 2), permen)

    def mse(y):
        vals = []
        for s in (2, 3):
            c = y[:len(y) // s * s].reshape(-1, s).mean(axis=1)
            if len(c) < 20 or c.std() < 1e-12:
                continue
            r = .15 * c.std()
            t = np.array([c[i:i + 3] for i in range(len(c) - 2)])
            d = abs(t[:, None] - t[None])
            a, b = (d.max(axis=2) < r).sum() - len(t), (d[:, :, :2].max(axis=2) < r).sum() - len(t)
            if a and b:
                vals.append(-math.log(a / b))
        return {"en_mse_mean": float(np.mean(vals)) if vals else None}
    check(entropy.multiscale_entropy(frames["o"], [2, 3])[1], mse)


def runs(b):
    cuts = np.flatnonzero(np.diff(b)) + 1
    parts = np.split(b, cuts)
    return [len(p) for p in parts if p[0] == 0], [len(p) for p in parts if p[0] == 1]


def test_binary_and_motifs(frames):
    def binary(y):
        lo, hi = np.quantile(y, [.25, .75])
        out = {}
        for m, b in (("diff", np.diff(y) > 0), ("mean", y > y.mean()), ("median", y > np.median(y)),
                     ("iqr", (y > lo) & (y < hi))):
            b = b.astype(int)
            zeros, ones = runs(b)
            half = len(b) // 2
            out[f"{m}_pupstat2"] = q(b[half:].sum(), b[:half].sum())
            out[f"{m}_pstretch1"] = len(ones) / len(b)
            out[f"{m}_longstretch0"] = max(zeros, default=0)
            out[f"{m}_meanstretch1"] = float(np.mean(ones)) if ones else 0
            out[f"{m}_stdstretch1"] = float(np.std(ones, ddof=1)) if len(ones) > 1 else None
        return {"sb_binarymethod_" + c: v for c, v in out.items()}
    check(symbolic.binary_stats(frames["o"]), binary)

    def motifs(y):
        b = "".join("u" if d > 0 else "d" for d in np.diff(y))
        out = {}
        for size in range(1, 5):
            words = [b[i:i + size] for i in range(len(b) - size + 1)]
            p = {w: words.count(w) / len(words) for w in set(words)}
            out["h" * size] = -sum(v * math.log(v) for v in p.values())
            out["u" * size], out["d" * size] = p.get("u" * size, 0.0), p.get("d" * size, 0.0)
        return {"sb_motiftwo_diff_" + c: v for c, v in out.items()}
    check(symbolic.motifs(frames["led"]), motifs)


def test_trend_and_segments(frames):
    def line(y):
        z = (y - y.mean()) / y.std()
        i = np.arange(len(z))
        m, b = np.polyfit(i, z, 1)
        c = np.cumsum(z)
        half = len(z) // 2
        return {"trend_stdratio": np.std(z - m * i - b), "trend_gradient": m, "trend_intercept": b,
                "trend_meanyc": c.mean(), "trend_gradientyc": np.polyfit(i, c, 1)[0],
                "trend_meanyc12": c[:half].mean(), "trend_meanyc22": c[half:].mean()}
    check(trend.trend(frames["o"]), line, 1e-6)

    def drift(y):
        z = y[:len(y) // 5 * 5].reshape(-1, 5)
        return {"sy_driftingmean__max": q(z.mean(axis=1).max(), z.var(axis=1, ddof=1).mean())}
    check(trend.drifting_mean(frames["o"]), drift)

    def statav(y):
        n = len(y)
        out = {}
        for k in (2, 10):
            p = n // k
            out[f"sy_statav_seg_{k}"] = np.std([y[p * j:p * (j + 1)].mean() for j in range(k)], ddof=1) / y.std(ddof=1)
            if n > 2 * k:
                out[f"sy_statav_len_{k}"] = np.std([y[k * j:k * (j + 1)].mean() for j in range(n // k)], ddof=1) / y.std(ddof=1)
        return out
    check(trend.segment_means(frames["o"]), statav)


def test_moving_threshold(frames):
    def expected(y):
        a, b = .5, .1
        y = abs(y)
        th, kicks = [1.0], [0.0]
        for v in y[1:]:
            if v > th[-1]:
                kicks.append((1 + a) * v - th[-1])
                th.append((1 + a) * v)
            else:
                kicks.append(0.0)
                th.append((1 - b) * th[-1])
        th = np.array(th)
        gaps = np.diff(np.flatnonzero(np.array(kicks) > 0))
        out = {"meanq": th.mean(), "medianq": np.median(th), "iqrq": np.subtract(*np.quantile(th, [.75, .25])),
               "maxq": th.max(), "minq": th.min(), "stdq": th.std(), "meanqover": np.mean(th - y),
               "pkick": np.sum(kicks) / len(y) - 1, "stdkicks": float(gaps.std()) if len(gaps) else None,
               "meankickf": float(gaps.mean()) if len(gaps) else None,
               "mediankicksf": float(np.median(gaps)) if len(gaps) else None}
        return {"ex_movingthreshold_a0_5_b0_1_" + c: v for c, v in out.items()}
    check(trend.moving_threshold(frames["vec"]), expected)


def test_scaling(frames):
    def dfa(y, sizes):
        p = np.cumsum(y - y.mean())
        logs = []
        for t in sizes:
            boxes = p[:len(p) // t * t].reshape(-1, t)
            i = np.arange(t)
            rss = sum(np.sum((x - np.polyval(np.polyfit(i, x, 1), i)) ** 2) for x in boxes)
            logs.append(math.log(math.sqrt(rss / boxes.size)))
        return float(np.polyfit(np.log(sizes), logs, 1)[0]) if len(logs) > 1 else None
    check(trend.detrended_fluctuation(frames["o"]), lambda y: {"sc_dfa": dfa(y, range(5, len(y) // 2 + 1))}, 1e-5)
    spread = trend.large_fluctuation(frames["o"], block=7)
    check(spread, lambda y: {"sc_dfa": dfa(y, range(5, len(y) // 2 + 1))}, 1e-9)
    lifted = frames["o"].withColumn("x", F.col("x") + 1e9)
    check(trend.large_fluctuation(lifted, block=16), lambda y: {"sc_dfa": dfa(y + 1e9, range(5, len(y) // 2 + 1))}, 1e-9)

    def hurst(y):
        n, pts = len(y), []
        for e in range(int(np.log2(n))):
            x = y[:n - n % 2 ** e].reshape(2 ** e, -1)
            z = np.cumsum(x - x.mean(axis=1, keepdims=True), axis=1)
            s = x.std(axis=1)
            s[s < 1e-14] = 1
            pts.append((math.log(n // 2 ** e), math.log(np.mean(np.ptp(z, axis=1) / s))))
        return {"sc_hurstexp": np.polyfit(*zip(*pts), 1)[0]}
    check(trend.hurst_exponent(frames["o"].where("series <> 'alternating'")),
          lambda y: {} if np.array_equal(y, SERIES["alternating"]) else hurst(y), 1e-6)
    assert trend.power_sizes() == [32, 38, 45, 53, 64, 76, 90, 107, 128, 152, 181, 215, 256, 304, 362, 430]


def test_density(frames):
    def fit(y):
        h = y.std(ddof=1) * len(y) ** -.2
        g = np.linspace(y.min(), y.max(), 1000)
        k = np.exp(-.5 * ((g[:, None] - y) / h) ** 2).sum(axis=1) / (len(y) * h * math.sqrt(2 * math.pi))
        f = np.exp(-.5 * ((g - y.mean()) / y.std()) ** 2) / (y.std() * math.sqrt(2 * math.pi))
        dx = g[1] - g[0]
        return {"dn_compareksfit_adiff": np.sum(abs(k - f)) * dx, "dn_compareksfit_peaksepy": f.max() - k.max(),
                "dn_compareksfit_relent": np.sum(k * np.log(k / f)) * dx}
    check(density.compare_fit(frames["vec"]), fit, 1e-6)
    check(density.large_compare_fit(frames["o"], block=16), fit, 1e-6)
    for one, spread in ((density.compare_fit(frames["vec"], "beta"), density.large_compare_fit(frames["o"], "beta", block=16)),
                        (density.kernel_shape(frames["vec"], (.05,), (.05,), (2.0,)),
                         density.large_kernel_shape(frames["o"], (.05,), (.05,), (2.0,), block=16))):
        got = {r.series: r.asDict() for r in spread.collect()}
        for r in one.collect():
            for c, v in r.asDict().items():
                assert got[r.series][c] == (v if v is None or isinstance(v, str) else pytest.approx(v, rel=1e-8, abs=1e-10)), (r.series, c)

    def season(y):
        i, best = np.arange(len(y)), 0
        for j in range(4, 2 * len(y) + 1):  # quarters of a cycle
            a = np.column_stack([np.cos(.5 * np.pi * j * i / len(y)), np.sin(.5 * np.pi * j * i / len(y)), np.ones(len(y))])
            r = y - a @ np.linalg.lstsq(a, y, rcond=1e-6)[0]
            best = max(best, 1 - np.sum(r ** 2) / np.sum((y - y.mean()) ** 2))
        return {"seasonal_r2": best, "isseasonal": bool(best > .3)}
    check(density.seasonal(frames["vec"]), season, 1e-6)


def test_half_cycles_are_found():
    i = np.arange(64)
    y = np.sin(2 * np.pi * 5.5 * i / 64) + .7 * np.random.default_rng(1).normal(size=64)
    assert density.best_sine(y - y.mean()) > .4


def test_log_gamma(spark):
    xs = [0.01, 0.5, 1.0, 2.5, 30.0, 400.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(density.log_gamma(F.col("x"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.lgamma(x) for x in xs], rel=1e-10, abs=1e-10)


def test_outlier_thresholds(frames):
    got = {(r.series, round(r.th, 3)): r for r in distribution.outlier_thresholds(frames["o"], "abs", .5).collect()}
    for s in ("noise", "outlier", "walk"):
        y = SERIES[s]
        z = (y - y.mean()) / y.std()
        for th in np.arange(0, abs(z).max(), .5):
            at = np.flatnonzero(abs(z) >= th)
            r = got[s, round(float(th), 3)]
            assert r.mean_at == pytest.approx(at.mean() / (len(y) / 2) - 1)
            assert r.pct == pytest.approx((len(at) - 1) / len(y) * 100)
            if len(at) > 1:
                assert r.mean_gap == pytest.approx(np.diff(at).mean())


def test_default_output_has_all_columns(make):
    p = make({"a": [(t, math.sin(t) + (t * 7) % 5) for t in range(130)]})
    df = features(p, 100, 20, published=True)
    assert len(df.columns) == 2 + 329 and df.columns[3:6] == ["Observations", "DN_Mean", "DN_Range"]
    assert df.columns[-1] == "SY_DriftingMean_ meanabsmaxmin"
    assert len(set(N.published_names())) == 328


def test_properties(frames):
    row = {r.series: r.asDict() for r in symbolic.motifs(frames["led"]).collect()}
    for r in row.values():
        for size in range(1, 5):
            words = [c for c in r if c.startswith("sb_motiftwo_diff_") and len(c.rsplit("_", 1)[1]) == size
                     and set(c.rsplit("_", 1)[1]) <= {"u", "d"}]
            assert sum(r[c] for c in words) == pytest.approx(1)
            assert r["sb_motiftwo_diff_" + "h" * size] >= 0
