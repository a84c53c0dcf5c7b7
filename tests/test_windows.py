import math

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import dependence
from pulsegrid.plans import windows as W
from pulsegrid.plans.features import features
from pulsegrid.plans.leads import series_leads, window_leads


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_last_window_end_is_before_last_time(make):
    # ends at 10, 15, 20 would be allowed up to, but not including, the last time
    spine = W.window_spine(make({"a": [(0, 1), (20, 1)], "b": [(0, 1), (21, 1)]}), 10, 5)
    assert rows(spine, "series", "w", "w_end") == [
        ("a", 0, 10.0), ("a", 1, 15.0), ("b", 0, 10.0), ("b", 1, 15.0), ("b", 2, 20.0)]


@pytest.mark.parametrize("pts", [[(0, 1)], [(0, 1), (9, 2)], [(0, 1), (10, 2)]])
def test_short_series_has_no_window(make, pts):
    p = make({"a": pts})
    assert W.window_spine(p, 10, 5).count() == 0
    assert W.windowed(p, 10, 5).count() == 0


def test_windows_are_open_left_and_closed_right(make):
    p = make({"a": [(0, 0), (5, 1), (10, 2), (15, 3), (16, 4)]})
    got = rows(W.windowed(p, 10, 5), "w", "t")
    assert got == [(0, 5.0), (0, 10.0), (1, 10.0), (1, 15.0)]


def test_ends_are_cut_to_whole_seconds_and_aligned_to_the_series(make):
    p = make({"a": [(0.5, 0), (0.9, 1), (10.0, 2), (10.4, 3), (30.0, 4)]})
    got = rows(W.windowed(p, 10, 10).where("w = 0"), "t")
    # the end is 10.5, cut to 10: 10.4 lies outside, and so does everything up to 0
    assert got == [(0.5,), (0.9,), (10.0,)]
    assert rows(W.window_spine(p, 10, 10), "w_end") == [(10.5,), (20.5,)]


def test_each_point_is_in_few_windows(make):
    p = make({"a": [(t, t) for t in range(0, 500, 3)]})
    most = W.windowed(p, 50, 20).groupBy("t").count().agg(F.max("count")).first()[0]
    assert most <= math.ceil(50 / 20) + 1


@pytest.mark.parametrize("chunk", [1.0, 7.0, 1e9])
def test_carry_forward_crosses_chunks(make, chunk):
    p = make({"a": [(0, None), (1, 5), (2, None), (12, None), (30, None), (31, 7), (40, None)],
              "b": [(0, None), (50, None)], "c": [(3, 9)]})
    got = {(s, t): y for s, t, y in rows(W.carry_forward(p, chunk).fillna(-1), "series", "t", "yf")}
    assert [got["a", t] for t in (0, 1, 2, 12, 30, 31, 40)] == [-1, 5, 5, 5, 5, 7, 7]
    assert got["b", 50] == -1 and got["c", 3] == 9


def test_windows_do_not_depend_on_chunk_or_other_series(make):
    a = [(t, None if t % 4 == 1 else t % 7) for t in range(100)]
    alone = W.windowed(make({"a": a}), 20, 10)
    both = W.windowed(make({"a": a, "b": [(t * 3, 1) for t in range(50)]}), 20, 10, chunk=3.0)
    assert rows(alone, "series", "w", "t", "yf") == rows(both.where("series = 'a'"), "series", "w", "t", "yf")


@pytest.mark.parametrize("impute", [True, False])
@pytest.mark.parametrize("block", [4, 5, 1000])
def test_look_ahead_in_series_equals_look_ahead_in_window(make, impute, block):
    pts = [(t + (t % 5) * 0.1, None if t % 6 == 0 else (t * 37) % 11) for t in range(120)]
    p = make({"a": pts, "b": [(t * 9, t % 3) for t in range(20)]})
    lags = [1, 2, 3]
    o = W.ordered(W.windowed(p, 30, 10, impute))
    cols = ["series", "w", "t", "x", "x1", "x2", "x3"]
    one = rows(window_leads(o, lags).fillna(-1.0), *cols)
    two = rows(series_leads(p, 30, 10, lags, impute, chunk=7.0, block=block).fillna(-1.0), *cols)
    assert one == two and len(one) > 100


def test_centre_is_corrected(make):
    p = make({"a": [(t, 1000 + t + (t * 37) % 11) for t in range(200)]})
    o = W.ordered(W.windowed(p, 40, 20))
    lags = [1, 5]
    one = rows(dependence.autocorrelation(window_leads(o, lags), lags), "w", *[f"co_autocorr_lag_{k}" for k in lags])
    two = rows(dependence.autocorrelation(series_leads(p, 40, 20, lags), lags, exact_centre=False), "w",
               *[f"co_autocorr_lag_{k}" for k in lags])
    for a, b in zip(one, two, strict=True):
        assert a == pytest.approx(b, abs=1e-9)


def test_gates(make):
    def span(n, f=lambda k: k):  # n readings in (0, 100], frame points outside
        return [(0, None)] + [(100 * (k + 1) / n, f(k)) for k in range(n)] + [(100.5, None)]
    p = make({"n0": [(0, None), (100.5, None)], "n1": span(1), "n10": span(10), "n11": span(11),
              "flat": span(11, lambda k: 4.0), "zero": span(11, lambda k: 0.0)})
    got = {r.series: r for r in features(p, 100, 50, groups=["summary", "values", "deviations", "autocorrelation"]).collect()}
    assert got["n0"].observations is None and got["n1"].observations is None and got["n1"].time == 100
    assert got["n10"].observations == 10 and got["n10"].dn_mean is None
    assert got["n11"].dn_mean == 5 and got["n11"].co_autocorr_lag_1 is not None
    for s, v in (("flat", 4.0), ("zero", 0.0)):
        assert got[s].dn_mean == v and got[s].dn_std == 0 and got[s].dn_mode == v and got[s].dn_withinp_1 == 1
        assert got[s].dn_quantile_50 is None and got[s].co_autocorr_lag_1 is None


def test_selection(make):
    p = make({"a": [(t, t % 5) for t in range(60)]})
    got = features(p, 40, 20, select=["DN_MinMax", "EN_CID"])
    assert got.columns == ["series", "w", "time", "observations", "dn_max", "dn_min", "en_cid_ce1", "en_cid_ce2",
                           "en_cid_mince1", "en_cid_mince2", "en_cid_ce1_norm", "en_cid_ce2_norm"]


def test_crowded_form_equals_plain_form(make):
    p = make({"a": [(t, None if t % 9 == 2 else (t * 37) % 11 + t / 7) for t in range(300)],
              "b": [(t * 2, (t * 5) % 4) for t in range(100)]})
    groups = ["summary", "deviations", "trimmed", "autocorrelation", "information", "crinkle", "motifs"]
    plain = features(p, 60, 30, groups=groups).orderBy("series", "w").collect()
    large = features(p, 60, 30, groups=groups, large=True).orderBy("series", "w").collect()
    staged = features(p, 60, 30, groups=groups, stage=True).orderBy("series", "w").collect()
    assert len(plain) == len(large) > 10
    for a, b, c in zip(plain, large, staged, strict=True):
        assert list(a[3:]) == pytest.approx(list(b[3:]), rel=1e-8, abs=1e-8)
        assert list(a[3:]) == pytest.approx(list(c[3:]), rel=1e-8, abs=1e-8)
