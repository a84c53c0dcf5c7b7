"""Autocorrelation and dependence features of the filled, ordered values of a window.

``led`` are rows from ``plans.leads`` with the lags an operator needs, ``o`` is ``ordered(win)``:
``(series, w, t, x, i)``, and ``vec`` is ``vectors(o)``: one array per window.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import vectors as V
from pulsegrid.functions.expr import KEYS, by, div, pearson, per, share


def autocorrelation(led: DataFrame, lags: Iterable[int] = range(1, 26), exact_centre: bool = True) -> DataFrame:
    """Biased autocorrelation per lag; NULL for lags the window is too short for.

    ``exact_centre=False`` corrects for a centre ``c`` that is not the window's own mean.
    """
    lags = list(lags)
    d = led.selectExpr(*KEYS, "x - c AS d", *[f"x{k} - c AS d{k}" for k in lags])
    sums = {"v": "sum(d * d)", **{f"s{k}": f"sum(d * d{k})" for k in lags}}
    if not exact_centre:
        sums |= {"n": "count(d)", "m": "avg(d)"}
        for k in lags:
            sums |= {f"h{k}": f"sum(CASE WHEN d{k} IS NOT NULL THEN d END + d{k})", f"n{k}": f"count(d{k})"}
    s = d.groupBy(*KEYS).agg(*[F.expr(e).alias(c) for c, e in sums.items()])
    if exact_centre:
        return s.selectExpr(*KEYS, *[f"try_divide(s{k}, v) AS co_autocorr_lag_{k}" for k in lags])
    return s.selectExpr(*KEYS, *[
        f"try_divide(s{k} - m * h{k} + n{k} * m * m, v - n * m * m) AS co_autocorr_lag_{k}" for k in lags])


def slice_correlation(led: DataFrame, lags: Iterable[int] = range(1, 6)) -> DataFrame:
    """Pearson correlation of the series with itself ``k`` positions later."""
    return led.groupBy(*KEYS).agg(
        *[pearson(F.col("x"), F.col(f"x{k}")).alias(f"co_slicecorr_lag_{k}") for k in lags])


def lagged_products(led: DataFrame, powers: range = range(1, 5)) -> DataFrame:
    """Generalised self-correlation, third-order correlation and time-reversal asymmetry at the window's own lag.

    ``led`` has the values one and two lags later as ``xtau`` and ``x2tau`` (``own_lag_leads``).
    """
    both = "CASE WHEN xtau IS NOT NULL THEN x END"
    long = led.selectExpr(*KEYS, f"{both} AS a", "xtau AS b", "x2tau AS c", f"abs({both}) AS p", "abs(xtau) AS q", "xtau - x AS dx")

    def pw(c: str, k: int) -> str:
        return " * ".join([c] * k)

    sums = {f"{c}{k}": f"avg({pw(c, k)})" for c in "pq" for k in range(1, 2 * max(powers) + 1)}
    sums |= {f"pq{a}{b}": f"avg({pw('p', a)} * {pw('q', b)})" for a in powers for b in powers}
    sums |= {"abc": "avg(a * b * c)", "ab": "avg(CASE WHEN c IS NOT NULL THEN a * b END)",
             "d2": f"avg({pw('dx', 2)})", "d3": f"avg({pw('dx', 3)})"}
    m = long.groupBy(*KEYS).agg(*[F.expr(e).alias(k) for k, e in sums.items()])

    def glscf(a: int, b: int) -> Column:
        top = f"(pq{a}{b} - p{a} * q{b})"
        bottom = (f"(sqrt(greatest(p{2 * a} - p{a} * p{a}, 0D)) * sqrt(greatest(q{2 * b} - q{b} * q{b}, 0D)))")
        return F.expr(f"CASE WHEN {bottom} = 0 THEN double('inf') ELSE {top} / {bottom} END")

    def three_halves(c: Column) -> Column:
        return c * F.sqrt(c)

    return m.select(
        *KEYS, *[glscf(a, b).alias(f"co_glscf_{a}_{b}") for a in powers for b in powers],
        div(F.col("abc"), three_halves(F.abs("ab"))).alias("co_tc3"),
        div(F.col("d3"), three_halves(F.col("d2"))).alias("co_trev"))


def _information(r: Column) -> Column:
    # a perfect correlation has no finite information
    return -0.5 * F.ln(F.nullif(1 - r * r, F.lit(0.0)))


def mutual_information(led: DataFrame, delays: Iterable[int] = (1,)) -> DataFrame:
    """Gaussian mutual information of the series and itself ``k`` positions later."""
    return led.groupBy(*KEYS).agg(*[
        _information(pearson(F.col("x"), F.col(f"x{k}"))).alias(f"in_automutualinfo_auto_mutual_{k}")
        for k in delays])


def mutual_information_at_zero(led: DataFrame) -> DataFrame:
    """Gaussian mutual information at the window's own lag, from rows with ``xtau`` (``own_lag_leads``)."""
    return led.groupBy(*KEYS).agg(F.max("tau").alias("tau"), _information(pearson(F.col("x"), F.col("xtau"))).alias("in_automutualinfo_tau"))


def embedding_density(led: DataFrame, tau: int | str = 5, scale: float = 1.0) -> DataFrame:
    """Shares of points near diagonals, parabolas, rings and discs in the plane (x[j], x[j + tau]).

    ``tau="tau"`` takes the window's own lag, from ``own_lag_leads``.
    """
    d = led.select(*KEYS, "x", F.col(f"x{tau}").alias("z")).where(F.col("z").isNotNull())
    x, z = F.col("x"), F.col("z")
    r2 = x * x + z * z
    s = float(scale)
    near = {"updiag01": (z - x, 1), "updiag05": (z - x, 5),
            "downdiag01": (z + x, 1), "downdiag05": (z + x, 5)}
    for name, off in (("", 0), ("_1", 1), ("_n1", -1)):
        for size in (1, 5):
            near[f"parabup0{size}{name}"] = (z - (x * x + off), size)
            near[f"parabdown0{size}{name}"] = (z + x * x - off, size)
    for size in (1, 2, 5):
        near[f"ring1_0{size}"] = (r2 - 1, size)
    discs = {"incircle_01": 1, "incircle_02": 2, "incircle_05": 5,
             "incircle_1": 10, "incircle_2": 20, "incircle_3": 30}
    m = d.groupBy(*KEYS).agg(
        *[share(F.abs(c) < size * s).alias(k) for k, (c, size) in near.items()],
        *[share(r2 < size * s).alias(k) for k, size in discs.items()])
    inside = F.sort_array(F.array(*discs))
    mean = V.mean_of(inside)
    return m.select(
        *KEYS, *[F.col(c).alias(f"co_embed2_{c}") for c in [*near, *discs]],
        div(F.col("updiag01"), F.col("downdiag01")).alias("co_embed2_ratdiag01"),
        div(F.col("updiag05"), F.col("downdiag05")).alias("co_embed2_ratdiag05"),
        ((inside[2] + inside[3]) / 2).alias("co_embed2_medianincircle"),
        (V.std_of(inside, mean) * F.sqrt(F.lit(6.0 / 5.0))).alias("co_embed2_stdincircle"))


def crinkle_and_q(led: DataFrame) -> DataFrame:
    """Crinkle statistic (of the centred series) and Theiler's Q (not centred); needs lags 1 and 2."""
    bend = "(2 * x1 - x - x2)"  # a shift of the series does not change it
    pair = "(x + x1)"
    return led.groupBy(*KEYS).agg(
        F.expr(f"coalesce(try_divide(avg({bend} * {bend} * {bend} * {bend}), var_pop(x) * var_pop(x)), 0D)").alias(
            "dk_crinkle"),
        F.expr(f"coalesce(try_divide(avg({pair} * {pair} * {pair}), avg(x * x) * sqrt(avg(x * x))), 0D)").alias(
            "dk_theilerq"))


def embed(o: DataFrame, tau: int = 1, m: int = 2) -> DataFrame:
    """Delay embedding: ``e0..e{m-1}`` are the values 0, tau, 2 tau, ... positions later."""
    d = o.select(*KEYS, "i", *[F.lead("x", k * tau).over(by("i")).alias(f"e{k}") for k in range(m)])
    return d.where(F.col(f"e{m - 1}").isNotNull())


def buffers(o: DataFrame, size: int) -> DataFrame:
    """Cuts each window into full buffers: adds ``b`` (buffer) and ``j`` (place in it)."""
    n = F.count("*").over(per())
    return o.withColumn("full", F.floor(n / size) * size).where("i < full").select(
        *KEYS, F.floor(F.col("i") / size).alias("b"), (F.col("i") % size).alias("j"), "x")


def sign_changes(led: DataFrame) -> DataFrame:
    """Number of neighbours of opposite sign."""
    return led.groupBy(*KEYS).agg(F.count_if(F.col("x") * F.col("x1") < 0).alias("sign_changes"))


def is_zscored(b: DataFrame, tolerance: float = 2.2204e-16) -> DataFrame:
    """Whether a window already has mean 0 and deviation 1."""
    return b.select(*KEYS, ((F.abs("mu") < tolerance) & (F.abs(F.col("sd") - 1) < tolerance)).alias(
        "is_zscored"))
