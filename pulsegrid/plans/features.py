"""The feature job: points in, one row of features per window out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import names as N
from pulsegrid.functions.expr import KEYS, combine
from pulsegrid.functions.vectors import vectors
from pulsegrid.operators import density, dependence, distribution, entropy, lags, symbolic, table, trend
from pulsegrid.plans.leads import own_lag_leads, series_leads, window_leads
from pulsegrid.plans.staging import staged
from pulsegrid.plans.windows import observed, ordered, window_spine, windowed

LEAST_READINGS = 10


def _groups(large: bool = False) -> dict:
    """Feature groups: name -> builder(rows, base, o, vec, led). A group is one aggregate over one grouping."""
    D, C, E, S, T = distribution, dependence, entropy, symbolic, trend
    remove_points = D.large_remove_points if large else D.remove_points
    return {
        "summary": lambda r, b, o, v, l: D.summary(b),
        "deviations": lambda r, b, o, v, l: D.deviations(r, b, large=large),
        "values": lambda r, b, o, v, l: D.value_counts(r),
        "trimmed": lambda r, b, o, v, l: (D.large_trimmed_means if large else D.trimmed_means)(r),
        "removed": lambda r, b, o, v, l: remove_points(r, "absfar", 0.5),
        "autocorrelation": lambda r, b, o, v, l: C.autocorrelation(l, exact_centre=not large),
        "first_lags": lambda r, b, o, v, l: lags.first_lags(o),
        "lagged": lambda r, b, o, v, l: C.lagged_products(own_lag_leads(o, lags.first_lags(o, ["co_firstzero"]), "co_firstzero", 2)),
        "fit": lambda r, b, o, v, l: density.large_compare_fit(o) if large else density.compare_fit(v),
        "season": lambda r, b, o, v, l: density.seasonal(v).drop("seasonal_r2"),
        "apen": lambda r, b, o, v, l: E.approximate_entropy(o),
        "cid": lambda r, b, o, v, l: E.complexity_invariant(o),
        "sampen": lambda r, b, o, v, l: E.sample_entropy(o),
        "information": lambda r, b, o, v, l: C.mutual_information(l),
        "trend": lambda r, b, o, v, l: T.trend(o),
        "removed_far": lambda r, b, o, v, l: remove_points(
            o, "absfar", 0.6, prefix="dn_removepointsabsfar_0_6_"),
        "removed_close": lambda r, b, o, v, l: remove_points(
            o, "absclose", 0.6, prefix="dn_removepointsabsclose_0_6_"),
        "crinkle": lambda r, b, o, v, l: C.crinkle_and_q(l),
        "motifs": lambda r, b, o, v, l: S.motifs(l),
        "binary": lambda r, b, o, v, l: S.binary_stats(o),
        "threshold": lambda r, b, o, v, l: T.moving_threshold(v),
        "drift": lambda r, b, o, v, l: T.drifting_mean(o),
    }


GROUPS = tuple(_groups())
DISTRIBUTION_GROUPS = GROUPS[:5]
# groups that read windows as arrays, and groups that read rows in order
FROM_ARRAYS = ("fit", "season", "threshold")
FROM_ORDER = ("autocorrelation", "apen", "cid", "sampen", "information", "trend", "removed_far", "removed_close", "crinkle",
              "motifs", "binary", "drift", "first_lags", "lagged", *FROM_ARRAYS)


def selected(select: list[str] | None) -> list[str]:
    """Columns for a list of operator or feature names; all default columns for None."""
    if select is None:
        return [N.slug(n) for n in N.published_names()]
    prefixes = tuple(p for s in select for p in N.OPERATOR_COLUMNS.get(s, (s,)))
    return ["observations", *[N.slug(n) for n in N.published_names()[1:] if n.startswith(prefixes)]]


def features(points: DataFrame, length: float = 600.0, step: float = 300.0,
             groups: tuple[str, ...] | list[str] = GROUPS, select: list[str] | None = None,
             impute: bool = True, published: bool = False, stage: bool = True, large: bool = False) -> DataFrame:
    """One row per window: ``series, w, time, observations`` and the chosen features.

    A window with at most one point has only its time; with at most ten readings only time and count; a
    constant one stops after the standard deviation. ``groups`` chooses what is computed, ``select`` keeps
    the columns of the named operators or features (groups without any of them are not built). Gates never depend on the choice.

    ``stage`` (the default) writes the windows, and what several groups share of them (ranks, arrays), once to the shared folder and computes every group from there. ``large`` is for
    crowded windows: quantiles are bracketed by sketches and lag operators look ahead in the series.
    """
    wanted = selected(select)
    if stage:
        points = staged(points)
    win = windowed(points, length, step, impute)
    if stage:
        win = staged(win)
    columns = {name: [c for c in N.group_columns(name) if c in wanted] for name in groups}
    several = lambda names: stage and sum(bool(columns.get(name)) for name in names) > 1
    rows, o = observed(win), ordered(win)
    if several(FROM_ORDER):  # ranked once
        o = staged(o)
    vec = vectors(o)
    if several(FROM_ARRAYS):
        vec = staged(vec)
    base = distribution.base(rows, large=large)
    ahead = range(1, 26)
    led = series_leads(points, length, step, ahead, impute) if large else window_leads(o, ahead)
    counts = win.groupBy(*KEYS).agg(
        F.count("*").alias("points"), F.count("y").alias("observations"), F.stddev_pop("y").alias("gate_sd"))
    builders = _groups(large)
    frames, known = [], ["observations"]
    for name, cols in columns.items():
        if cols:
            frames.append(builders[name](rows, base, o, vec, led).select(*KEYS, *cols))
            known += cols
    wide = combine([window_spine(points, length, step), counts, *frames])
    enough = f"points > 1 AND observations > {LEAST_READINGS}"
    always = {N.slug(n) for n in N.CONSTANT_WINDOW}

    def gated(c: str) -> str:
        if c == "observations":
            return "CASE WHEN points > 1 THEN observations END AS observations"
        return f"CASE WHEN {enough if c in always else enough + ' AND gate_sd > 0'} THEN {c} END AS {c}"

    out = wide.selectExpr(*KEYS, "w_end AS time", *[gated(c) for c in wanted if c in known])
    return N.with_published_names(out) if published else out


def correlate(feature_table: DataFrame, ids: tuple[str, ...] = ("series", "w")) -> DataFrame:
    """The second job: clean a feature table and take the absolute correlation of its columns.

    The table is staged first: column statistics and sums read it three times, the job that made it runs once.
    """
    feature_table = staged(feature_table)
    return table.correlation(table.clean(feature_table, ids), ids)
