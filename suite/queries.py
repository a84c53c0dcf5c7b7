"""Every registered query: the Spark side next to its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import names as N
from pulsegrid.functions import vectors as V
from pulsegrid.functions.vectors import vectors
from pulsegrid.operators import density, dependence, distribution, entropy, lags, provenance, symbolic, table, trend
from pulsegrid.plans import windows as W
from pulsegrid.plans.leads import own_lag_leads, series_leads, window_leads
from pulsegrid.plans.features import DISTRIBUTION_GROUPS, GROUPS, correlate, features
from pulsegrid.plans.staging import shared_folder
from pulsegrid.sources import digest, series
from pulsegrid.streaming.windows import run_available, streaming_features
from suite import oracle as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLAIN: dict[str, Query] = {}  # the same without the rounding that the comparison needs
ORACLES: dict[str, str] = {}

DAY = 86400
CROWDED_CHUNK = 600.0  # seconds; five event types share all rows, so their pieces must be short


def tidy(df: DataFrame, keys: tuple[str, ...] = ("series", "w")) -> DataFrame:
    """Numbers as rounded DOUBLE; keys, text and booleans as they are."""
    out = []
    for f in df.schema:
        name = f"`{f.name}`"
        plain = f.name in keys or f.dataType.typeName() in ("string", "boolean")
        out.append(name if plain else f"{S.stable(f'CAST({name} AS DOUBLE)', '1.00000000123D')} AS {name}")
    return df.selectExpr(*out)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def points(spark: SparkSession, sf: str, kind: str = "user") -> DataFrame:
    if kind in ("supplier", "tied"):  # many lines of a supplier ship on one day
        items = spark.read.parquet(f"{sf}/lineitem.parquet")
        if kind == "tied":
            items = items.withColumn("l_extendedprice", F.when(F.col("l_orderkey") % 17 != 0, F.col("l_extendedprice")))
        return series.points_from(items, "l_suppkey", "l_shipdate", "l_extendedprice")
    ev = events(spark, sf)
    value = {"gappy": F.when(F.col("event_id") % 17 != 0, F.col("value")), "centred": F.col("value") - 50,
             "scaled": F.col("value") / 50 - 1}.get(kind, F.col("value"))
    return series.points_from(ev.withColumn("value", value), "event_type" if kind == "type" else "user_id",
                              "ts", "value")


def win(spark: SparkSession, sf: str, kind: str = "user", span=None) -> DataFrame:
    return W.windowed(points(spark, sf, kind), *(span or S.SPANS[kind]), impute=kind == "gappy")


def add(name: str, sql: str, run: Query, keys: tuple[str, ...] = ("series", "w")) -> None:
    PLAIN[name] = run
    QUERIES[name] = lambda spark, sf: tidy(run(spark, sf), keys)
    ORACLES[name] = sql


def on_rows(name: str, sql: str, build, kind: str = "user", keys=("series", "w")) -> None:
    """Operator over the readings."""
    add(name, sql, lambda spark, sf: build(W.observed(win(spark, sf, kind))), keys)


def on_ordered(name: str, sql: str, build, kind: str = "user", keys=("series", "w"), span=None) -> None:
    """Operator over the filled, ordered values."""
    add(name, sql, lambda spark, sf: build(W.ordered(win(spark, sf, kind, span))), keys)


def on_leads(name: str, sql: str, build, lags, kind: str = "user") -> None:
    """Lag operator, looking ahead inside each window."""
    on_ordered(name, sql, lambda o: build(window_leads(o, lags)), kind)


def on_series_leads(name: str, sql: str, build, lags, kind: str = "type") -> None:
    """Lag operator over crowded windows, looking ahead in the series."""
    add(name, sql, lambda s, d: build(series_leads(
        points(s, d, kind), *S.SPANS[kind], lags, impute=kind == "gappy", chunk=CROWDED_CHUNK if kind == "type" else None)))


def on_vectors(name: str, sql: str, build, kind: str = "user") -> None:
    """Operator over windows held as arrays."""
    on_ordered(name, sql, lambda o: build(vectors(o)), kind)


def _windows_and_gates() -> None:
    add("window_spine", S.spine(), lambda s, d: W.window_spine(points(s, d), *S.SPANS["user"]))
    add("window_spine_by_type", S.spine("type"), lambda s, d: W.window_spine(points(s, d, "type"), *S.SPANS["type"]))
    add("window_rows", S.window_rows(), lambda s, d: win(s, d))
    add("window_rows_by_type", S.window_rows("type"), lambda s, d: win(s, d, "type"))
    add("window_rows_carried", S.window_rows("gappy"), lambda s, d: win(s, d, "gappy"))
    add("window_positions", S.ordered_rows(), lambda s, d: W.ordered(win(s, d, "gappy")).select("series", "w", "i", "t", "x"))
    add("carry_forward", S.carried(), lambda s, d: W.carry_forward(points(s, d, "gappy"), 3 * DAY), ("series",))
    for chunk in (30, 3000):  # in days
        add(f"carry_forward_ties_{chunk}", S.carried("tied"), lambda s, d, chunk=chunk: W.carry_forward(points(s, d, "tied"), chunk * DAY),
            ("series",))
    add("observation_count", S.observations(), lambda s, d: distribution.observation_count(win(s, d, "gappy")))
    always = {"dn_mean": ("mu", True), "dn_std": ("sd", True), "dn_median": ("med", True)}
    late = {"dn_quantile_90": ("q90", False), "dn_cv_1": ("sd / nullif(mu, 0)", False)}
    short = (3 * DAY, DAY)  # about seven readings: many windows stop at the observation gate
    add("observation_gate", S.gated(always | late, "gappy", short), lambda s, d: features(
        points(s, d, "gappy"), *short, groups=["summary"],
        select=["DN_Mean", "DN_std", "DN_Median", "DN_Quantile_90", "DN_cv 1"]))
    flat = "SELECT series, t, CASE WHEN hash_even THEN 5.0 ELSE y END AS y FROM (SELECT CAST(user_id AS VARCHAR) AS series, epoch_us(ts) / 1e6 AS t, value AS y, user_id % 2 = 0 AS hash_even FROM events)"
    add("constant_gate", S.gated(always | late, "user", S.SPANS["user"], flat), lambda s, d: features(
        points(s, d).withColumn("y", F.when(F.col("series").cast("long") % 2 == 0, 5.0).otherwise(F.col("y"))),
        *S.SPANS["user"], groups=["summary"], impute=False,
        select=["DN_Mean", "DN_std", "DN_Median", "DN_Quantile_90", "DN_cv 1"]))
    add("feature_selection", S.gated({"dn_median": ("med", True)}, "user", S.SPANS["user"]), lambda s, d: features(
        points(s, d), *S.SPANS["user"], select=["DN_Median"], impute=False))
    published = S.gated({"dn_mean": ("mu", True), "dn_max": ("hi", True)}, "type", S.SPANS["type"])
    add("published_names",
        f'SELECT series, w, time, observations AS "Observations", dn_mean AS "DN_Mean", dn_max AS "DN_Max" FROM ({published})',
        lambda s, d: features(points(s, d, "type"), *S.SPANS["type"], select=["DN_Mean", "DN_Max"], impute=False,
                              published=True))
    plain = S.gated({"dn_mean": ("mu", True), "dn_std": ("sd", True), "dn_quantile_90": ("q90", False), "dn_cv_1": ("sd / nullif(mu, 0)", False)},
                    "type", S.SPANS["type"])
    add("plain_names", 'SELECT series, w, time, observations AS "Observations", dn_mean AS "mean", dn_std AS "std", dn_quantile_90 AS "Quantile 90", '
        f'dn_cv_1 AS "DN_cv 1" FROM ({plain})',
        lambda s, d: N.with_plain_names(features(points(s, d, "type"), *S.SPANS["type"], impute=False,
                                                 select=["DN_Mean", "DN_std", "DN_Quantile_90", "DN_cv 1"])))


DISTRIBUTION = {
    "dn_mean": ["dn_mean"], "dn_range": ["dn_range"], "dn_iqr": ["dn_iqr"], "dn_median": ["dn_median"],
    "dn_minmax": ["dn_max", "dn_min"],
    "dn_cumulants": ["dn_skew1", "dn_skew2", "dn_kurt1", "dn_kurt2", "dn_skew_unbiased", "dn_kurt_unbiased"],
    "dn_burstiness": ["dn_burstiness"], "dn_std": ["dn_std"],
    "dn_customskewness": ["dn_customskewness", "dn_customskewness_bowley"], "dn_nlogl_norm": ["dn_nlogl_norm"],
    "dn_quantile": [f"dn_quantile_{q}" for q in (50, 75, 90, 95, 99)], "dn_cv": ["dn_cv_1", "dn_cv_2", "dn_cv_3"],
}
DEVIATIONS = {
    "dn_withinp": ["dn_withinp_1", "dn_withinp_2", "dn_withinp_median_1", "dn_withinp_median_2"],
    "dn_moments": [f"dn_moment_{k}" for k in range(2, 7)], "dn_pleft": ["dn_pleft"],
    "dn_highlowmu": ["dn_highlowmu"], "dn_spread": ["dn_spread_mad", "dn__spread_mead"],
}
# these need quantiles; in the others the quantiles of ``base`` are pruned and only sums remain
RANKED = {"dn_iqr", "dn_median", "dn_customskewness", "dn_quantile", "dn_withinp", "dn_pleft", "dn_spread"}
QUANTILES_OF = {"dn_spread": ("med",)}  # what these read of them, where they are found one by one
COUNTED = {"dn_mode": ["dn_mode"], "dn_unique": ["dn_unique"], "en_shannonen": ["en_shannonentropy"]}


def _distribution() -> None:
    D = distribution
    for name, cols in DISTRIBUTION.items():
        on_rows(name, S.distribution(cols, "type"),
                lambda r, cols=cols, big=name in RANKED: D.summary(D.base(r, large=big)).select("series", "w", *cols), "type")
    for name, cols in DEVIATIONS.items():
        on_rows(name, S.distribution(cols, "type"),
                lambda r, cols=cols, big=name in RANKED, qs=QUANTILES_OF.get(name): D.deviations(
                    r, D.base(r, large=big, quantiles=qs), large=big, only=cols).select("series", "w", *cols), "type")
    for name, cols in COUNTED.items():
        on_rows(name, S.value_counts(cols, "type"),
                lambda r, cols=cols: D.value_counts(r).select("series", "w", *cols), "type")
    on_rows("dn_trimmedmean", S.trimmed(), D.trimmed_means)
    on_rows("dn_trimmedmean_by_type", S.trimmed("type"), D.large_trimmed_means, "type")
    cols = ["dn_proportion_zeros", "dn_proportion_positive", "dn_proportion_negative"]
    on_rows("dn_proportionvalues", S.distribution(cols, "centred"), D.proportions, "centred")
    on_rows("dn_fit_mle", S.distribution(["dn_fit_mle_mean", "dn_fit_mle_std"]), lambda r: D.gaussian_fit(D.base(r)))
    cols = ["dn_mean", "dn_median", "dn_std", "dn_range"]
    on_rows("dn_present_values_only", S.distribution(cols, "gappy"),
            lambda r: D.summary(D.base(r)).select("series", "w", *cols), "gappy")
    for how, p in (("absfar", 0.5), ("absclose", 0.6), ("min", 0.1), ("max", 0.1)):
        on_rows(f"dn_removepoints_{how}", S.remove_points(how, p, "dn_removepoints_", kind="centred"),
                lambda r, how=how, p=p: D.remove_points(r, how, p), "centred")
    on_rows("dn_removepoints_absfar_by_type", S.remove_points("absfar", 0.5, "dn_removepoints_", kind="type"),
            lambda r: D.large_remove_points(r, "absfar", 0.5), "type")
    for how in ("abs", "p", "n"):
        on_ordered(f"dn_outlierinclude_{how}", S.outliers(how, 0.01), lambda o, how=how: D.outlier_thresholds(o, how))


def _dependence() -> None:
    C = dependence
    wide = range(1, 26)
    on_leads("co_autocorr", S.autocorrelation(), C.autocorrelation, wide)
    on_leads("co_autocorr_filled", S.autocorrelation(kind="gappy"), C.autocorrelation, wide, "gappy")
    on_series_leads("co_autocorr_by_type", S.autocorrelation(kind="type"),
                    lambda l: C.autocorrelation(l, exact_centre=False), wide)
    on_series_leads("co_autocorr_filled_ahead", S.autocorrelation(kind="gappy"),
                    lambda l: C.autocorrelation(l, exact_centre=False), wide, "gappy")
    on_series_leads("co_autocorr_slices", S.slice_correlation(kind="type"), C.slice_correlation, range(1, 6))
    on_leads("sub_acf", S.autocorrelation(range(1, 9)), lambda l: C.autocorrelation(l, range(1, 9)), range(1, 9))
    for name in ("co_firstzero", "co_firstmin", "co_f1ecac"):
        on_ordered(name, S.first_lags([name]), lambda o, name=name: lags.first_lags(o, [name]))
        on_ordered(f"{name}_by_type", S.first_lags([name], "type"), lambda o, name=name: lags.first_lags(o, [name]), "type")
    on_ordered("co_firstmin_mi", S.first_minimum_mi(), lambda o: lags.first_lags(o, ["co_firstmin_mi"]))
    at_own_lag = lambda o, times=1, lag="co_firstzero": own_lag_leads(o, lags.first_lags(o, [lag]), lag, times)
    glscf = [f"co_glscf_{a}_{b}" for a in range(1, 5) for b in range(1, 5)]
    on_ordered("co_glscf", S.lagged_products(glscf), lambda o: C.lagged_products(at_own_lag(o, 2)).select("series", "w", *glscf))
    both = ["co_tc3", "co_trev"]
    on_ordered("co_tc3_trev", S.lagged_products(both), lambda o: C.lagged_products(at_own_lag(o, 2)).select("series", "w", *both))
    on_ordered("co_tc3_trev_mi", S.lagged_products_mi(both), lambda o: C.lagged_products(
        at_own_lag(o, 2, "co_firstmin_mi")).select("series", "w", *both))
    on_series_leads("in_automutualinfo", S.mutual_information([1, 2, 3], "type"),
                    lambda l: C.mutual_information(l, [1, 2, 3]), [1, 2, 3])
    on_ordered("in_automutualinfo_tau", S.mutual_information_tau(), lambda o: C.mutual_information_at_zero(at_own_lag(o)))
    on_series_leads("co_embed2_basic", S.embedding(), C.embedding_density, [5], "scaled")
    on_ordered("co_embed2_tau", S.embedding_tau(), lambda o: C.embedding_density(at_own_lag(o), "tau"), "scaled")
    on_series_leads("dk_crinkle_theilerq", S.crinkle("type"), C.crinkle_and_q, [1, 2])
    on_ordered("bf_embed", S.tidy(["i", "e0", "e1", "e2"], "SELECT a.series, a.w, a.i, a.x AS e0, b.x AS e1, c.x AS e2 "
               "FROM o a JOIN o b ON a.series = b.series AND a.w = b.w AND b.i = a.i + 2 "
               "JOIN o c ON a.series = c.series AND a.w = c.w AND c.i = a.i + 4", S.windows()),
               lambda o: C.embed(o, 2, 3))
    on_ordered("bf_makebuffer", S.tidy(["b", "j", "x"], "SELECT series, w, i // 7 AS b, i % 7 AS j, x FROM o "
               "JOIN st USING (series, w) WHERE i < n // 7 * 7", S.windows()), lambda o: C.buffers(o, 7))
    on_leads("bf_sgnchange", S.tidy(["sign_changes"], "SELECT series, w, count(*) FILTER (WHERE s < 0) AS sign_changes "
               "FROM (SELECT series, w, x * lag(x) OVER (PARTITION BY series, w ORDER BY i) AS s FROM o) GROUP BY series, w",
               S.windows("centred")), C.sign_changes, [1], "centred")
    on_ordered("bf_iszscored", f"WITH RECURSIVE {S.windows()} SELECT series, w, abs(mu) < 2.2204e-16 AND abs(sd - 1) < 2.2204e-16 "
               "AS is_zscored FROM st", lambda o: C.is_zscored(distribution.base(o)))


def _entropy() -> None:
    E = entropy
    on_ordered("en_apen", S.apen(), E.approximate_entropy)
    on_ordered("en_sampen", S.sampen(), E.sample_entropy)
    on_ordered("en_sampen_by_type", S.sampen("type"), E.sample_entropy, "type")
    on_ordered("en_sampen_absolute", S.sampen(rth=6.5, absolute=True), lambda o: E.sample_entropy(o, rth=6.5, absolute=True))
    on_ordered("en_mse_scales", S.mse_scales(), lambda o: E.multiscale_entropy(o)[0], "supplier", ("series", "w", "scale"))
    on_ordered("en_mse", S.mse(), lambda o: E.multiscale_entropy(o)[1], "supplier")
    on_series_leads("en_permen_2_1", S.permen(2, 1, "type"), lambda l: E.permutation_entropy(l, 2, 1), [1])
    on_series_leads("en_permen_3_6", S.permen(3, 6, "type"), lambda l: E.permutation_entropy(l, 3, 6), [6, 12])
    on_ordered("en_cid", S.cid(), E.complexity_invariant)
    on_ordered("bf_binarize", S.binarized(), lambda o: symbolic.binarize(o).drop("n"), keys=("series", "w", "method"))
    on_ordered("sb_binarystats", S.binary_stats(), symbolic.binary_stats)
    on_series_leads("sb_motiftwo", S.motifs("type"), symbolic.motifs, range(1, 5))
    for how in ("mean", "median", "iqr"):
        on_ordered(f"sb_motiftwo_{how}", S.motifs(how=how), lambda o, how=how: symbolic.motifs_of(o, how))


def _trend() -> None:
    T = trend
    on_ordered("sy_trend", S.trend(), T.trend)
    on_ordered("sy_statav", S.segment_means(), T.segment_means)
    on_ordered("sy_driftingmean", S.drifting_mean(), T.drifting_mean)
    long = (6 * DAY, 3 * DAY)
    on_ordered("sy_driftingmean_fix", S.drifting_mean("200", "type", long), lambda o: T.drifting_mean(o, "fix"), "type", span=long)
    on_ordered("sy_driftingmean_parts", S.drifting_mean("(n // 3)"), lambda o: T.drifting_mean(o, "num", 3))
    on_vectors("ex_movingthreshold", S.moving_threshold(), T.moving_threshold)
    on_vectors("ex_movingthreshold_by_type", S.moving_threshold("type"), T.moving_threshold, "type")
    on_ordered("sc_hurstexp", S.hurst(), T.hurst_exponent)
    on_ordered("sc_dfa", S.dfa("sc_dfa", "t >= 5 AND t <= n // 2"), T.detrended_fluctuation)
    sizes = T.power_sizes()
    on_ordered("dfa_power_sizes", S.dfa("dfa", f"t IN ({', '.join(map(str, sizes))})", "supplier"),
               lambda o: T.detrended_fluctuation(o, sizes, "dfa", F.log2), "supplier")
    on_ordered("dfa_power_sizes_by_type", S.dfa("dfa", f"t IN ({', '.join(map(str, sizes))})", "type"),
               lambda o: T.large_fluctuation(o, sizes, "dfa", F.log2), "type")
    on_vectors("dt_isseasonal", S.seasonal(), density.seasonal)
    on_vectors("dt_isseasonal_by_type", S.seasonal("type"), density.seasonal, "type")
    for dist in ("norm", "uni", "beta"):
        on_vectors(f"dn_compareksfit_{dist}", S.compare_fit(dist), lambda v, dist=dist: density.compare_fit(v, dist))
        on_ordered(f"dn_compareksfit_{dist}_by_type", S.compare_fit(dist, "type"),
                   lambda o, dist=dist: density.large_compare_fit(o, dist), "type")
    on_ordered("dn_fitkernalsmooth_by_type", S.kernel_shape("type"),
               lambda o: density.large_kernel_shape(o, (0.005,), (0.005,), (20.0,)), "type")
    on_vectors("dn_fitkernalsmooth", S.kernel_shape(), lambda v: density.kernel_shape(v, (0.005,), (0.005,), (20.0,)))


def small_table(spark: SparkSession, sf: str) -> DataFrame:
    """A few features per window, a constant column, a column that is not finite in some windows, a boolean."""
    cols = list(S.TABLE_COLS)
    rows = W.observed(win(spark, sf, "type"))
    ft = distribution.summary(distribution.base(rows)).select("series", "w", *cols)
    return W.per_window(W.window_spine(points(spark, sf, "type"), *S.SPANS["type"]), ft).where(
        "dn_mean is not null").withColumns({
            "dead": F.lit(1.0),
            "ratio": F.when(F.col("w") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("dn_std") / F.col("dn_mean")),
            "isseasonal": F.col("dn_std") > F.col("dn_mean")})


def _table() -> None:
    cols = list(S.TABLE_COLS)
    every = cols + ["dead", "ratio"]
    add("table_drop_columns", S.table_query(every, "SELECT * FROM ft"), lambda s, d: table.drop_features(small_table(s, d)))
    add("table_drop_dead_column", S.table_query(cols + ["ratio"], "SELECT * FROM ft"), lambda s, d: table.drop_features(
        small_table(s, d), ("time", "isseasonal", "dead")))

    def as_text(s, d):
        text = small_table(s, d).select(*[F.col(c).cast("string").alias(c) for c in ["w", *every, "isseasonal"]])
        return series.as_numbers(text.withColumn("note", F.concat(F.lit("window "), F.col("w"))))

    add("table_numeric_columns", S.table_query(["w", *every], "SELECT * FROM ft", keys=()), as_text, ())
    add("table_varying_columns", S.table_query(["time", *cols], "SELECT * FROM ft"), lambda s, d: table.keep_varying(
        small_table(s, d).drop("ratio", "isseasonal")))
    add("table_finite_rows", S.table_query(["time", *every], "SELECT * FROM ft WHERE ratio < 'inf'::DOUBLE"),
        lambda s, d: table.keep_finite(small_table(s, d).drop("isseasonal")))
    add("table_correlation", S.correlations(cols, "TRUE"), lambda s, d: table.correlation(
        small_table(s, d).select("series", "w", *cols)), ("f1", "f2"))
    holes = {c: 2 + i for i, c in enumerate(cols)}  # every column lacks other windows
    with_holes = ", ".join(f"CASE WHEN w % {k} <> 1 THEN {c} END AS {c}" for c, k in holes.items())
    add("table_correlation_nulls", S.correlations(cols, "TRUE", "fh").replace(", lg AS (", f", fh AS (SELECT series, w, {with_holes} FROM ft), lg AS (", 1),
        lambda s, d: table.correlation(small_table(s, d).select("series", "w", *[
            F.when(F.col("w") % k != 1, F.col(c)).alias(c) for c, k in holes.items()])), ("f1", "f2"))
    norm = ", ".join(f"({c} - avg({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0) AS {c}" for c in cols + ["dead"])
    add("table_normalise", S.table_query(["time", *cols, "dead"], f"SELECT series, w, time, {norm} FROM ft"),
        lambda s, d: table.normalise(small_table(s, d).drop("ratio", "isseasonal")))
    add("table_hours", S.table_query(
        ["time", "hour", "label"], "SELECT series, w, time, time / 3600 AS hour, round(h0 + least(floor((time / 3600 - h0) / sz), 45) * sz) AS label "
        "FROM ft, (SELECT min(time) / 3600 AS h0, (max(time) / 3600 - min(time) / 3600) / 46 AS sz FROM ft)"),
        lambda s, d: table.hours(small_table(s, d).select("series", "w", "time")))
    union = " UNION ALL ".join(f"SELECT series, w, '{c}' AS feature, {c} AS value FROM ft" for c in every)
    add("table_long_form", S.table_query(["value"], union, keys=("series", "w", "feature")),
        lambda s, d: table.long_form(small_table(s, d)), ("series", "w", "feature"))
    chain = ["dn_mean", "dn_range", "dn_iqr", "dn_median", "dn_max", "dn_min", "dn_kurt1", "dn_burstiness", "dn_std"]
    more = {"dn_range": "hi - lo", "dn_min": "lo", "dn_burstiness": "(sd / mu - 1) / (sd / mu + 1)"}
    ctes = S.correlations(chain, "obs > 10 AND dn_range IS NOT NULL", "f2").replace(
        ", lg AS (", ", f2 AS (SELECT s.series, s.w, " + ", ".join(
            f"{ {**S.TABLE_COLS, **more}[c] } AS {c}" for c in chain) + ", n AS obs FROM st s), lg AS (", 1)
    names = ["DN_Mean", "DN_Range", "DN_IQR", "DN_Median", "DN_Max", "DN_Min", "DN_kurt1", "DN_Burstiness", "DN_std"]
    with_obs = ctes.replace("lg AS (SELECT", "lg AS (SELECT series, w, 'observations' AS f, CAST(obs AS DOUBLE) AS v FROM f2 "
                            "WHERE obs > 10 UNION ALL SELECT", 1)
    add("feature_job_then_correlation", with_obs, lambda s, d: correlate(features(
        points(s, d, "type"), *S.SPANS["type"], groups=["summary"], select=names, impute=False)), ("f1", "f2"))


def part_sql(kind: str = "user") -> dict[str, str]:
    """Oracle of each feature group, over the same windows."""
    far, close = "dn_removepointsabsfar_0_6_", "dn_removepointsabsclose_0_6_"
    summary = [c for n in DISTRIBUTION for c in DISTRIBUTION[n] if "unbiased" not in c and "bowley" not in c]
    return {
        "summary": S.distribution(summary, kind),
        "deviations": S.distribution([c for n in DEVIATIONS for c in DEVIATIONS[n] if "median" not in c], kind),
        "values": S.value_counts(["dn_mode", "dn_unique", "en_shannonentropy"], kind), "trimmed": S.trimmed(kind),
        "removed": S.remove_points("absfar", 0.5, "dn_removepoints_", kind=kind),
        "autocorrelation": S.autocorrelation(kind=kind),
        "first_lags": S.first_lags(["co_f1ecac", "co_firstmin", "co_firstzero"], kind),
        "lagged": S.lagged_products([f"co_glscf_{a}_{b}" for a in range(1, 5) for b in range(1, 5)] + ["co_tc3", "co_trev"], kind),
        "fit": S.compare_fit("norm", kind), "season": S.seasonal(kind), "apen": S.apen(kind), "cid": S.cid(kind),
        "sampen": S.sampen(kind), "information": S.mutual_information([1], kind), "trend": S.trend(kind),
        "removed_far": S.remove_points("absfar", 0.6, far, "o", kind),
        "removed_close": S.remove_points("absclose", 0.6, close, "o", kind), "crinkle": S.crinkle(kind),
        "motifs": S.motifs(kind), "binary": S.binary_stats(kind), "threshold": S.moving_threshold(kind),
        "drift": S.drifting_mean(kind=kind),
    }


def _jobs() -> None:
    start = S.gated({}, "user", S.SPANS["user"])
    parts = part_sql()
    some = [N.slug(n) for n in N.distribution_names()]
    add("feature_table_distribution", S.joined([parts[g] for g in DISTRIBUTION_GROUPS], start,
        ["series", "w", "time", "observations", *some]), lambda s, d: features(
        points(s, d), *S.SPANS["user"], groups=DISTRIBUTION_GROUPS, impute=False))
    every = [N.slug(n) for n in N.published_names()]
    add("feature_table", S.joined([parts[g] for g in GROUPS], start, ["series", "w", "time", *every]),
        lambda s, d: features(points(s, d), *S.SPANS["user"], impute=False, stage=True))


def _sources() -> None:
    def csv_job(name, sid, order, pattern, sql):
        def run(s, d):
            path = shared_folder(s)
            first, second = ("value", "time") if order == "value_time" else ("time", "value")
            ev = series.points_from(events(s, d).withColumn("sid", sid()), "sid", "ts", "value")
            ev.select(F.col("series").alias("file"), F.col("y" if first == "value" else "t").alias(first),
                      F.col("y" if second == "value" else "t").alias(second)).write.partitionBy("file").option(
                "header", "true").csv(path)
            return series.repair(series.read_series_csv(s, f"{path}/*/*.csv", order, True, pattern), 3 * DAY)

        add(name, f"WITH res AS ({sql}) SELECT series, {S.stable('t')} AS t, {S.stable('y')} AS y FROM res", run, ("series",))

    csv_job("csv_series", lambda: F.col("event_type"), "value_time", r"file=([^/]+)/",
            "SELECT event_type AS series, epoch_us(ts) / 1e6 AS t, value AS y FROM events")
    patient = lambda: F.concat(F.lit("P"), F.lpad((F.col("user_id") % 25).cast("string"), 4, "0"))
    csv_job("csv_patient_files", patient, "time_value", r"file=P(\d{4})",
            "SELECT lpad(CAST(user_id % 25 AS VARCHAR), 4, '0') AS series, epoch_us(ts) / 1e6 AS t, value AS y FROM events")

    def damaged(s, d):
        ev = events(s, d)
        text = F.when(F.col("event_id") % 29 == 0, "bad cell").when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(
            F.col("value").cast("string"))
        raw = ev.select(F.col("user_id").cast("string").alias("series"), text.alias("value"),
                        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("string").alias("time"))
        return series.repair(raw, 3 * DAY)

    add("bad_cell_repair", f"""WITH tx AS (SELECT CAST(user_id AS VARCHAR) AS series, epoch_us(ts) / 1e6 AS t,
  CASE WHEN event_id % 29 = 0 THEN 'bad cell' WHEN event_id % 17 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS v FROM events),
ty AS (SELECT series, t, v, try_cast(v AS DOUBLE) AS n, last_value(try_cast(v AS DOUBLE) IGNORE NULLS) OVER (
  PARTITION BY series ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM tx),
res AS (SELECT series, t, CASE WHEN v IS NOT NULL AND n IS NULL THEN held ELSE n END AS y FROM ty)
SELECT series, {S.stable('t')} AS t, {S.stable('y')} AS y FROM res""", damaged, ("series",))

    def damaged_ties(s, d):
        items = s.read.parquet(f"{d}/lineitem.parquet")
        text = F.when(F.col("l_orderkey") % 29 == 0, "bad cell").when(F.col("l_orderkey") % 17 == 0, F.lit(None)).otherwise(
            F.col("l_extendedprice").cast("string"))
        raw = items.select(F.col("l_suppkey").cast("string").alias("series"), text.alias("value"),
                           (F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1e6).cast("string").alias("time"))
        return series.repair(raw, 30 * DAY)

    add("bad_cell_repair_ties", f"""WITH tx AS (SELECT CAST(l_suppkey AS VARCHAR) AS series, epoch_us(l_shipdate) / 1e6 AS t,
  CASE WHEN l_orderkey % 29 = 0 THEN 'bad cell' WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_extendedprice AS VARCHAR) END AS v FROM lineitem),
ty AS (SELECT series, t, v, try_cast(v AS DOUBLE) AS n, last_value(try_cast(v AS DOUBLE) IGNORE NULLS) OVER (
  PARTITION BY series ORDER BY t, try_cast(v AS DOUBLE) NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM tx),
res AS (SELECT series, t, CASE WHEN v IS NOT NULL AND n IS NULL THEN held ELSE n END AS y FROM ty)
SELECT series, {S.stable('t')} AS t, {S.stable('y')} AS y FROM res""", damaged_ties, ("series",))

    def sink(s, d):
        path = shared_folder(s)
        series.write_features(small_table(s, d).drop("isseasonal"), path, partition_by=["series"])
        return s.read.parquet(path)

    add("feature_sink_parquet", S.table_query(["time", *S.TABLE_COLS, "dead", "ratio"], "SELECT * FROM ft"), sink)

    def sink_csv(s, d):
        path = shared_folder(s)
        series.write_features(small_table(s, d).withColumn("note", F.lit("text")).drop("series"), path, "csv")
        return series.read_feature_csv(s, path)

    add("feature_sink_csv", S.table_query(["w", "time", *S.TABLE_COLS, "dead", "ratio"], "SELECT * FROM ft", keys=()),
        sink_csv, ())


def _records() -> None:
    add("digest_manifest", "SELECT CAST(doc_id AS VARCHAR) AS item, sha256(text) AS sha256, "
        "CAST(strlen(text) AS DOUBLE) AS bytes FROM documents",
        lambda s, d: digest.digests(s.read.parquet(f"{d}/documents.parquet"), "doc_id", "text"), ("item",))

    def of_files(s, d):  # a file per supplier
        path = shared_folder(s)
        texts = s.read.parquet(f"{d}/supplier.parquet").select(F.concat(F.lit("s_suppkey="), F.coalesce(F.col("s_suppkey").cast("string"), F.lit("")),
                                                                        F.lit(".txt")).alias("name"), F.col("s_name").alias("line"))
        digest.write_files(texts, path)
        return digest.file_digests(s, f"{path}/*").withColumn("item", F.regexp_extract("item", "s_suppkey=([0-9]+)", 1))

    add("file_digests", "SELECT CAST(s_suppkey AS VARCHAR) AS item, sha256(s_name || chr(10)) AS sha256, "
        "CAST(strlen(s_name) + 1 AS DOUBLE) AS bytes FROM supplier", of_files, ("item",))

    def compare(s, d):
        docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
        new = docs.where("doc_id % 11 <> 0").withColumn(
            "text", F.when(F.col("doc_id") % 13 == 0, F.upper("text")).otherwise(F.col("text")))
        return digest.compare_digests(digest.digests(docs, "doc_id", "text"), digest.digests(new, "doc_id", "text"))

    add("digest_compare", """WITH a AS (SELECT doc_id, sha256(text) AS h FROM documents),
b AS (SELECT doc_id, sha256(CASE WHEN doc_id % 13 = 0 THEN upper(text) ELSE text END) AS h FROM documents WHERE doc_id % 11 <> 0)
SELECT CAST(a.doc_id AS VARCHAR) AS item, CASE WHEN b.h IS NULL THEN 'missing' ELSE 'changed' END AS status
FROM a LEFT JOIN b USING (doc_id) WHERE b.h IS NULL OR a.h <> b.h""", compare, ("item",))

    def closure(s, d):
        read = lambda t: s.read.parquet(f"{d}/{t}.parquet")
        def edge(t, a, ac, b, bc):
            return read(t).select(F.concat(F.lit(a), F.col(ac)).alias("src"), F.concat(F.lit(b), F.col(bc)).alias("dst"))
        edges = (edge("orders", "order ", "o_orderkey", "customer ", "o_custkey")
                 .unionByName(edge("lineitem", "order ", "l_orderkey", "supplier ", "l_suppkey"))
                 .unionByName(edge("customer", "customer ", "c_custkey", "nation ", "c_nationkey"))
                 .unionByName(edge("supplier", "supplier ", "s_suppkey", "nation ", "s_nationkey"))
                 .unionByName(edge("nation", "nation ", "n_nationkey", "region ", "n_regionkey")))
        starts = read("orders").select(F.concat(F.lit("order "), F.col("o_orderkey")).alias("start"))
        return provenance.supports(edges, starts)

    add("provenance_closure", """WITH RECURSIVE e AS (
  SELECT 'order ' || o_orderkey AS src, 'customer ' || o_custkey AS dst FROM orders
  UNION SELECT 'order ' || l_orderkey, 'supplier ' || l_suppkey FROM lineitem
  UNION SELECT 'customer ' || c_custkey, 'nation ' || c_nationkey FROM customer
  UNION SELECT 'supplier ' || s_suppkey, 'nation ' || s_nationkey FROM supplier
  UNION SELECT 'nation ' || n_nationkey, 'region ' || n_regionkey FROM nation),
r AS (SELECT 'order ' || o_orderkey AS start, 'order ' || o_orderkey AS item, 0 AS depth FROM orders
  UNION SELECT r.start, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.item)
SELECT start, item, CAST(min(depth) AS DOUBLE) AS depth FROM r WHERE depth > 0 GROUP BY start, item""",
        closure, ("start", "item"))


def _streaming() -> None:
    span, step, late = 2 * DAY, DAY, 3600

    def run(s, d):
        schema = events(s, d).schema
        stream = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
        readings = stream.select(F.col("event_type").alias("series"), "ts", F.col("value").alias("y"))
        path = shared_folder(s)
        run_available(streaming_features(readings, f"{span} seconds", f"{step} seconds", f"{late} seconds"),
                      f"{path}/out", f"{path}/state")
        return s.read.parquet(f"{path}/out")

    exprs = {"start_us": "max(s0)", "end_us": "max(s0) + 172800000000", "observations": "count(y)", "dn_mean": "avg(y)",
             "dn_range": "max(y) - min(y)", "dn_max": "max(y)", "dn_min": "min(y)",
             "dn_skew1": "avg(pow(y - mu, 3)) / pow(avg(pow(y - mu, 2)), 1.5)", "dn_kurt1": "kurtosis_pop(y)",
             "dn_burstiness": "(stddev_pop(y) / avg(y) - 1) / (stddev_pop(y) / avg(y) + 1)", "dn_std": "stddev_pop(y)",
             "dn_cv_1": "stddev_pop(y) / avg(y)"}
    ctes = f"""ev AS (SELECT event_type AS series, epoch_us(ts) AS us, value AS y FROM events),
wi AS (SELECT series, us, y, (us // {step * 10**6} - k) * {step * 10**6} AS s0 FROM ev, (SELECT unnest([0, 1]) AS k)),
wm AS (SELECT *, avg(y) OVER (PARTITION BY series, s0) AS mu FROM wi),
res AS (SELECT series, {', '.join(f'{e} AS {c}' for c, e in exprs.items())} FROM wm GROUP BY series, s0
  HAVING s0 + {span * 10**6} <= (SELECT max(us) FROM ev) - {late * 10**6})"""
    cols = ", ".join(f"{S.stable(c)} AS {c}" for c in exprs)
    add("streaming_windows", f"WITH {ctes} SELECT series, {cols} FROM res", run, ("series",))


for register in (_windows_and_gates, _distribution, _dependence, _entropy, _trend, _table, _jobs, _sources, _records,
                 _streaming):
    register()
