"""Distribution features: order-free statistics of the readings in a window.

``rows`` is ``(series, w, t, x)``; rows with NULL ``x`` must be gone. Standard deviations are population
ones unless a name says otherwise, quantiles interpolate linearly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import vectors as V
from pulsegrid.functions.expr import KEYS, by, combine, div, per, share
from pulsegrid.operators import lags as L
from pulsegrid.plans.staging import staged

QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def base(rows: DataFrame, keys: list[str] = KEYS, large: bool = False, quantiles: tuple[str, ...] | None = None) -> DataFrame:
    """The per-window numbers many features start from; computed once and joined where needed.

    ``large`` is for windows whose distinct values may not fit the memory of one task: quantiles are then
    found by ``large_quantiles``, which finds no others than the named ``quantiles`` if given (the rest is NULL), and all else is
    merged from partial sums.
    """
    x = F.col("x")
    names = ("q25", "med", "q75", "q90", "q95", "q99")
    sums = [F.count(x).alias("n"), F.avg(x).alias("mu"), F.stddev_pop(x).alias("sd"),
            F.min(x).alias("lo"), F.max(x).alias("hi"),
            F.skewness(x).alias("skew"), F.kurtosis(x).alias("kurt")]
    plain = ["n", "mu", "sd", "lo", "hi", "skew", "kurt"]
    if large:
        wanted = {c: q for c, q in zip(names, QUANTILES) if quantiles is None or c in quantiles}
        found = large_quantiles(rows, wanted, keys)
        return rows.groupBy(*keys).agg(*sums).join(found, keys).select(
            *keys, *plain, *[c if c in wanted else F.lit(None).cast("double").alias(c) for c in names])
    agg = rows.groupBy(*keys).agg(*sums, F.percentile(x, F.array(*[F.lit(q) for q in QUANTILES])).alias("q"))
    return agg.select(*keys, *plain, *[F.col("q")[i].alias(c) for i, c in enumerate(names)])


def _order_statistics(rows: DataFrame, wanted: dict[str, tuple[float, Column]], keys: list[str],
                      accuracy: int) -> DataFrame:
    """``(keys, q, f, x0, x1)``: the values around the 0-based rank ``at(n)`` of each window, for windows of any size.

    ``wanted``: name -> (share of the rows below, rank as an expression of ``n``); the two may differ by
    one rank. A mergeable sketch brackets the share within a few parts in ``accuracy`` of the rows. Only the
    values inside a bracket are put in order; the rows below and above it are counted, and keep the one value next
    to the bracket, which a window smaller than ``accuracy`` may need (the sketch is then exact to one rank).
    """
    margin = 2.0 / accuracy
    sides = [v for p, _ in wanted.values() for v in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = rows.groupBy(*keys).agg(
        F.count("x").alias("n"),
        F.percentile_approx("x", F.array(*[F.lit(v) for v in sides]), accuracy).alias("v"))
    bands = F.array(*[F.struct(F.lit(name).alias("q"), at.cast("double").alias("at"), F.col("v")[2 * i].alias("a"),
                               F.col("v")[2 * i + 1].alias("b")) for i, (name, (_, at)) in enumerate(wanted.items())])
    near = rows.select(*keys, "x").join(sketch, keys).select(*keys, "x", F.inline(bands))
    x = F.col("x")
    side = F.when(x < F.col("a"), 0).when(x > F.col("b"), 2).otherwise(1)
    inside = F.when((x >= F.col("a")) & (x <= F.col("b")), x)
    counted = near.groupBy(*keys, "q", "at", side.alias("side"), inside.alias("inside")).agg(
        F.count("*").alias("c"), F.max("x").alias("top"), F.min("x").alias("low")).withColumn(
        "x", F.when(F.col("side") == 0, F.col("top")).otherwise(F.col("low")))
    order = by("side", "x", keys=keys + ["q"])
    upto_x = F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = F.col("at")
    lower, upper = F.floor(at), F.ceil(at)
    count_of = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("c"))), F.lit(0))
    held = counted.withColumn("upto", upto_x).groupBy(*keys, "q").agg(
        # of the values outside only the two next to the bracket are known
        ((F.max(lower) >= count_of(0) - 1) & (F.max(upper) <= count_of(0) + count_of(1))).alias("held"),
        F.max(at - lower).alias("f"),
        F.min(F.when(F.col("upto") > lower, F.col("x"))).alias("x0"),
        F.min(F.when(F.col("upto") > upper, F.col("x"))).alias("x1"))
    checked = F.when(F.col("held"), F.col("x0")).otherwise(F.raise_error(F.lit(
        "the sketch does not bracket the rank: raise accuracy")).cast("double"))
    return held.select(*keys, "q", "f", checked.alias("x0"), "x1")


def large_quantiles(rows: DataFrame, probs: dict[str, float], keys: list[str] = KEYS,
                    accuracy: int = 10000) -> DataFrame:
    """Exact interpolated quantiles of ``x`` for windows of any size, spread over many tasks."""
    picked = _order_statistics(rows, {q: (p, F.lit(p) * (F.col("n") - 1)) for q, p in probs.items()}, keys, accuracy)
    value = F.col("x0") + F.col("f") * (F.col("x1") - F.col("x0"))
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == q, value)).alias(q) for q in probs])


def large_trimmed_means(rows: DataFrame, shares: tuple[float, ...] = (0.5, 0.75, 0.25),
                        accuracy: int = 10000) -> DataFrame:
    """``trimmed_means`` for windows of any size.

    The cut-off values on both sides are found first; the values beyond them, and as many copies of them as
    the cut takes, are then subtracted from the sum.
    """
    n, x = F.col("n"), F.col("x")
    cuts = {p: F.bround(n * F.lit(p) / 2) for p in shares}
    wanted = {}
    for p, cut in cuts.items():
        wanted[f"lo{p}"] = (p / 2, F.greatest(cut - 1, F.lit(0)))
        wanted[f"hi{p}"] = (1 - p / 2, F.least(n - cut, n - 1))
    edges = _order_statistics(rows, wanted, KEYS, accuracy).groupBy(*KEYS).agg(
        *[F.max(F.when(F.col("q") == q, F.col("x0"))).alias(f"e{i}") for i, q in enumerate(wanted)])
    sums = [F.sum(x).alias("total"), F.count(x).alias("n")]
    for i in range(0, len(wanted), 2):
        lo, hi = F.col(f"e{i}"), F.col(f"e{i + 1}")
        sums += [F.max(lo).alias(f"lo{i}"), F.max(hi).alias(f"hi{i}"),
                 F.sum(F.when(x < lo, x).otherwise(F.lit(0.0))).alias(f"sl{i}"), F.count_if(x < lo).alias(f"nl{i}"),
                 F.sum(F.when(x > hi, x).otherwise(F.lit(0.0))).alias(f"sh{i}"), F.count_if(x > hi).alias(f"nh{i}")]
    s = rows.join(edges, KEYS).groupBy(*KEYS).agg(*sums)

    def kept(i: int, cut: Column) -> Column:
        low = F.col(f"sl{i}") + (cut - F.col(f"nl{i}")) * F.col(f"lo{i}")
        high = F.col(f"sh{i}") + (cut - F.col(f"nh{i}")) * F.col(f"hi{i}")
        return F.when(cut == 0, F.col("total") / n).otherwise(div(F.col("total") - low - high, n - 2 * cut))

    return s.select(*KEYS, *[kept(2 * i, cut).alias(f"dn_trimmedmean_{round(p * 100)}")
                             for i, (p, cut) in enumerate(cuts.items())])


def observation_count(win: DataFrame) -> DataFrame:
    """Number of readings that are not missing."""
    return win.groupBy(*KEYS).agg(F.count("y").alias("observations"))


def summary(b: DataFrame) -> DataFrame:
    """Features that follow from ``base`` alone."""
    n, mu, sd = F.col("n"), F.col("mu"), F.col("sd")
    lo, hi, med, q25, q75 = (F.col(c) for c in ("lo", "hi", "med", "q25", "q75"))
    ratio = div(sd, mu)
    bias = F.sqrt(n * (n - 1.0))
    return b.select(
        *KEYS,
        mu.alias("dn_mean"), (hi - lo).alias("dn_range"), (q75 - q25).alias("dn_iqr"),
        med.alias("dn_median"), hi.alias("dn_max"), lo.alias("dn_min"),
        F.col("skew").alias("dn_skew1"), F.col("skew").alias("dn_skew2"),
        F.col("kurt").alias("dn_kurt1"), F.col("kurt").alias("dn_kurt2"),
        F.when(n > 2, F.col("skew") * bias / (n - 2)).alias("dn_skew_unbiased"),
        F.when(n > 3, ((n + 1) * F.col("kurt") + 6) * (n - 1) / ((n - 2) * (n - 3))).alias(
            "dn_kurt_unbiased"),
        div(ratio - 1, ratio + 1).alias("dn_burstiness"), sd.alias("dn_std"),
        # both skews keep the defined precedence: 3 * mean - median
        F.when(sd == 0, 0.0).otherwise(div(3 * mu - med, sd)).alias("dn_customskewness"),
        F.when(sd == 0, 0.0).otherwise(div(q75 + q25 - 2 * med, q75 - q25)).alias(
            "dn_customskewness_bowley"),
        (0.5 + F.ln(math.sqrt(2 * math.pi) * F.nullif(sd, F.lit(0.0)))).alias("dn_nlogl_norm"),
        med.alias("dn_quantile_50"), q75.alias("dn_quantile_75"), F.col("q90").alias("dn_quantile_90"),
        F.col("q95").alias("dn_quantile_95"), F.col("q99").alias("dn_quantile_99"),
        ratio.alias("dn_cv_1"), div(sd * sd, mu * mu).alias("dn_cv_2"),
        div(sd * sd * sd, mu * mu * mu).alias("dn_cv_3"))


def deviations(rows: DataFrame, b: DataFrame, th: float = 0.1, large: bool = False, only: list[str] | None = None) -> DataFrame:
    """Features of the distance to the window's mean or median, or those in ``only``. ``large`` as in ``base``."""
    x, mu, sd, med = F.col("x"), F.col("mu"), F.col("sd"), F.col("med")
    near = rows.join(b.select(*KEYS, "mu", "sd", "med", "q25", "q75"), KEYS)
    wide = 1.35 * (F.col("q75") - F.col("q25"))

    def within(center: Column, spread: Column) -> Column:
        return share((x >= center - spread) & (x <= center + spread))

    def moment(k: int) -> Column:
        return F.when(F.max(sd) == 0, 0.0).otherwise(div(F.avg(F.pow(x - mu, F.lit(float(k)))), F.max(sd)))

    above, below = F.avg(F.when(x > mu, x)), F.avg(F.when(x < mu, x))
    sums = [
        within(mu, sd).alias("dn_withinp_1"), within(mu, 2 * sd).alias("dn_withinp_2"),
        within(med, wide).alias("dn_withinp_median_1"), within(med, 2 * wide).alias("dn_withinp_median_2"),
        *[moment(k).alias(f"dn_moment_{k}") for k in range(2, 7)],
        div(above - F.max(mu), F.max(mu) - below).alias("dn_highlowmu"),
        F.avg(F.abs(x - mu)).alias("dn_spread_mad")]
    if not large:
        return near.groupBy(*KEYS).agg(
            *sums, div(F.percentile(F.abs(x - mu), F.lit(1 - th)), F.max(sd)).alias("dn_pleft"),
            F.median(F.abs(x - med)).alias("dn__spread_mead"))
    out = [near.groupBy(*KEYS).agg(*sums, F.max(sd).alias("sd"))]
    if only is None or "dn_pleft" in only:
        out.append(large_quantiles(near.select(*KEYS, F.abs(x - mu).alias("x")), {"far": 1 - th}))
    if only is None or "dn__spread_mead" in only:
        out.append(large_quantiles(near.select(*KEYS, F.abs(x - med).alias("x")), {"dn__spread_mead": 0.5}))
    all_of = combine(out)
    if "far" in all_of.columns:
        all_of = all_of.withColumn("dn_pleft", div(F.col("far"), F.col("sd"))).drop("far")
    return all_of.drop("sd") if only is None else all_of.select(*KEYS, *only)


def value_counts(rows: DataFrame) -> DataFrame:
    """Mode (the smallest on ties), share of distinct values and Shannon entropy.

    Counts per value are formed before the shuffle, so repeated values travel once, and a crowded window is
    counted by many tasks. Values with equal counts are then merged in the same way.
    """
    counted = rows.groupBy(*KEYS, "x").agg(F.count("*").cast("double").alias("c"))
    level = counted.groupBy(*KEYS, "c").agg(F.count("*").cast("double").alias("m"), F.min("x").alias("x"))
    mass = F.col("c") * F.col("m")
    total = F.sum(mass)
    return level.groupBy(*KEYS).agg(
        F.max_by("x", "c").alias("dn_mode"), (F.sum("m") / total).alias("dn_unique"),
        (F.log2(total) - F.sum(mass * F.log2("c")) / total).alias("en_shannonentropy"))


def proportions(rows: DataFrame) -> DataFrame:
    """Shares of zero, positive and negative values."""
    x = F.col("x")
    return rows.groupBy(*KEYS).agg(
        share(x == 0).alias("dn_proportion_zeros"), share(x > 0).alias("dn_proportion_positive"),
        share(x < 0).alias("dn_proportion_negative"))


def gaussian_fit(b: DataFrame) -> DataFrame:
    """Maximum-likelihood normal parameters."""
    return b.select(*KEYS, F.col("mu").alias("dn_fit_mle_mean"), F.col("sd").alias("dn_fit_mle_std"))


def trimmed_means(rows: DataFrame, shares: tuple[float, ...] = (0.5, 0.75, 0.25)) -> DataFrame:
    """Mean after cutting half of the share, rounded half to even, from each side."""
    ranked = rows.select(*KEYS, "x").withColumn("r", F.row_number().over(by("x"))).withColumn(
        "n", F.count("*").over(per()))

    def kept(p: float) -> Column:
        cut = F.bround(F.col("n") * F.lit(p) / 2)
        return F.avg(F.when((F.col("r") > cut) & (F.col("r") <= F.col("n") - cut), F.col("x")))

    return ranked.groupBy(*KEYS).agg(
        *[kept(p).alias(f"dn_trimmedmean_{round(p * 100)}") for p in shares])


REMOVE_ORDER = {
    "absfar": lambda x: F.abs(x),
    "absclose": lambda x: -F.abs(x),
    "min": lambda x: -x,
    "max": lambda x: x,
}


def remove_points(rows: DataFrame, how: str = "absfar", p: float = 0.1, lags: int = 8,
                  prefix: str = "dn_removepoints_") -> DataFrame:
    """How statistics change when a share ``p`` of the points is taken out.

    Lags are true lags: ``ac1`` to ``ac3`` compare lags 1 to 3, and ``sumabsacfdiff`` sums the absolute
    differences over lags 1 to ``lags``. A window is one row here; ``large_remove_points`` spreads it.
    """
    keep_first = F.bround(F.col("n") * F.lit(1 - p))
    marked = (rows.select(*KEYS, "t", "x")
              .withColumn("by", REMOVE_ORDER[how](F.col("x")))
              .withColumn("r", F.row_number().over(by("by", "t")))
              .withColumn("n", F.count("*").over(per()))
              .withColumn("kept", F.col("r") <= keep_first))

    def pack(value: Column) -> Column:
        # collect_list skips the NULL that stands for a removed point
        return F.sort_array(F.collect_list(value))

    point = F.struct("t", "x")
    trim = F.when(F.col("kept"), F.col("x"))
    packed = marked.groupBy(*KEYS).agg(
        pack(point).alias("p_all"), pack(F.when(F.col("kept"), point)).alias("p_kept"),
        F.count("*").cast("int").alias("n"), F.count(trim).cast("int").alias("m"),
        F.avg("x").alias("mu"), F.avg(trim).alias("mu_k"), F.median(trim).alias("med_k"),
        F.stddev_samp(trim).alias("std_k"),
        F.skewness("x").alias("sk"), F.skewness(trim).alias("sk_k"),
        F.kurtosis("x").alias("ku"), F.kurtosis(trim).alias("ku_k"))
    centred = packed.select(
        *KEYS, "n", "m", "mu_k", "med_k", "std_k", "sk", "sk_k", "ku", "ku_k",
        F.transform("p_all.x", lambda v: v - F.col("mu")).alias("a"),
        F.transform("p_kept.x", lambda v: v - F.col("mu_k")).alias("b"))
    steps = F.sequence(F.lit(0), F.lit(lags))
    dots = centred.select(
        "*",
        F.transform(steps, lambda k: V.lag_dot(F.col("a"), F.col("n"), k)).alias("da"),
        F.transform(steps, lambda k: V.lag_dot(F.col("b"), F.col("m"), k)).alias("db"),
        V.first_zero(F.col("a"), F.col("n")).alias("za"),
        V.first_zero(F.col("b"), F.col("m")).alias("zb"))
    acf = dots.select(
        *KEYS, "mu_k", "med_k", "std_k", "sk", "sk_k", "ku", "ku_k", "za", "zb",
        F.transform("da", lambda v: div(v, F.col("da")[0])).alias("fa"),
        F.transform("db", lambda v: div(v, F.col("db")[0])).alias("fb"))
    fa, fb = F.col("fa"), F.col("fb")
    gaps = F.zip_with("fa", "fb", lambda u, v: F.abs(v - u))
    out = {"fzcacrat": F.col("zb") / F.col("za")}
    for k in (1, 2, 3):
        out[f"ac{k}rat"] = div(fb[k], fa[k])
        out[f"ac{k}diff"] = F.abs(fb[k] - fa[k])
    out["sumabsacfdiff"] = F.aggregate(F.slice(gaps, 2, lags), F.lit(0.0), lambda s, v: s + v)
    out["mean"], out["median"], out["std"] = F.col("mu_k"), F.col("med_k"), F.col("std_k")
    out["skewnessrat"] = div(F.col("sk_k"), F.col("sk"))
    out["kurtosisrat"] = div(F.col("ku_k") + 3, F.col("ku") + 3)
    return acf.select(*KEYS, *[c.alias(prefix + name) for name, c in out.items()])


def _kept_points(rows: DataFrame, how: str, p: float, pieces: int, accuracy: int) -> DataFrame:
    """``(series, w, x, i, kept, j)``: position in the window, whether a point stays, and its position among those that stay.

    The value at the cut is selected without ordering the window. Points on the near side of it stay, and of those at it
    the earliest. Positions come from short pieces of a window's time, which are ordered on their own, and a table
    with one row per piece that counts what lies before.
    """
    keep = F.bround(F.col("n") * F.lit(1 - p))
    score = rows.select(F.col("series").cast("string").alias("series"), F.col("w").cast("bigint").alias("w"), "t", "x",
                        REMOVE_ORDER[how](F.col("x")).alias("by"))
    cut = _order_statistics(score.select(*KEYS, F.col("by").alias("x")), {"cut": (1 - p, F.greatest(keep - 1, F.lit(0)))},
                            KEYS, accuracy).select(*KEYS, F.col("x0").alias("cut"))
    bounds = score.groupBy(*KEYS).agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count("*").alias("n"))
    known = score.join(bounds.join(cut, KEYS), KEYS)
    part = F.least(F.floor(div(F.col("t") - F.col("t0"), F.col("t1") - F.col("t0")) * pieces), F.lit(pieces - 1))
    near, tied = (F.col("by") < F.col("cut")) & (keep > 0), (F.col("by") == F.col("cut")) & (keep > 0)
    placed = known.select(*KEYS, "t", "x", F.coalesce(part, F.lit(0)).alias("piece"), keep.alias("keep"),
                          near.cast("int").alias("near"), tied.cast("int").alias("tied"))
    counts = placed.groupBy(*KEYS, "piece").agg(
        F.count("*").alias("rows"), F.sum("near").alias("nears"), F.sum("tied").alias("ties"), F.max("keep").alias("keep"))
    earlier = by("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    table = counts.select(*KEYS, "piece", before("rows").alias("rows0"), before("nears").alias("near0"),
                          before("ties").alias("tied0"), (F.col("keep") - F.sum("nears").over(per())).alias("quota"))
    inside = by("t", "x", keys=KEYS + ["piece"])
    upto_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumns({"r": F.row_number().over(inside), "nr": F.sum("near").over(upto_here),
                                 "tr": F.sum("tied").over(upto_here)}).join(table, [*KEYS, "piece"])
    tie_rank = F.col("tied0") + F.col("tr")
    stays = (F.col("near") == 1) | ((F.col("tied") == 1) & (tie_rank <= F.col("quota")))
    return ranked.select(*KEYS, "x", (F.col("rows0") + F.col("r") - 1).alias("i"), stays.alias("kept"),
                         (F.col("near0") + F.col("nr") + F.least(tie_rank, F.col("quota")) - 1).cast("bigint").alias("j"))


def large_remove_points(rows: DataFrame, how: str = "absfar", p: float = 0.1, lags: int = 8,
                        prefix: str = "dn_removepoints_", pieces: int = 256, accuracy: int = 10000,
                        block: int = L.BLOCK) -> DataFrame:
    """``remove_points`` for windows of any size: no row, task or group holds a window.

    The cut is found by ``_kept_points``, lags are summed over overlapping blocks of positions, all of them and those of the
    points that stay, and the first zeros are searched in ranges of lags that double. The marked points are staged. ``sumabsacfdiff`` is over the lags that both have; ``remove_points`` gives NULL there
    if one of them is too long for what stays.
    """
    marked = staged(_kept_points(rows, how, p, pieces, accuracy))
    trim = F.when(F.col("kept"), F.col("x"))
    stats = marked.groupBy(*KEYS).agg(
        F.count("*").alias("n"), F.count(trim).alias("m"), F.avg("x").alias("mu"), F.avg(trim).alias("mu_k"),
        F.stddev_samp(trim).alias("std_k"), F.skewness("x").alias("sk"), F.skewness(trim).alias("sk_k"),
        F.kurtosis("x").alias("ku"), F.kurtosis(trim).alias("ku_k"))
    kept = marked.where("kept").select(*KEYS, F.col("j").alias("i"), "x")
    middle = large_quantiles(kept, {"med_k": 0.5}, accuracy=accuracy)

    def self_correlation(points: DataFrame, n: str, mu: str, name: str) -> DataFrame:
        centred = points.join(stats.select(*KEYS, F.col(n).alias("n"), mu), KEYS).select(
            *KEYS, "n", "i", (F.col("x") - F.col(mu)).alias("d"))
        sums = L.lag_sums(centred, 0, lags, block).groupBy(*KEYS).agg(
            *[F.max(F.when(F.col("k") == k, F.col("s"))).alias(f"s{k}") for k in range(lags + 1)])
        zero = L.first_lags(points, ["co_firstzero"], block=block).withColumnRenamed("co_firstzero", f"z{name}")
        return sums.select(*KEYS, *[div(F.col(f"s{k}"), F.col("s0")).alias(f"{name}{k}") for k in range(1, lags + 1)]).join(
            zero, KEYS)

    both = combine([stats, middle, self_correlation(marked.select(*KEYS, "i", "x"), "n", "mu", "a"),
                    self_correlation(kept, "m", "mu_k", "b")])
    a, b = (lambda k: F.col(f"a{k}")), (lambda k: F.col(f"b{k}"))
    # without points that stay the number of them, 0, is their first zero
    out = {"fzcacrat": F.coalesce(F.col("zb"), F.lit(0)) / F.col("za")}
    for k in (1, 2, 3):
        out[f"ac{k}rat"] = div(b(k), a(k))
        out[f"ac{k}diff"] = F.abs(b(k) - a(k))
    out["sumabsacfdiff"] = sum((F.coalesce(F.abs(b(k) - a(k)), F.lit(0.0)) for k in range(2, lags + 1)), F.abs(b(1) - a(1)))
    out["mean"], out["median"], out["std"] = F.col("mu_k"), F.col("med_k"), F.col("std_k")
    out["skewnessrat"] = div(F.col("sk_k"), F.col("sk"))
    out["kurtosisrat"] = div(F.col("ku_k") + 3, F.col("ku") + 3)
    return both.select(*KEYS, *[c.alias(prefix + name) for name, c in out.items()])


def outlier_thresholds(rows: DataFrame, how: str = "abs", inc: float = 0.01) -> DataFrame:
    """Timing of extreme values per threshold of the z-score: ``(series, w, th, ...)``.

    A point reaches only the thresholds at or below its own score. A window is one row here; it is repeated for each set of points
    that thresholds share, where it lies, and the numbers of a set for each of its thresholds.
    """
    z = div(F.col("x") - F.avg("x").over(per()), F.stddev_pop("x").over(per()))
    scored = rows.select(*KEYS, "t", "x").withColumn("i", F.row_number().over(by("t", "x")) - 1).withColumn(
        "n", F.count("*").over(per())).withColumn("z", z)
    score = {"abs": F.abs("z"), "p": F.col("z"), "n": -F.col("z")}[how]
    scored = scored.withColumn("s", score).withColumn(
        "tot", F.sum((F.col("s") >= 0).cast("long")).over(per())).withColumn(
        "top", F.max("s").over(per())).where("s >= 0")
    # arange(0, top, inc) leaves out top itself
    last = F.least(F.floor(F.col("s") / F.lit(inc)), F.ceil(F.col("top") / F.lit(inc)) - 1)
    packed = scored.groupBy(*KEYS).agg(F.max("n").alias("n"), F.max("tot").alias("tot"), F.sort_array(F.collect_list(
        F.struct("i", last.alias("last")))).alias("p"))
    # the points at or above a threshold change only where one has its last threshold
    levels = F.array_sort(F.array_distinct("p.last"))
    each = packed.withColumn("levels", levels).select("*", F.posexplode("levels").alias("at", "to"))
    first = F.when(F.col("at") == 0, F.lit(0).cast("long")).otherwise(F.get("levels", F.col("at") - 1) + 1)
    member = F.filter("p", lambda v: v["last"] >= F.col("to"))
    each = each.select(*KEYS, "n", "tot", first.alias("from"), "to", F.transform(member, lambda v: v["i"].cast("double")).alias("is"))
    at = F.col("is")
    gaps = F.transform(F.slice(at, 2, F.size(at)), lambda v, j: v - at[j])
    each = each.select("*", gaps.alias("gaps"), V.mean_of(gaps).alias("mg"), V.mean_of(at).alias("mi"))
    half, root = F.col("n") / 2, F.sqrt(F.size("is").cast("double"))
    out = each.select(
        *KEYS, "from", "to", F.col("mg").alias("mean_gap"), (V.std_of(F.col("gaps"), F.col("mg")) / root).alias("std_gap"),
        (F.size("gaps") / F.col("tot") * 100).alias("pct"), (V.quantile_of(at, 0.5) / half - 1).alias("median_at"),
        (F.col("mi") / half - 1).alias("mean_at"), (V.std_of(at, F.col("mi")) / root).alias("std_at"))
    return out.withColumn("step", F.explode(F.sequence("from", "to"))).withColumn(
        "th", F.col("step") * F.lit(inc)).drop("step", "from", "to")


def distribution(rows: DataFrame, large: bool = False) -> DataFrame:
    """All default distribution features of a window in one row."""
    b = base(rows, large=large)
    return combine([summary(b), deviations(rows, b, large=large), value_counts(rows),
                    large_trimmed_means(rows) if large else trimmed_means(rows),
                    (large_remove_points if large else remove_points)(rows, "absfar", 0.5)])
