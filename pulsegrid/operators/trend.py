"""Trend, stationarity, scaling and adaptive-threshold features of ordered windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import vectors as V
from pulsegrid.functions.expr import KEYS, by, div, per, upto

KICK_GAINS = (0.25, 0.5, 1.0)
DECAYS = (0.05, 0.1, 0.25)
#: Positions of a window that are summed as one piece of work.
BLOCK = 4096


def trend(o: DataFrame) -> DataFrame:
    """Linear trend of the z-scored series and of its cumulative sum."""
    z = div(F.col("x") - F.avg("x").over(per()), F.stddev_pop("x").over(per()))
    rows = o.select(*KEYS, "i", z.alias("z"), F.floor(F.count("*").over(per()) / 2).alias("half"))
    rows = rows.withColumn("c", F.sum("z").over(upto("i")))
    z, c, i = F.col("z"), F.col("c"), F.col("i").cast("double")
    first = F.col("i") < F.col("half")
    return rows.groupBy(*KEYS).agg(
        # rounding may lift the explained share of an exact line just above 1
        F.sqrt(1 - F.least(F.regr_r2(z, i), F.when(F.regr_r2(z, i).isNotNull(), 1.0))).alias("trend_stdratio"),
        F.regr_slope(z, i).alias("trend_gradient"), F.regr_intercept(z, i).alias("trend_intercept"),
        F.avg(c).alias("trend_meanyc"), F.stddev_pop(c).alias("trend_stdyc"),
        F.regr_slope(c, i).alias("trend_gradientyc"), F.regr_intercept(c, i).alias("trend_interceptyc"),
        F.avg(F.when(first, c)).alias("trend_meanyc12"), F.avg(F.when(~first, c)).alias("trend_meanyc22"))


def segment_means(o: DataFrame, sizes: tuple[int, ...] = (2, 3, 4, 5, 10)) -> DataFrame:
    """Spread of segment means over the spread of the series: n segments, or segments of length n."""
    rows = o.select(*KEYS, "i", "x", F.count("*").over(per()).alias("n"),
                    F.stddev_samp("x").over(per()).alias("s"))
    plans = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("k"))
                      for kind in ("seg", "len") for k in sizes])
    long = rows.select("*", F.inline(plans))
    size = F.when(F.col("kind") == "seg", F.floor(F.col("n") / F.col("k"))).otherwise(F.col("k"))
    long = long.withColumn("size", size).where(
        (F.col("size") > 0) & ((F.col("kind") == "seg") | (F.col("n") > 2 * F.col("k"))))
    long = long.where(F.col("i") < F.col("size") * F.floor(F.col("n") / F.col("size")))
    long = long.where((F.col("kind") == "len") | (F.col("i") < F.col("size") * F.col("k")))
    means = long.groupBy(*KEYS, "kind", "k", F.floor(F.col("i") / F.col("size")).alias("g")).agg(
        F.avg("x").alias("m"), F.max("s").alias("s"))
    each = means.groupBy(*KEYS, "kind", "k").agg(div(F.stddev_samp("m"), F.max("s")).alias("v"))
    return each.groupBy(*KEYS).agg(*[
        F.max(F.when((F.col("kind") == kind) & (F.col("k") == k), F.col("v"))).alias(f"sy_statav_{kind}_{k}")
        for kind in ("seg", "len") for k in sizes])


def drifting_mean(o: DataFrame, how: str = "num", l: int | None = None) -> DataFrame:
    """Extremes of segment means over the mean variance inside segments.

    Segments have 5 values (``num``) or 200 (``fix``); with ``num`` and ``l`` the window is cut so that a
    segment has floor(n / l) values.
    """
    n = F.count("*").over(per())
    if how == "num":
        size = F.lit(5) if l is None else F.floor(F.col("n") / l)
    else:
        size = F.lit(200 if l is None else l)
    rows = o.withColumn("n", n).withColumn("size", size).where("size > 0 and n >= size")
    rows = rows.where(F.col("i") < F.floor(F.col("n") / F.col("size")) * F.col("size"))
    each = rows.groupBy(*KEYS, F.floor(F.col("i") / F.col("size")).alias("g")).agg(
        F.avg("x").alias("m"), F.var_samp("x").alias("v"))
    noise = F.avg("v")
    top, low = div(F.max("m"), noise), div(F.min("m"), noise)
    return each.groupBy(*KEYS).agg(
        top.alias("sy_driftingmean__max"), low.alias("sy_driftingmean__min"),
        div(F.avg("m"), noise).alias("sy_driftingmean__mean"),
        ((top + low) / 2).alias("sy_driftingmean__meanmaxmin"),
        ((F.abs(top) + F.abs(low)) / 2).alias("sy_driftingmean__meanabsmaxmin"))


def _slug(v: float) -> str:
    return f"{v:g}".replace(".", "_")


def moving_threshold(vec: DataFrame, gains=KICK_GAINS, decays=DECAYS) -> DataFrame:
    """A threshold that decays by ``b`` per step and is kicked to (1 + a)|x| by any value above it.

    The threshold before each value is folded block by block (``states_before``); kicks are the values above it.
    """
    plans = {f"a{_slug(a)}_b{_slug(b)}": (float(a), float(b)) for a in gains for b in decays}
    grid = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(tag).alias("tag"))
                     for tag, (a, b) in plans.items()])
    rows = vec.select(*KEYS, "n", F.transform("xs", lambda x: F.abs(x)).alias("ys"), F.inline(grid))
    ys, a, b, n = F.col("ys"), F.col("a"), F.col("b"), F.col("n")

    def moved(q, y):
        return F.when(y > q, (1 + a) * y).otherwise((1 - b) * q)

    later = F.slice(ys, 2, F.greatest(n - 1, F.lit(0)))
    rows = rows.where("n > 1").select(*KEYS, "a", "b", "tag", "n", "ys", V.states_before(later, F.lit(1.0), moved, "double").alias("before"))
    # q: the threshold after each value; the first is 1, and the last follows from what was before it
    before = F.col("before")
    rows = rows.select(*KEYS, "a", "tag", "n", "ys", "before", F.filter(F.sequence(F.lit(1), n - 1), lambda i: ys[i] > before[i - 1]).alias("at"),
                       F.concat(before, F.array(moved(before[n - 2], ys[n - 1]))).alias("q"))
    at = F.col("at")
    jumps = F.transform(at, lambda i: (1 + a) * ys[i] - before[i - 1])
    gaps = F.transform(F.slice(at, 2, F.size(at)), lambda v, j: (v - at[j]).cast("double"))
    state = rows.select(  # the start counts as a kick without a jump
        *KEYS, "tag", "n", F.sort_array("q").alias("q"), F.sort_array(gaps).alias("gaps"),
        V.mean_of(ys).alias("my"), V.mean_of(F.concat(F.array(F.lit(0.0)), jumps)).alias("mj"), (F.size(at) + 1).alias("nk"))
    state = state.withColumns({"mq": V.mean_of(F.col("q")), "mg": V.mean_of(F.col("gaps"))})
    q, gaps = F.col("q"), F.col("gaps")
    out = {
        "meanq": F.col("mq"), "medianq": V.quantile_of(q, 0.5),
        "iqrq": V.quantile_of(q, 0.75) - V.quantile_of(q, 0.25),
        "maxq": q[F.size(q) - 1], "minq": q[0], "stdq": V.std_of(q, F.col("mq")),
        "meanqover": F.col("mq") - F.col("my"),
        # kept as defined: one is taken from the mean kick
        "pkick": F.col("mj") * F.col("nk") / F.col("n") - 1,
        "stdkicks": V.std_of(gaps, F.col("mg")), "meankickf": F.col("mg"),
        "mediankicksf": V.quantile_of(gaps, 0.5),
    }
    each = state.select(*KEYS, "tag", *[c.alias(k) for k, c in out.items()])
    return each.groupBy(*KEYS).agg(*[
        F.expr(f"max(CASE WHEN tag = '{tag}' THEN {c} END)").alias(f"ex_movingthreshold_{tag}_{c}")
        for tag in plans for c in out])


def hurst_exponent(o: DataFrame) -> DataFrame:
    """Rescaled range over 1, 2, 4, ... chunks: slope of ln(R/S) on ln(chunk length)."""
    rows = o.select(*KEYS, "i", "x", F.count("*").over(per()).alias("n"))
    top = F.floor(F.log2(F.col("n").cast("double"))).cast("int") - 1
    long = rows.where("n >= 2").select("*", F.explode(F.sequence(F.lit(0), top)).alias("e"))
    long = long.withColumn("len", F.floor(F.col("n") / F.pow(F.lit(2.0), F.col("e"))))
    long = long.where(F.col("i") < F.col("len") * F.pow(F.lit(2.0), F.col("e"))).withColumn(
        "g", F.floor(F.col("i") / F.col("len")))
    keys = KEYS + ["e", "len", "g"]
    long = long.withColumn("d", F.col("x") - F.avg("x").over(per(keys)))
    long = long.withColumn("z", F.sum("d").over(upto("i", keys=keys)))
    spread = long.groupBy(*keys).agg((F.max("z") - F.min("z")).alias("r"), F.stddev_pop("x").alias("s"))
    scale = spread.groupBy(*KEYS, "e", "len").agg(
        F.avg(F.col("r") / F.when(F.col("s") == 0, F.lit(1.0)).otherwise(F.col("s"))).alias("rs"))
    return scale.groupBy(*KEYS).agg(
        F.regr_slope(F.ln("rs"), F.ln(F.col("len").cast("double"))).alias("sc_hurstexp"))


def _box_sizes(n: Column, sizes: list[int] | None) -> Column:
    if sizes is None:
        top = F.floor(n / 2).cast("int")
        return F.when(top >= 5, F.sequence(F.lit(5), F.greatest(top, F.lit(5))))
    return F.filter(F.array(*[F.lit(s) for s in sizes]), lambda s: s <= n)


def detrended_fluctuation(o: DataFrame, sizes: list[int] | None = None,
                          name: str = "sc_dfa", log=F.ln) -> DataFrame:
    """Slope of ln F on ln box size; F is the RMS around a line in each box of the summed series.

    ``sizes=None`` takes every size from 5 to n/2. Boxes are read off running sums at their two ends, so all
    sizes together cost n log n rows, not n * n. A window is one row here; ``large_fluctuation`` spreads it.
    """
    d = o.select(*KEYS, "i", (F.col("x") - F.avg("x").over(per())).alias("d"))
    p = d.select(*KEYS, "i", F.sum("d").over(upto("i")).alias("p"))
    i = F.col("i").cast("double")
    run = p.select(*KEYS, "i", *[F.sum(c).over(upto("i")).alias(k) for k, c in (
        ("s0", F.col("p")), ("s1", i * F.col("p")), ("s2", F.col("p") * F.col("p")))])
    vec = run.groupBy(*KEYS).agg(F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list(
        F.struct("i", "s0", "s1", "s2"))).alias("s"))
    s, n = F.col("s"), F.col("n")

    def box(t, k):
        lo, hi = k * t, k * t + t - 1

        def between(c):
            return s[hi][c] - F.when(lo > 0, F.get(s, lo - 1)[c]).otherwise(F.lit(0.0))

        total = between("s0")
        sxy = between("s1") - lo * total - (t - 1) / 2.0 * total
        syy = between("s2") - total * total / t
        sxx = t * (t * t - 1.0) / 12.0
        return F.struct(t.alias("t"), F.greatest(syy - sxy * sxy / sxx, F.lit(0.0)).alias("rss"))

    boxes = F.flatten(F.transform(_box_sizes(n, sizes), lambda t: F.transform(
        F.sequence(F.lit(0), F.floor(n / t).cast("int") - 1), lambda k: box(t, k))))
    each = vec.select(*KEYS, F.inline_outer(boxes)).groupBy(*KEYS, "t").agg(
        F.sqrt(F.sum("rss") / (F.count("rss") * F.col("t"))).alias("f"))
    return each.groupBy(*KEYS).agg(
        F.regr_slope(log(F.nullif(F.col("f"), F.lit(0.0))), log(F.col("t").cast("double"))).alias(name))


def _profile(o: DataFrame, block: int) -> DataFrame:
    """``(series, w, i, n, p)``: running sums ``p`` of the centred values.

    Blocks of positions are summed on their own; a table with one row per block holds what lies before each.
    """
    centre = o.groupBy(*KEYS).agg(F.count("x").alias("n"), F.avg("x").alias("mu"))
    d = o.join(centre, KEYS).select(*KEYS, "i", "n", (F.col("x") - F.col("mu")).alias("d"),
                                    F.floor(F.col("i") / block).alias("b"))
    earlier = by("b").rowsBetween(Window.unboundedPreceding, -1)
    before = d.groupBy(*KEYS, "b").agg(F.sum("d").alias("s")).select(
        *KEYS, "b", F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("before"))
    inside = d.withColumn("p", F.sum("d").over(upto("i", keys=KEYS + ["b"])))
    return inside.join(before, KEYS + ["b"]).select(*KEYS, "i", "n", (F.col("before") + F.col("p")).alias("p"))


def _segments(profile: DataFrame, longest: int | None = None) -> DataFrame:
    """Statistics of every aligned segment ``m`` of 2**l positions: mean ``p``, product sum ``sxy`` and ``rss`` about its own line.

    All are central moments that Spark merges from partial aggregates, so neither an offset nor a drift costs digits. No
    segment is longer than ``longest``.
    """
    top = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    levels = F.sequence(F.lit(0), top if longest is None else F.least(top, F.lit(longest.bit_length() - 1)))
    long = profile.select(*KEYS, "n", "p", F.col("i").cast("bigint").alias("i"), F.explode(levels).alias("l"))
    long = long.withColumn("m", F.expr("shiftright(i, l)"))
    i, p = F.col("i").cast("double"), F.col("p")
    each = long.groupBy(*KEYS, "l", "m").agg(F.avg(p).alias("p"), F.count(p).cast("double").alias("c"), F.max("n").alias("n"),
                                             F.regr_sxy(p, i).alias("sxy"), F.regr_syy(p, i).alias("syy"))
    c, sxy = F.col("c"), F.col("sxy")
    # one or two points lie on their line
    rss = F.when(c < 3, 0.0).otherwise(F.greatest(F.col("syy") - sxy * sxy / (c * (c * c - 1) / 12), F.lit(0.0)))
    return each.select(*KEYS, "n", "l", "m", "p", "sxy", rss.alias("rss"))


#: The whole segments of level ``l`` in the box from ``lo`` on, and those of them that its cover takes: at most two per level.
FIRST, BEHIND = "shiftright(lo + shiftleft(1L, l) - 1, l)", "shiftright(lo + t, l)"


def _assigned(segments: DataFrame, sizes: list[int]) -> DataFrame:
    """Segments with each box they are a part of. Every segment finds its boxes by itself, so nothing is joined or broadcast."""
    tried = segments.withColumn("t", F.explode(F.array(*[F.lit(t) for t in sizes])))
    box = tried.withColumn("k", F.expr("shiftleft(m, l) div t")).where("k < n div t").withColumn("lo", F.expr("k * t"))
    taken = box.withColumns({"a": F.expr(FIRST), "b": F.expr(BEHIND)}).where(
        "a <= m AND m < b AND (m = a AND a % 2 = 1 OR m = b - 1 AND b % 2 = 1)")
    return taken.drop("a", "b")


def _pieces(windows: DataFrame, sizes: list[int] | None) -> DataFrame:
    """The aligned segments each box is made of: at most two per level. ``windows`` is ``(series, w, n)``."""
    long = windows.select(*KEYS, "n", F.explode(_box_sizes(F.col("n"), sizes)).alias("t")).repartition(*KEYS, "t")
    box = long.select(*KEYS, "t", F.explode(F.expr("sequence(0L, n div t - 1)")).alias("k")).withColumn("lo", F.expr("k * t"))
    level = box.select("*", F.explode(F.expr("sequence(0, CAST(floor(log2(t)) AS INT))")).alias("l"))
    ends = level.withColumns({"a": F.expr(FIRST), "b": F.expr(BEHIND)})
    # shuffled as they are, so that Spark knows their size when it chooses a join
    return ends.where("a < b").select(*KEYS, "t", "k", "lo", "l", F.explode(F.expr(
        "array_compact(array(CASE WHEN a % 2 = 1 THEN a END, CASE WHEN b % 2 = 1 THEN b - 1 END))")).alias("m")).repartition(*KEYS, "l", "m")


def large_fluctuation(o: DataFrame, sizes: list[int] | None = None, name: str = "sc_dfa", log=F.ln,
                      block: int = BLOCK) -> DataFrame:
    """``detrended_fluctuation`` for windows of any size.

    A box is assembled from aligned segments of the profile, at most two of each power of two: with a list of ``sizes`` each segment
    tells its boxes, without one they meet in an equi-join. No row, task or group holds a window; one without a box has no row. What is left around the box's line is the sum of what is left around the segments' own
    lines and of their distances to the common one: only squares are added, nothing is subtracted.
    """
    # the levels multiply the rows after this shuffle, so its small size must not decide how many tasks there are
    tasks = int(o.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    profile = _profile(o, block).repartition(tasks, *KEYS, F.floor(F.col("i") / block))
    if sizes is None:
        windows = o.groupBy(*KEYS).agg(F.count("x").alias("n"))
        met = _pieces(windows, sizes).join(_segments(profile), [*KEYS, "l", "m"])
    else:
        met = _assigned(_segments(profile, max(sizes)), sizes)
    size = F.expr("CAST(shiftleft(1L, l) AS DOUBLE)")
    middle = F.col("m") * size + (size - 1) / 2
    t = F.col("t")
    piece = F.struct(size.alias("c"), (middle - F.col("lo") - (t - 1) / 2.0).alias("j"), "p", "sxy", "rss",
                     (size * (size * size - 1) / 12).alias("sxx"))
    boxes = met.groupBy(*KEYS, "t", "k").agg(F.collect_list(piece).alias("s"))  # two per level at most
    total = lambda f: F.aggregate("s", F.lit(0.0), lambda acc, v: acc + f(v))
    boxes = boxes.withColumn("mean", total(lambda v: v["c"] * v["p"]) / t)
    sxx = t * (t * t.cast("double") - 1.0) / 12.0
    boxes = boxes.withColumn("slope", total(lambda v: v["sxy"] + v["c"] * v["j"] * (v["p"] - F.col("mean"))) / sxx)

    def left(v):
        own = F.coalesce(div(v["sxy"], v["sxx"]), F.lit(0.0)) - F.col("slope")
        off = v["p"] - F.col("mean") - F.col("slope") * v["j"]
        return v["rss"] + v["sxx"] * own * own + v["c"] * off * off

    each = boxes.select(*KEYS, "t", total(left).alias("rss")).groupBy(*KEYS, "t").agg(
        F.sqrt(F.sum("rss") / (F.count("rss") * t)).alias("f"))
    return each.groupBy(*KEYS).agg(
        F.regr_slope(log(F.nullif(F.col("f"), F.lit(0.0))), log(t.cast("double"))).alias(name))


def power_sizes(low: float = 5, high: float = 9, density: float = 0.25) -> list[int]:
    """Whole-number box sizes 2**low .. 2**high (exclusive) in steps of ``density`` in the exponent."""
    count = round((high - low) / density)
    return [int(2 ** (low + k * density)) for k in range(count)]
