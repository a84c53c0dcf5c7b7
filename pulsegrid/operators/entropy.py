"""Entropy and complexity features of the filled, ordered values of a window.

Template matching never forms rows for pairs. Windows of at most ``SMALL`` values are one row each, and numpy compares their
values where the row lies. In larger ones equal templates are merged with a count, and those within the tolerance
are counted by ranges of sorted values, one coordinate after the other (``ranges``): templates of two values as rows,
longer ones in blocks of one row each. A one-dimensional range count is read off a running count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS, by, per, upto
from pulsegrid.operators import ranges as R

#: Values of a window whose pairs are compared at once, in a square of that side, and rows of a batch that goes back to Spark.
SMALL, ROWS = 1024, 1024


def _tolerant(o: DataFrame, keys: list[str], share_of_sd: float, absolute: bool = False) -> DataFrame:
    """Adds the tolerance ``r`` (a share of the deviation, or itself) and the length ``n``; without tolerance no templates."""
    whole = per(keys)
    return o.select(*keys, "i", "x", (F.lit(float(share_of_sd)) if absolute else F.stddev_pop("x").over(whole) * F.lit(share_of_sd)).alias("r"),
                    F.count("*").over(whole).alias("n")).where("r > 0")


def _templates(o: DataFrame, keys: list[str], share_of_sd: float, size: int, absolute: bool = False) -> DataFrame:
    """Distinct templates of ``size`` consecutive values of windows that are not small, with their count ``c``."""
    step = by("i", keys=keys)
    rows = _tolerant(o, keys, share_of_sd, absolute).where(F.col("n") > SMALL)
    cols = [F.col("x").alias("x0"), *[F.lead("x", k).over(step).alias(f"x{k}") for k in range(1, size)]]
    names = [f"x{k}" for k in range(size)]
    return rows.select(*keys, "n", "r", *cols).where(F.col(names[-1]).isNotNull()).groupBy(
        *keys, "n", "r", *names).agg(F.count("*").alias("c"))


def _arrays(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per small window: ``xs`` by position, with its ``n`` and tolerance ``r``."""
    return rows.where(F.col("n") <= SMALL).groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("r").alias("r"), F.sort_array(F.collect_list(F.struct("i", "x"))).alias("p")).select(
        *keys, "n", "r", F.col("p.x").alias("xs"))


def _per_window(windows: DataFrame, keys: list[str], found: dict[str, str], work) -> DataFrame:
    """Applies ``work(xs, r)`` to each row; what it returns, lists of tuples, becomes rows with the ``keys`` and the columns ``found``."""
    import pyarrow as pa

    kinds = {"double": pa.float64(), "bigint": pa.int64()}

    def run(batches):
        import numpy as np

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b, out, of = whole.slice(at, ROWS), [], []
                values, starts = b.column("xs"), b.column("xs").offsets.to_numpy()
                flat = values.values.to_numpy(zero_copy_only=False)
                for k, r in enumerate(b.column("r").to_numpy(zero_copy_only=False)):
                    made = work(flat[starts[k]:starts[k + 1]], np.float64(r))
                    out += made
                    of += [k] * len(made)
                columns = [b.column(c).take(pa.array(of, pa.int64())) for c in keys]
                columns += [pa.array([x[j] for x in out], kinds[kind]) for j, kind in enumerate(found.values())]
                yield pa.RecordBatch.from_arrays(columns, [*keys, *found])

    names = [f"`{c}` {windows.schema[c].dataType.simpleString()}" for c in keys] + [f"{c} {kind}" for c, kind in found.items()]
    return windows.select(*keys, "r", "xs").mapInArrow(run, ", ".join(names))


def _matches(xs, r, m: int) -> tuple[int, int]:
    """Pairs, also with themselves, of templates that match in all ``m + 1`` values and in the first ``m``."""
    import numpy as np

    n = len(xs) - m
    with np.errstate(invalid="ignore"):
        near = np.abs(xs[:, None] - xs) < r
    np.fill_diagonal(near, True)
    both = near[:n, :n]
    for k in range(1, m):
        both = both & near[k:k + n, k:k + n]
    return int(np.count_nonzero(both & near[m:, m:])), int(np.count_nonzero(both))


def _match_counts(rows: DataFrame, keys: list[str], m: int) -> DataFrame:
    """``(keys, n, r, a, b)`` of the small windows among ``_tolerant`` rows."""
    windows = _arrays(rows.where(F.col("n") > m), keys)
    return _per_window(windows, keys, {"n": "bigint", "r": "double", "a": "bigint", "b": "bigint"},
                       lambda xs, r: [(len(xs), float(r), *_matches(xs, r, m))])


def sample_entropy(o: DataFrame, m: int = 2, rth: float = 0.2, keys: list[str] = KEYS, absolute: bool = False) -> DataFrame:
    """Sample and quadratic entropy, with a tolerance of ``rth`` deviations or ``absolute``; infinite when no match goes on, NULL when there is no match.

    Matches of the first ``m`` values (``b``) and of all ``m + 1`` (``a``) are counted window by window or, in large ones,
    block by block (``ranges``).
    """
    small = _match_counts(_tolerant(o, keys, rth, absolute), keys, m)
    return _sample_entropies(small.unionByName(_large_matches(o, m, rth, keys, absolute)), m, keys)


def _large_matches(o: DataFrame, m: int, rth: float, keys: list[str], absolute: bool = False) -> DataFrame:
    """``(keys, n, r, a, b)`` of windows that are not small, in parts: pairs, also with themselves, that match in all values and in the first ``m``."""
    blocks = R.packed(_tolerant(o, keys, rth, absolute).where(F.col("n") > SMALL), keys, m)
    return R.running(blocks, keys, "c", [f"x{k}" for k in range(1, m + 1)])


def _sample_entropies(at: DataFrame, m: int, keys: list[str]) -> DataFrame:
    own = F.max("n") - m  # every template meets itself once
    totals = at.groupBy(*keys).agg((F.sum("a") - own).alias("a"), (F.sum("b") - own).alias("b"), F.max("r").alias("r"))
    entropy = F.when(F.col("b") == 0, F.lit(None)).when(F.col("a") == 0, F.lit(float("inf"))).otherwise(
        -F.ln(F.nullif(F.col("a"), F.lit(0)) / F.nullif(F.col("b"), F.lit(0))))
    return totals.select(*keys, entropy.alias("en_sample_entropy"),
                         (entropy + F.ln(2 * F.col("r"))).alias("en_quadratic_entropy"))


def _range_counts(o: DataFrame, rth: float) -> DataFrame:
    """Per point of windows that are not small: number of values of its window within the tolerance, itself included."""
    rows = _tolerant(o, KEYS, rth).where(F.col("n") > SMALL)
    x, r = F.col("x"), F.col("r")
    # at equal values a lower probe comes before the points and an upper probe after them
    marks = F.array(*[F.struct(v.alias("v"), F.lit(kind).alias("kind"))
                      for v, kind in ((x - r, 0), (x, 1), (x + r, 2))])
    seen = rows.select(*KEYS, "i", "n", F.inline(marks)).withColumn(
        "below", F.sum((F.col("kind") == 1).cast("long")).over(upto("v", "kind")))
    return seen.groupBy(*KEYS, "i").agg(
        (F.max(F.when(F.col("kind") == 2, F.col("below")))
         - F.max(F.when(F.col("kind") == 0, F.col("below")))).alias("hits"), F.max("n").alias("n"))


def _phis(xs, r) -> float | None:
    """Difference of the mean log shares of neighbours of single values and of pairs of values."""
    import numpy as np

    n, ordered = len(xs), np.sort(xs)
    # the ends of the range are worked out as in ``_range_counts``
    one = np.searchsorted(ordered, xs + r, "right") - np.searchsorted(ordered, xs - r, "left")
    with np.errstate(invalid="ignore"):
        near = np.abs(xs[:, None] - xs) <= r
    two = np.count_nonzero(near[:-1, :-1] & near[1:, 1:], axis=1)
    if n < 2 or not (one.all() and two.all()):
        return None
    return float(np.log(one / n).mean() - np.log(two / (n - 1)).mean())


def approximate_entropy(o: DataFrame, rth: float = 0.2) -> DataFrame:
    """Approximate entropy with template lengths 1 and 2."""
    windows = _arrays(_tolerant(o, KEYS, rth), KEYS)
    small = _per_window(windows, KEYS, {"en_apen": "double"}, lambda xs, r: [(_phis(xs, r),)])
    return small.unionByName(_large_approximate_entropy(o, rth))


def _large_approximate_entropy(o: DataFrame, rth: float) -> DataFrame:
    one = _range_counts(o, rth).groupBy(*KEYS).agg(
        F.avg(F.ln(F.col("hits") / F.col("n"))).alias("phi1"))
    at = R.located(_templates(o, KEYS, rth, 2), KEYS, "x0", ["r", "n", "c", "x0", "x1"], "<=", both=True)
    rows = R.running(R.dealt(at.withColumn("q", F.col("p")), KEYS, "x1", ["r", "n", "c", "q", "x1"], "<="), KEYS, "c", ["x1"])
    met = F.expr(f"CASE kind WHEN {R.SINGLE} THEN IF({R.close('x1', 'mate.x1', '<=')}, mate.c, 0) WHEN {R.CLOSE} THEN sums WHEN {R.OPEN} THEN -sums ELSE 0 END")
    hits = rows.groupBy(*KEYS, "q").agg(F.sum(met).alias("hits"), F.max("c").alias("c"), (F.max("n") - 1).alias("m"))
    two = hits.groupBy(*KEYS).agg(
        (F.sum(F.col("c") * F.ln(F.col("hits") / F.col("m"))) / F.max("m")).alias("phi2"))
    return one.join(two, KEYS).select(*KEYS, (F.col("phi1") - F.col("phi2")).alias("en_apen"))


def multiscale_entropy(o: DataFrame, scales: range | list[int] = range(2, 11), m: int = 2,
                       rth: float = 0.15, least: int = 20) -> tuple[DataFrame, DataFrame]:
    """Sample entropy of buffer means per scale, and its summary over the scales.

    Scales that leave fewer than ``least`` buffers, or have no finite entropy, do not take part.
    """
    keys = KEYS + ["scale"]
    scales = [*scales]
    sized = o.select(*KEYS, "i", "x", F.count("*").over(per()).alias("n"))

    def small_window(xs, r):
        import numpy as np

        out = []
        for s in scales:
            full = len(xs) // s
            if full < least or full <= m:
                continue
            coarse = np.zeros(full)
            for k in range(s):  # added up in order, as Spark does
                coarse += xs[k:full * s:s]
            coarse /= s
            r = coarse.std() * rth
            if r > 0 or np.isnan(r):
                out.append((s, full, float(r), *_matches(coarse, r, m)))
        return out

    found = {"scale": "bigint", "n": "bigint", "r": "double", "a": "bigint", "b": "bigint"}
    small = _per_window(_arrays(sized.withColumn("r", F.lit(0.0)), KEYS), KEYS, found, small_window).withColumn(
        "scale", F.col("scale").cast("int"))
    long = sized.where(F.col("n") > SMALL).select(
        *KEYS, "i", "n", "x", F.explode(F.array(*[F.lit(s) for s in scales])).alias("scale"))
    full = F.floor(F.col("n") / F.col("scale"))
    coarse = long.where((full >= least) & (F.col("i") < full * F.col("scale"))).groupBy(
        *keys, F.floor(F.col("i") / F.col("scale")).alias("i")).agg(F.avg("x").alias("x"))
    counts = small.unionByName(_match_counts(_tolerant(coarse, keys, rth), keys, m)).unionByName(_large_matches(coarse, m, rth, keys))
    each = _sample_entropies(counts, m, keys).select(
        *keys, F.when(F.col("en_sample_entropy") < float("inf"), F.col("en_sample_entropy")).alias("e"))
    e = F.col("e")
    change = e - F.lag("e").over(by("scale"))
    top = F.row_number().over(by("down", "scale"))
    low = F.row_number().over(by("e", "scale"))
    ranked = each.where(e.isNotNull()).withColumn("down", -e).withColumns(
        {"change": change, "top": top, "low": low})
    whole = ranked.groupBy(*KEYS).agg(
        F.max(e).alias("en_mse_max"), F.max(F.when(F.col("top") == 1, F.col("scale"))).alias("en_mse_max_at"),
        F.min(e).alias("en_mse_min"), F.max(F.when(F.col("low") == 1, F.col("scale"))).alias("en_mse_min_at"),
        F.avg(e).alias("en_mse_mean"), F.stddev_pop(e).alias("en_mse_std"),
        F.avg("change").alias("en_mse_mean_change"))
    return each.withColumnRenamed("e", "en_mse"), whole


def permutation_entropy(led: DataFrame, m: int = 2, tau: int = 1) -> DataFrame:
    """Entropy of ordinal patterns, in bits and as a share of its maximum. Ties rank by position.

    Needs the lags tau, 2 tau, ..., (m - 1) tau.
    """
    parts = [F.col("x" if k == 0 else f"x{k * tau}").alias(f"p{k}") for k in range(m)]
    emb = led.select(*KEYS, *parts).where(F.col(f"p{m - 1}").isNotNull())

    def rank(k: int) -> Column:
        before = [F.col(f"p{j}") <= F.col(f"p{k}") for j in range(k)]
        after = [F.col(f"p{j}") < F.col(f"p{k}") for j in range(k + 1, m)]
        return sum((c.cast("int") for c in before + after), F.lit(0))

    word = F.concat_ws("-", *[rank(k).cast("string") for k in range(m)])
    counted = emb.groupBy(*KEYS, word.alias("word")).agg(F.count("*").cast("double").alias("c"))
    total = F.sum("c")
    bits = F.log2(total) - F.sum(F.col("c") * F.log2("c")) / total
    return counted.groupBy(*KEYS).agg(
        bits.alias(f"en_permen_{m}_{tau}"),
        (bits / math.log2(math.factorial(m))).alias(f"en_permen_norm_{m}_{tau}"))


def complexity_invariant(o: DataFrame) -> DataFrame:
    """Complexity estimates of the series, of its sorted values, and their ratios."""
    d = o.select(*KEYS, (F.col("x") - F.lag("x").over(by("i"))).alias("a"),
                 (F.col("x") - F.lag("x").over(by("x"))).alias("b"))

    def first(c: str) -> Column:
        return F.sqrt(F.avg(1 + F.col(c) * F.col(c)))

    def second(c: str) -> Column:
        return F.avg(F.sqrt(1 + F.col(c) * F.col(c)))

    return d.groupBy(*KEYS).agg(
        first("a").alias("en_cid_ce1"), second("a").alias("en_cid_ce2"),
        first("b").alias("en_cid_mince1"), second("b").alias("en_cid_mince2"),
        (first("a") / first("b")).alias("en_cid_ce1_norm"),
        (second("a") / second("b")).alias("en_cid_ce2_norm"))


def entropy_of(shares: list[str]) -> str:
    """SQL text of the natural-log entropy of the named shares; a share of 0 adds nothing."""
    return "-(" + " + ".join(f"CASE WHEN {p} > 0 THEN {p} * ln({p}) ELSE 0D END" for p in shares) + ")"
