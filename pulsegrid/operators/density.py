"""Kernel density and periodogram features.

Spark groups the points into windows and computes all features; two short numpy helpers supply, per
Arrow batch of windows, the density on a grid and the best fit of a sine.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS, div

#: Positions of a window whose part of the density is one piece of work.
BLOCK = 4096


def _kernel_sums(x, grid, width):
    """Sum of the unscaled kernels of the values at each grid point."""
    import numpy as np

    total = np.zeros(len(grid))
    for at in range(0, len(x), 2048):  # bounded working memory for any window
        total += np.exp(-0.5 * ((grid[:, None] - x[at:at + 2048]) / width) ** 2).sum(axis=1)
    return total


#: Windows whose densities go back to Spark in one batch.
ROWS = 64


def _with_density(wide: DataFrame, points: int) -> DataFrame:
    """Replaces ``xs`` by the density ``f`` on ``points`` numbers; a task holds the densities of ``ROWS`` windows, however many it has."""
    import pyarrow as pa

    kept = [c for c in wide.columns if c != "xs"]

    def run(batches):
        import numpy as np

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                xs, h = b.column("xs"), b.column("h").to_pylist()
                out = []
                for k, width in enumerate(h):
                    if not xs[k].is_valid or width is None or not width > 0:
                        out.append(None)
                        continue
                    x = xs[k].values.to_numpy(zero_copy_only=False)
                    grid = np.linspace(x.min(), x.max(), points)
                    out.append(_kernel_sums(x, grid, width) / (len(x) * width * math.sqrt(2 * math.pi)))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(out, pa.list_(pa.float64()))], [*kept, "f"])

    kinds = [f"`{c}` {wide.schema[c].dataType.simpleString()}" for c in kept]
    return wide.select(*kept, "xs").mapInArrow(run, ", ".join([*kinds, "f array<double>"]))


def best_sine(d, finer: int = 4):
    """Largest share of the variance of centred values that a sine with a constant explains (least squares).

    Frequencies from one to n / 2 cycles in the window, ``finer`` times as close as whole cycles. A padded FFT gives the
    sums with the values; sums of sines alone have closed forms.
    """
    import numpy as np

    n = len(d)
    size = finer * n
    j = np.arange(finer, size // 2 + 1)
    if not len(j):
        return None
    theta = 2 * np.pi * j / size
    spectrum = np.fft.rfft(d, size)[j]

    def sums(angle):  # of cos and sin of angle * i for i below n
        low = np.sin(angle / 2)
        flat = np.abs(low) < 1e-9
        ratio = np.where(flat, 0.0, np.sin(n * angle / 2) / np.where(flat, 1.0, low))
        return np.where(flat, float(n), ratio * np.cos((n - 1) * angle / 2)), ratio * np.sin((n - 1) * angle / 2)

    (c, s), (c2, s2) = sums(theta), sums(2 * theta)
    cc, ss, cs = (n + c2) / 2 - c * c / n, (n - c2) / 2 - s * s / n, s2 / 2 - c * s / n
    xc, xs = spectrum.real, -spectrum.imag
    det = cc * ss - cs * cs
    one = det < 1e-6 * n * n  # at n / 2 cycles there is no sine part
    both = (xc * xc * ss - 2 * xc * xs * cs + xs * xs * cc) / np.where(one, 1.0, det)
    return float(np.max(np.where(one, xc * xc / np.maximum(cc, 1e-9), both)) / np.dot(d, d))


def _best_sine_udf():
    def best(xs: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([best_sine(np.asarray(x, dtype="float64")) for x in xs], dtype="float64")

    return F.pandas_udf(best, "double")


def kernel_density(vec: DataFrame, points: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Gaussian density (Scott's width) on evenly spaced points from the window's minimum to its maximum.

    ``carry`` names further columns to hand on.
    """
    n = F.col("n")
    sd1 = F.col("sd") * F.sqrt(div(n, n - 1))
    wide = vec.where("n > 1 and sd > 0").select(
        *KEYS, *carry, "n", "mu", "sd", "xs", (sd1 * F.pow(n.cast("double"), F.lit(-0.2))).alias("h"),
        F.array_min("xs").alias("lo"), F.array_max("xs").alias("hi"))
    return _with_density(wide.withColumn("dx", (F.col("hi") - F.col("lo")) / (points - 1)), points)


def large_density(o: DataFrame, points: int, dist: str = "norm", block: int = BLOCK) -> DataFrame:
    """``kernel_density`` of ``ordered`` rows for windows of any size (``beta``: of the squeezed values, with the fitted shape).

    Blocks of a window's positions add up their own part of the density, and the parts are added per grid point; a window
    is never one row, cell or group. What is left per window are ``points`` numbers.
    """
    import pyarrow as pa

    stats = o.groupBy(*KEYS).agg(F.count("x").cast("int").alias("n"), F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"),
                                 F.min("x").alias("lo"), F.max("x").alias("hi")).where("n > 1 and sd > 0")
    carry = ()
    # a squeezed value is (x - from) / width
    stats = stats.withColumns({"from": F.lit(0.0), "width": F.lit(1.0)})
    if dist == "beta":
        stats = stats.withColumns({"from": F.col("lo") - 0.01 * F.col("sd"), "width": F.col("hi") - F.col("lo") + 0.02 * F.col("sd")})
        squeezed = lambda c: (F.col(c) - F.col("from")) / F.col("width")
        stats = _beta_shape(stats.withColumns({"mu": squeezed("mu"), "lo": squeezed("lo"), "hi": squeezed("hi"),
                                               "sd": F.col("sd") / F.col("width")}))
        carry = ("al", "be", "lb")
    n = F.col("n")
    stats = stats.withColumn("h", F.col("sd") * F.sqrt(n / (n - 1)) * F.pow(n.cast("double"), F.lit(-0.2)))
    placed = o.join(stats, KEYS).select(
        F.col("series").cast("string").alias("series"), F.col("w").cast("bigint").alias("w"), F.floor(F.col("i") / block).alias("b"),
        ((F.col("x") - F.col("from")) / F.col("width")).alias("x"), "lo", "hi", "h")

    def part(key, table):
        import numpy as np

        series, w, _ = (k.as_py() for k in key)
        lo, hi, h = (table[c][0].as_py() for c in ("lo", "hi", "h"))
        return pa.table({"series": pa.array([series], pa.string()), "w": pa.array([w], pa.int64()),
                         "f": pa.array([_kernel_sums(table["x"].to_numpy(), np.linspace(lo, hi, points), h)], pa.list_(pa.float64()))})

    parts = placed.groupBy(*KEYS, "b").applyInArrow(part, "series string, w bigint, f array<double>")
    sums = parts.select(*KEYS, F.posexplode("f").alias("k", "f")).groupBy(*KEYS, "k").agg(F.sum("f").alias("f"))
    whole = sums.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("k", "f"))).alias("p"))  # ``points`` numbers
    scale = n * F.col("h") * math.sqrt(2 * math.pi)
    return stats.join(whole, KEYS).select(
        *KEYS, *carry, "n", "mu", "sd", "lo", "hi", "h", ((F.col("hi") - F.col("lo")) / (points - 1)).alias("dx"),
        F.transform("p.f", lambda v: v / scale).alias("f"))


# fixed values: Lanczos coefficients for g = 7
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
           -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
           1.5056327351493116e-7)


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0, from ln Gamma(x + 1) - ln x so that the series is used at or above 1."""
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], start=1):
        total = total + c / (x + k)
    edge = x + 7.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * F.ln(edge) - edge + F.ln(total) - F.ln(x)


def _scaled(vec: DataFrame) -> DataFrame:
    """Values squeezed into (0, 1), with the beta shape ``al``, ``be`` of the same mean and variance.

    ``lb`` is the log of its normalising constant, known before any grid point is looked at.
    """
    wide = vec.where("sd > 0").select(
        *KEYS, "n", "xs", "mu", F.col("sd").alias("sd0"), F.array_min("xs").alias("lo"),
        (F.array_max("xs") - F.array_min("xs") + 0.02 * F.col("sd")).alias("width"))
    xs = F.transform("xs", lambda x: (x - F.col("lo") + 0.01 * F.col("sd0")) / F.col("width"))
    unit = wide.select(*KEYS, "n", xs.alias("xs"), (F.col("sd0") / F.col("width")).alias("sd"),
                       ((F.col("mu") - F.col("lo") + 0.01 * F.col("sd0")) / F.col("width")).alias("mu"))
    return _beta_shape(unit)


def _beta_shape(unit: DataFrame) -> DataFrame:
    mu, sd = F.col("mu"), F.col("sd")
    both = mu * (1 - mu) / (sd * sd) - 1
    shaped = unit.withColumns({"al": mu * both, "be": (1 - mu) * both})
    return shaped.withColumn(
        "lb", log_gamma(F.col("al")) + log_gamma(F.col("be")) - log_gamma(F.col("al") + F.col("be")))


def compare_fit(vec: DataFrame, dist: str = "norm", points: int = 1000) -> DataFrame:
    """Distance between the kernel density and a fitted normal, uniform or beta density.

    The beta shape comes from the mean and variance of the squeezed values. A window is one row here;
    ``large_compare_fit`` spreads it.
    """
    if dist == "beta":
        return _compare(kernel_density(_scaled(vec), points, ("al", "be", "lb")), dist, points)
    return _compare(kernel_density(vec, points), dist, points)


def large_compare_fit(o: DataFrame, dist: str = "norm", points: int = 1000, block: int = BLOCK) -> DataFrame:
    """``compare_fit`` of ``ordered`` rows for windows of any size."""
    return _compare(large_density(o, points, dist, block), dist, points)


def _compare(grid: DataFrame, dist: str, points: int) -> DataFrame:
    mu, sd, lo, dx = (F.col(c) for c in ("mu", "sd", "lo", "dx"))
    if dist == "norm":
        fit = lambda x: F.exp(-0.5 * F.pow((x - mu) / sd, F.lit(2.0))) / (sd * math.sqrt(2 * math.pi))
    elif dist == "uni":
        fit = lambda x: 1 / (F.col("hi") - lo)
    else:
        fit = lambda x: F.exp((F.col("al") - 1) * F.ln(x) + (F.col("be") - 1) * F.ln(1 - x) - F.col("lb"))
    steps = F.sequence(F.lit(0), F.lit(points - 1))
    both = grid.withColumn("g", F.transform(steps, lambda k: fit(lo + k * dx)))
    gap = F.aggregate(F.zip_with("f", "g", lambda u, v: F.abs(u - v)), F.lit(0.0), lambda s, v: s + v)
    rel = F.aggregate(F.zip_with("f", "g", lambda u, v: F.when((u > 0) & (v > 0), u * F.ln(u / v)).otherwise(
        F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    name = "dn_compareksfit_" + ("" if dist == "norm" else f"{dist}_")
    return both.select(*KEYS, (gap * dx).alias(f"{name}adiff"),
                       (F.array_max("g") - F.array_max("f")).alias(f"{name}peaksepy"),
                       (rel * dx).alias(f"{name}relent"))


def kernel_shape(vec: DataFrame, numcross: tuple[float, ...] = (), area: tuple[float, ...] = (),
                 arclength: tuple[float, ...] = (), points: int = 100) -> DataFrame:
    """Peaks, height, entropy and asymmetry of the kernel density; optional counts per threshold."""
    return _shape(kernel_density(vec, points), numcross, area, arclength, points)


def large_kernel_shape(o: DataFrame, numcross: tuple[float, ...] = (), area: tuple[float, ...] = (),
                       arclength: tuple[float, ...] = (), points: int = 100, block: int = BLOCK) -> DataFrame:
    """``kernel_shape`` of ``ordered`` rows for windows of any size."""
    return _shape(large_density(o, points, block=block), numcross, area, arclength, points)


def _shape(grid: DataFrame, numcross, area, arclength, points: int) -> DataFrame:
    f, lo, dx, mu = F.col("f"), F.col("lo"), F.col("dx"), F.col("mu")
    last = points - 1

    def total(steps: Column) -> Column:
        return F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)

    def at(k) -> Column:
        return lo + k * dx

    everywhere = F.sequence(F.lit(0), F.lit(last))
    inner = F.sequence(F.lit(1), F.lit(last - 1))
    pairs = F.sequence(F.lit(0), F.lit(last - 1))

    def turns(k):
        before, after = f[k] - f[k - 1], f[k + 1] - f[k]
        return (before * after < 0) & (after - before < -0.0002)

    def mass(test):
        return total(F.transform(F.filter(everywhere, test), lambda k: f[k]))

    def arc(test):
        return total(F.transform(F.filter(pairs, lambda k: test(k) & test(k + 1)), lambda k: F.abs(f[k + 1] - f[k])))

    above, below = (lambda k: at(k) > mu), (lambda k: at(k) < mu)
    out = {
        "npeaks": F.size(F.filter(inner, turns)), "max": F.array_max(f),
        "entropy": -dx * total(F.transform(f, lambda v: F.when(v > 0, v * F.ln(v)).otherwise(F.lit(0.0)))),
        "asym": div(mass(above), mass(below)), "plsym": div(arc(below), arc(above)),
    }
    for c in numcross:
        out[f"numcross_{c:g}"] = F.size(F.filter(pairs, lambda k: (f[k] - c) * (f[k + 1] - c) < 0))
    for c in area:
        out[f"area_{c:g}"] = dx * mass(lambda k: f[k] < c)
    for c in arclength:
        out[f"arclength_{c:g}"] = dx * arc(lambda k: (at(k) > mu - c) & (at(k) < mu + c))
    return grid.select(*KEYS, *[c.alias("dn_fitkernal_" + k.replace(".", "_")) for k, c in out.items()])


def seasonal(vec: DataFrame, level: float = 0.3) -> DataFrame:
    """Whether one sine explains more than ``level`` of the variance.

    A global search over frequencies a quarter of a cycle apart, so a cycle need not fit the window a whole number of
    times, and nothing depends on starting values.
    """
    r2 = F.col("seasonal_r2")
    return vec.where("n > 1 and sd > 0").select(*KEYS, _best_sine_udf()("ds").alias("seasonal_r2")).select(
        *KEYS, r2, (r2 > level).alias("isseasonal"))


__all__ = ["compare_fit", "kernel_density", "kernel_shape", "large_compare_fit", "large_density", "large_kernel_shape", "log_gamma", "seasonal"]
