"""Expressions over a window held as one array column.

A window is bounded by its length in time, so its ordered values fit in a row. Searches that stop
early, lags that differ per window and recurrences are narrow expressions on that row: nothing
is shuffled after the array has been built, and no pairs of rows are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS


def vectors(o: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per window of ``ordered(win)``: values ``xs`` by position, centred ``ds``, ``n``, ``mu``, ``sd``."""
    packed = o.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("i", "x"))).alias("p"),
        F.count("x").alias("n"), F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"))
    return packed.select(*keys, F.col("n").cast("int").alias("n"), "mu", "sd",
                         F.col("p.x").alias("xs")).withColumn(
        "ds", F.transform("xs", lambda x: x - F.col("mu")))


#: Items after which a list that grows inside an expression is put aside.
FOLD = 256


def states_before(items: Column, zero: Column, step, kind: str = "bigint") -> Column:
    """The state before each item of an array, for a state of type ``kind`` that starts as ``zero`` and becomes ``step(state, item)``.

    A first fold keeps the states at the starts of blocks, a second the states inside each block, so no list that is copied
    at every step grows beyond a block or the number of blocks.
    """
    empty = F.array().cast(f"array<{kind}>")
    pair = lambda at, out: F.struct(at.cast(kind).alias("at"), out.alias("out"))

    def states(xs: Column) -> Column:
        block = lambda b: F.slice(xs, b * FOLD + 1, F.lit(FOLD))
        blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(xs) - 1) / FOLD).cast("int"), F.lit(0)))
        starts = F.aggregate(blocks, pair(zero, empty), lambda acc, b: pair(
            F.aggregate(block(b), acc["at"], lambda q, x: step(q, x).cast(kind)), F.concat(acc["out"], F.array(acc["at"]))), lambda acc: acc["out"])
        return F.flatten(F.transform(starts, lambda start, b: F.aggregate(block(b), pair(start, empty), lambda acc, x: pair(
            step(acc["at"], x), F.concat(acc["out"], F.array(acc["at"]))), lambda acc: acc["out"])))

    return F.transform(F.array(items), states)[0]


def lag_dot(xs: Column, n: Column, k) -> Column:
    """Sum of x[j] * x[j + k] over the positions where both exist; NULL when the lag is too long."""
    total = F.aggregate(F.sequence(F.lit(0), n - 1 - k), F.lit(0.0),
                        lambda acc, j: acc + xs[j] * xs[j + k])
    return F.when(n > k, total)


def first_zero(ds: Column, n: Column) -> Column:
    """First lag in 1..n-2 with a negative autocorrelation, else n. ``ds`` must be centred.

    Lags after the hit are not evaluated.
    """
    hit = F.aggregate(
        F.sequence(F.lit(1), n - 2), F.lit(0),
        lambda found, k: F.when(found > 0, found).when(lag_dot(ds, n, k) < 0, k).otherwise(F.lit(0)))
    return F.when((n >= 3) & (hit > 0), hit).otherwise(n)


def mean_of(xs: Column) -> Column:
    """Mean of an array; NULL when empty."""
    return F.try_divide(F.aggregate(xs, F.lit(0.0), lambda a, x: a + x), F.size(xs))


def std_of(xs: Column, mean: Column) -> Column:
    """Population standard deviation of an array around a given mean."""
    return F.sqrt(F.try_divide(
        F.aggregate(xs, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)), F.size(xs)))


def quantile_of(ordered: Column, p: float) -> Column:
    """Linear-interpolation quantile of an ascending array; NULL when empty."""
    at = F.lit(p) * (F.size(ordered) - 1)
    lo = F.floor(at).cast("int")
    below = F.get(ordered, lo)
    return below + (at - lo) * (F.coalesce(F.get(ordered, lo + 1), below) - below)
