"""First lags at which a window's self-correlation does something, searched in ranges of lags that double."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS, by, per
from pulsegrid.plans.staging import staged

#: Lags of the first range, and positions of a window that are one piece of work.
FIRST, BLOCK = 32, 4096

#: Searches, as the lag that a row of ``f``, ``f1``, ``f2`` (the value at this lag and the two before) gives, or NULL.
_RISE = "CASE WHEN k = 2 AND {f} > {f}1 AND n >= 4 THEN 1 WHEN k > 2 AND k <= n - 2 AND {f}2 > {f}1 AND {f}1 < {f} THEN k - 1 END"
SEARCHES = {
    "co_f1ecac": f"CASE WHEN k <= n - 2 AND r < {1 / math.e!r}D THEN k END",
    "co_firstmin": _RISE.format(f="s"),
    "co_firstzero": "CASE WHEN k <= n - 2 AND s < 0 THEN k END",
    "co_firstmin_mi": _RISE.format(f="q"),
}


def lag_sums(centred: DataFrame, low: int, high: int, block: int = BLOCK) -> DataFrame:
    """Per window and lag ``k`` from ``low`` to ``high``: ``s``, the sum of products, and sums and squares of the first and last k values.

    A window is cut into blocks of positions that overlap by the longest lag; each block adds up its own part, and the
    parts of a window are added by an aggregate.
    """
    import pyarrow as pa

    size = max(block, high)
    home = F.floor(F.col("i") / size)
    also = F.when((F.col("i") % size < high) & (home > 0), home - 1)
    placed = centred.select(*KEYS, "n", "i", "d", F.explode(F.array_compact(F.array(home, also))).alias("block"))

    def run(key, table):
        series, w, b = (k.as_py() for k in key)
        i, n, base = table["i"].to_numpy(), table["n"][0].as_py(), b * size
        d = table["d"].to_numpy()[np.argsort(i)]
        own = min(len(d), size)
        k = np.arange(low, min(high, n - 1) + 1)
        s = [float(d[:m] @ d[x:x + m]) if (m := min(own, len(d) - x)) > 0 else 0.0 for x in k.tolist()]
        sums = [np.concatenate([[0.0], np.cumsum(v[:own])]) for v in (d, d * d)]
        first, last = np.clip(k - base, 0, own), np.clip(n - k - base, 0, own)
        columns = [s, *(c[first] for c in sums), *(c[own] - c[last] for c in sums)]
        return pa.table({"series": pa.array([series] * len(k), pa.string()), "w": pa.array([w] * len(k), pa.int64()), "k": pa.array(k, pa.int64()),
                         **{c: pa.array(v, pa.float64()) for c, v in zip(("s", "h1", "h2", "t1", "t2"), columns)}})

    parts = placed.groupBy(*KEYS, "block").applyInArrow(
        run, "series string, w bigint, k bigint, s double, h1 double, h2 double, t1 double, t2 double")
    return parts.groupBy(*KEYS, "k").agg(*[F.sum(c).alias(c) for c in ("s", "h1", "h2", "t1", "t2")])


def first_lags(o: DataFrame, names: tuple[str, ...] | list[str] = ("co_f1ecac", "co_firstmin", "co_firstzero"), delays: int | None = None,
               block: int = BLOCK) -> DataFrame:
    """Per window the first lag of each of the ``SEARCHES`` named; its number of values where no lag up to n - 2 (or ``delays``) does it.

    Lags are searched in ranges that double; a window leaves when all its searches have ended, so long lags are worked out only
    for windows that need them. The windows are staged, and each range is a job: jobs grow with the logarithm of the longest
    lag that is reached.
    """
    rows = o.select(*KEYS, "i", (F.col("x") - F.avg("x").over(per())).alias("d"), F.count("*").over(per()).alias("n"))
    rows = staged(rows.select(F.col("series").cast("string").alias("series"), F.col("w").cast("bigint").alias("w"), "i", "d", "n"))
    windows = staged(rows.groupBy(*KEYS).agg(F.max("n").alias("n"), F.sum("d").alias("d1"), F.sum(F.col("d") * F.col("d")).alias("d2")))
    last = F.col("n") - 2 if delays is None else F.least(F.col("n") - 2, F.lit(delays))
    # as centred values of the first n - k rows and of the last: a correlation without variance is NULL
    m, a, b, aa, bb = "(n - k)", "(d1 - t1)", "(d1 - h1)", "(d2 - t2)", "(d2 - h2)"
    r = f"try_divide(s - {a} * {b} / {m}, sqrt(({aa} - {a} * {a} / {m}) * ({bb} - {b} * {b} / {m})))"
    out, open_, low, high = None, windows.where(last >= 1), 1, FIRST
    while not open_.isEmpty():
        some = rows.join(open_.select(*KEYS), KEYS, "left_semi")
        sums = lag_sums(some, max(1, low - 2), high, block).join(open_.select(*KEYS, "n", "d1", "d2"), KEYS).where(F.col("k") <= last)
        at = sums.selectExpr(*KEYS, "n", "k", "s", f"CASE WHEN n - k > 1 THEN {r} END AS r").selectExpr("*", "r * r AS q")
        for f in ("s", "q"):
            at = at.withColumns({f"{f}1": F.lag(f).over(by("k")), f"{f}2": F.lag(f, 2).over(by("k"))})
        hits = staged(at.groupBy(*KEYS).agg(F.max("n").alias("n"), *[F.min(F.expr(SEARCHES[c])).alias(c) for c in names]))
        out = hits if out is None else staged(out.unionByName(hits).groupBy(*KEYS).agg(F.max("n").alias("n"), *[F.min(c).alias(c) for c in names]))
        missing = F.lit(False)
        for c in names:
            missing = missing | F.col(c).isNull()
        open_ = staged(windows.join(out.where(missing).select(*KEYS), KEYS, "left_semi").where(last > high))
        low, high = high + 1, 2 * high + 1
    found = windows if out is None else windows.join(out.drop("n"), KEYS, "left")
    return found.select(*KEYS, *[(F.coalesce(F.col(c), F.col("n")) if out is not None else F.col("n")).cast("int").alias(c) for c in names])
