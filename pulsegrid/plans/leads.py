"""Rows with the values that follow them: ``(series, w, t, x, c, x1, x2, ...)``.

``x{k}`` is the value ``k`` positions later, NULL past the end of the window; ``c`` is a centre near the mean.
Lag operators are expressions on such rows and one aggregation. Two ways to make them:

* ``window_leads`` orders each window; right when a window is a modest piece of work.
* ``series_leads`` looks ahead in the series before windows are formed. A series is cut into blocks of equal
  row count that overlap by the longest lag, so a crowded series or window is spread over many tasks, raw
  rows are shuffled before they are repeated per window, and windows are merged from partial sums.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS, by, per
from pulsegrid.plans.windows import default_chunk, numbered, spread_over_windows

BLOCK_ROWS = 65536


def window_leads(o: DataFrame, lags: Iterable[int]) -> DataFrame:
    """Look-ahead inside each window of ``ordered(win)``; ``c`` is the window's mean."""
    return o.select(*KEYS, "t", "x", F.avg("x").over(per()).alias("c"),
                    *[F.lead("x", k).over(by("i")).alias(f"x{k}") for k in lags])


def series_leads(points: DataFrame, length: float, step: float, lags: Iterable[int], impute: bool = True,
                 chunk: float | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """Look-ahead in the series, cut off at the end of each window; ``c`` is the series' mean.

    Equal to ``window_leads`` up to ``c``, for any ``chunk`` and any ``block`` above the longest lag.
    """
    lags = list(lags)
    if max(lags) >= block:
        raise ValueError("block must exceed the longest lag")
    rows = numbered(points, chunk or default_chunk(length, True), impute).where("yf is not null")
    home = F.floor(F.col("g") / F.lit(block))
    also = F.when((F.col("g") % block < max(lags)) & (home > 0), home - 1)
    # the first rows of a block are also needed at the end of the block before
    placed = rows.select("series", "t", F.col("yf").alias("x"), "c", "t0", "t1", "g", home.alias("home"),
                         F.explode(F.array_compact(F.array(home, also))).alias("block"))
    ahead = Window.partitionBy("series", "block").orderBy("g")
    led = placed.select(
        "series", "t", "x", "c", "t0", "t1", "home", "block",
        *[F.lead("x", k).over(ahead).alias(f"x{k}") for k in lags],
        *[F.lead("t", k).over(ahead).alias(f"at{k}") for k in lags]).where("home = block")
    spread = spread_over_windows(led, length, step)
    return spread.select(*KEYS, "t", "x", "c", *[
        F.when(F.col(f"at{k}") <= F.col("edge"), F.col(f"x{k}")).alias(f"x{k}") for k in lags])


def own_lag_leads(o: DataFrame, found: DataFrame, lag: str, times: int = 1) -> DataFrame:
    """Rows of ``ordered(win)`` with ``tau``, the window's own lag (column ``lag`` of ``found``), and the values ``tau``, 2 ``tau``, ...
    positions later as ``xtau``, ``x2tau``, ...: NULL past the end of the window.

    Every row asks for the position it needs, and positions meet in equi-joins, so rows of a window may lie in any task.
    """
    keyed = o.join(found.select(*[F.col(k).alias(f"f_{k}") for k in KEYS], F.col(lag).alias("tau")),
                   (F.col("series") == F.col("f_series")) & (F.col("w") == F.col("f_w")))
    led = keyed.select(*KEYS, "i", "x", "tau")
    for n in range(1, times + 1):
        name = f"x{n if n > 1 else ''}tau"
        there = o.select(*[F.col(k).alias(f"y_{k}") for k in KEYS], F.col("i").alias("y_i"), F.col("x").alias(name))
        led = led.join(there, (F.col("series") == F.col("y_series")) & (F.col("w") == F.col("y_w"))
                       & (F.col("i") + n * F.col("tau") == F.col("y_i")), "left").drop("y_series", "y_w", "y_i")
    return led
