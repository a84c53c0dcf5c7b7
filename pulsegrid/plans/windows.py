"""From points to overlapping windows.

Input is ``points(series STRING, t DOUBLE, y DOUBLE)`` with ``y`` NULL where a reading is missing.
A window ``w`` of a series ends at ``t0 + length + step * w`` (``t0`` = first time of that series),
lasts ``length`` seconds, is open on the left and closed on the right, and its end is truncated to
a whole second when points are picked. Ends lie strictly before the last time of the series.

Series may be of any size: the work on a series is cut into chunks of time, so that a series that
holds a large part of all rows is spread over many tasks. Only a small table with one row per chunk
is ordered by series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS, by, combine


def default_chunk(length: float, ordered: bool) -> float:
    """Length in time of the pieces a series is cut into.

    Pieces whose rows are put in order are short, so that a crowded series makes many small tasks; where only
    the bounds of the series are attached, long ones keep the table of pieces small.
    """
    return length / 16 if ordered else length * 4



def _chunked(points: DataFrame, chunk: float) -> DataFrame:
    return points.withColumn("chunk", F.floor(F.col("t") / F.lit(float(chunk))))


def _chunk_table(chunked: DataFrame) -> DataFrame:
    """Per chunk: bounds and mean of its series, last reading and numbers of rows and readings before it."""
    seen = F.col("y").isNotNull()
    small = chunked.groupBy("series", "chunk").agg(
        F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("*").alias("rows"),
        F.sum("y").alias("total"), F.count("y").alias("readings"),
        F.max_by(F.when(seen, F.col("y")), F.when(seen, F.struct("t", "y"))).alias("last_y"))  # ties as inside a chunk
    whole = Window.partitionBy("series")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return small.select(
        "series", "chunk",
        F.min("lo").over(whole).alias("t0"), F.max("hi").over(whole).alias("t1"),
        F.try_divide(F.sum("total").over(whole), F.sum("readings").over(whole)).alias("c"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("readings").over(before), F.lit(0)).alias("readings_before"),
        F.last("last_y", ignorenulls=True).over(before).alias("carry"))


def _inside_chunk():
    return Window.partitionBy("series", "chunk").orderBy("t", "y")


def _filled(chunked: DataFrame, table: DataFrame, impute: bool) -> DataFrame:
    """Adds the series' bounds and ``yf``, the reading to use."""
    if not impute:
        return chunked.join(table, ["series", "chunk"]).withColumn("yf", F.col("y"))
    inside = _inside_chunk().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunked.withColumn("local", F.last("y", ignorenulls=True).over(inside))
    return local.join(table, ["series", "chunk"]).withColumn("yf", F.coalesce("local", "carry")).drop("local")


def numbered(points: DataFrame, chunk: float, impute: bool = True) -> DataFrame:
    """Adds ``yf``, ``c``, ``t0``, ``t1`` and ``g``, the 0-based position of a row in its series.

    A missing reading that is not filled takes no position.
    """
    chunked = _chunked(points, chunk)
    inside = _inside_chunk()
    upto_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(inside) if impute else F.count("y").over(upto_here)
    before = F.col("rows_before" if impute else "readings_before")
    filled = _filled(chunked.withColumn("r", place), _chunk_table(chunked), impute)
    return filled.withColumn("g", before + F.col("r") - 1)


def carry_forward(points: DataFrame, chunk: float = 86400.0) -> DataFrame:
    """Adds ``yf``: the last reading at or before each point, NULL before the first reading.

    Points of equal time count by value, missing ones first.

    Exact for any ``chunk``; it only sets how finely a long series is split.
    """
    chunked = _chunked(points, chunk)
    return _filled(chunked, _chunk_table(chunked), True).select("series", "t", "y", "yf")


def _window_count(t0: Column, t1: Column, length: float, step: float) -> Column:
    return F.greatest(F.ceil((t1 - t0 - F.lit(float(length))) / F.lit(float(step))), F.lit(0))


def window_spine(points: DataFrame, length: float, step: float) -> DataFrame:
    """``(series, w, w_end)`` for every window, also the empty ones."""
    bounds = points.groupBy("series").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    count = _window_count(F.col("t0"), F.col("t1"), length, step)
    ends = bounds.withColumn("n_w", count).where("n_w > 0").select(
        "series", "t0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_w") - 1)).alias("w"))
    return ends.select("series", "w",
                       (F.col("t0") + float(length) + F.col("w") * float(step)).alias("w_end"))


def spread_over_windows(rows: DataFrame, length: float, step: float) -> DataFrame:
    """Repeats each row for every window that contains it; adds ``w`` and ``edge``, the window's whole-second end.

    ``rows`` carry ``t`` and the bounds ``t0``, ``t1`` of their series. A row tries only the few windows that
    can hold it; exact bounds decide.
    """
    length, step = float(length), float(step)
    offset = (F.col("t") - F.col("t0") - length) / step
    lo = F.greatest(F.floor(offset), F.lit(0))
    hi = F.least(F.floor(offset + (length + 1.0) / step),
                 _window_count(F.col("t0"), F.col("t1"), length, step) - 1)
    tried = rows.select("*", lo.alias("lo"), hi.alias("hi")).where("lo <= hi").withColumn(
        "w", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    edge = (F.col("t0") + length + F.col("w") * step).cast("long")
    return tried.withColumn("edge", edge).where("t <= edge").where(F.col("t") > F.col("edge") - length)


def windowed(points: DataFrame, length: float, step: float, impute: bool = True,
             chunk: float | None = None) -> DataFrame:
    """``(series, w, t, y, yf)``: every point once per window that contains it.

    With ``impute`` a missing reading takes the last one seen in the series, also from before the window.
    Without it ``yf`` equals ``y``.
    """
    chunked = _chunked(points, chunk or default_chunk(length, impute))
    ready = _filled(chunked, _chunk_table(chunked), impute).select("series", "t", "y", "yf", "t0", "t1")
    return spread_over_windows(ready, length, step).select("series", "w", "t", "y", "yf")


def ordered(win: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """``(series, w, t, x, i)``: filled values with their 0-based position in the window."""
    rows = win.where(F.col("yf").isNotNull()).select(*keys, "t", F.col("yf").alias("x"))
    return rows.withColumn("i", F.row_number().over(by("t", "x", keys=keys)) - 1)


def observed(win: DataFrame) -> DataFrame:
    """``(series, w, t, x)``: readings that are really there."""
    return win.where(F.col("y").isNotNull()).select(*KEYS, "t", F.col("y").alias("x"))


def per_window(spine: DataFrame, features: DataFrame) -> DataFrame:
    """Every window of the spine with its end as ``time``; empty windows keep only ``time``."""
    return combine([spine, features]).withColumnRenamed("w_end", "time")
