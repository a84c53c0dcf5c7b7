"""Counting of neighbours within a tolerance, one coordinate after the other, without making pairs.

Points of a window are sorted by their first coordinate. The neighbours of a point in that coordinate are a run of
positions, and a run is made of a few aligned blocks of 8, 16, 32, ... positions and at most 14 single positions at
its ends. Every block is then a smaller problem in the coordinate that is left: it is sorted by that one, where
its neighbours are a run again. Singles are compared at once, and running sums over a block give the
count. A window of n points so makes n log n rows for two coordinates, however many
of its points are neighbours, and a crowded window is spread over its blocks.

For more coordinates rows would be n log² n and more. There a block is one row (``packed``), and numpy takes the same steps
inside it (``blocks``): a window makes some rows, not some per point, and one of many points is spread over its blocks too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.expr import per, upto
from pulsegrid.operators import blocks

#: Positions of the smallest block, as a power of two.
BITS = 3
#: Kinds of rows in a block, in their order at equal values: what opens a range, points, what closes it, single comparisons.
OPEN, POINT, CLOSE, SINGLE = range(4)
NODES = "array<struct<k:int,j:bigint,kind:int,v:double>>"
#: Positions of the smallest packed block, the columns of such blocks, and those of their pairs.
PACKED = 1 << 17
BLOCKS = {"j": "bigint", "n": "bigint", "r": "double", "a": "bigint", "b": "bigint", "points": "binary", "asked": "binary"}
PAIRS = {"n": "bigint", "r": "double", "a": "bigint", "b": "bigint"}


def close(x: str, y: str, near: str) -> str:
    """Whether two values are within the tolerance ``r``; ``near`` is < or <=."""
    return f"abs({x} - {y}) {near} r"


def ends(x: str, near: str) -> tuple[str, str]:
    """Smallest and largest value that is ``close`` to ``x``, as that comparison rounds.

    A difference rounds into the tolerance up to half a unit in its last place beyond it; the value there, or
    the outermost of its neighbours that is close, is the end.
    """
    ulp = "1.2e-16D"  # times a number: half a unit in its last place or a little more, so that adding it gives the next number
    most = f"(r - r * {ulp})" if near == "<" else "r"
    half = f"(({most} + {most} * {ulp} - {most}) / 2)"

    def last(out: str, into: str) -> str:
        end = f"({x} {out} {most} {out} {half})"
        tried = [f"({end} {out if k > 0 else into} {abs(k)} * abs({end}) * {ulp})" if k else end for k in (2, 1, 0, -1, -2, -3)]
        tried += [f"({end} {into} {k} * (abs({x}) + r) * {ulp})" for k in (1, 2, 4)]
        return "CASE " + " ".join(f"WHEN {close(x, t, near)} THEN {t}" for t in tried) + f" ELSE {x} END"

    return last("-", "+"), last("+", "-")


def _inner(lo: str, hi: str) -> tuple[str, str]:
    """First whole block of a run of positions, and the one behind the last."""
    return f"shiftright({lo} + {(1 << BITS) - 1}, {BITS})", f"shiftright({hi}, {BITS})"


def levels(lo: str, hi: str) -> str:
    """Doublings up to the largest block of a run; negative if it has none."""
    a, b = _inner(lo, hi)
    return f"CASE WHEN {a} < {b} THEN length(bin({b} - {a})) - 1 ELSE -1 END"


def _row(k: str, j: str, kind: int, v: str = "NULL") -> str:
    return f"named_struct('k', CAST({k} AS INT), 'j', CAST({j} AS BIGINT), 'kind', {kind}, 'v', CAST({v} AS DOUBLE))"


def homes(p: str, top: str, x: str) -> str:
    """A point in the blocks that hold its position, up to ``top`` doublings, and alone in a block of level 0."""
    return (f"concat(array({_row('0', p, POINT, x)}), CASE WHEN {top} >= 0 THEN transform(sequence({BITS}, {top} + {BITS}), "
            f"t -> {_row('t', f'shiftright({p}, t)', POINT, x)}) ELSE CAST(array() AS {NODES}) END)")


def cover(lo: str, hi: str, low: str, high: str) -> str:
    """What the run lo <= p < hi asks: a comparison with each of at most 14 single positions at its ends, and in the blocks of its
    middle, at most two of each size, the points from ``low`` to ``high``."""
    a, b = _inner(lo, hi)
    size, none = 1 << BITS, "CAST(array() AS array<bigint>)"
    run = lambda x, y: f"CASE WHEN {x} < {y} THEN sequence({x}, {y} - 1) ELSE {none} END"
    single = f"transform(CASE WHEN {a} >= {b} THEN {run(lo, hi)} ELSE concat({run(lo, f'{a} * {size}')}, {run(f'{b} * {size}', hi)}) END, p -> {_row('0', 'p', SINGLE)})"
    both = lambda j: f"array({_row(f's.t + {BITS}', j, OPEN, low)}, {_row(f's.t + {BITS}', j, CLOSE, high)})"
    spans = (f"transform(sequence(0, {levels(lo, hi)}), t -> named_struct('t', t, 'f', shiftright({a} + shiftleft(1L, t) - 1, t), "
             f"'l', shiftright({b}, t)))")  # at each size: its first whole block, and the one behind the last
    ask = (f"concat(CASE WHEN s.f < s.l AND s.f % 2 = 1 THEN {both('s.f')} ELSE CAST(array() AS {NODES}) END, "
           f"CASE WHEN s.f + s.f % 2 < s.l AND s.l % 2 = 1 THEN {both('s.l - 1')} ELSE CAST(array() AS {NODES}) END)")
    return f"CASE WHEN {a} < {b} THEN concat({single}, flatten(transform({spans}, s -> {ask}))) ELSE {single} END"


def located(t: DataFrame, keys: list[str], x: str, carried: list[str], near: str, both: bool) -> DataFrame:
    """Adds position ``p`` in the order of ``x``, the run ``lo``, ``hi`` of its neighbours, only those behind it unless ``both``, and
    their weight ``met``.

    ``t`` has one row per point with its tolerance ``r`` and weight ``c``, told apart by ``carried`` (all columns but the
    keys). ``top`` is how often the blocks of the window's runs are doubled at most.
    """
    low, high = ends(x, near)
    marks = [(x, POINT), (high, CLOSE), *([(low, OPEN)] if both else [])]
    rows = t.selectExpr(*keys, *carried, "inline(array(" + ", ".join(f"named_struct('v', {v}, 'kind', {kind})" for v, kind in marks) + "))")
    here = upto("v", "kind", *carried, keys=keys)
    seen = rows.withColumns({"below": F.expr(f"count_if(kind = {POINT})").over(here), "sums": F.expr(f"sum(IF(kind = {POINT}, c, 0))").over(here)})
    of = lambda kind, c: f"max(CASE WHEN kind = {kind} THEN {c} END)"
    start = OPEN if both else POINT
    one = seen.groupBy(*keys, *carried).agg(*[F.expr(e) for e in (
        f"{of(POINT, 'below')} - 1 AS p", f"{of(start, 'below')} AS lo", f"{of(CLOSE, 'below')} AS hi", f"{of(CLOSE, 'sums')} - {of(start, 'sums')} AS met")])
    return one.withColumn("top", F.expr(f"max({levels('lo', 'hi')})").over(per(keys)))


def dealt(at: DataFrame, keys: list[str], x: str, carried: list[str], near: str) -> DataFrame:
    """The rows of all blocks in the next coordinate ``x``: ``k``, ``j``, ``kind``, the value ``v`` to sort by, and ``carried``.

    ``at`` has ``p``, ``lo``, ``hi``, ``top``.
    """
    low, high = ends(x, near)
    at = at.withColumns({"low": F.expr(low), "high": F.expr(high)})
    return at.selectExpr(*keys, *carried, f"inline(concat({homes('p', 'top', x)}, {cover('lo', 'hi', 'low', 'high')}))")


def running(rows: DataFrame, keys: list[str], weight: str, mate: list[str]) -> DataFrame:
    """Adds ``below`` and ``sums``, numbers and weights of the block's points up to each row, and ``mate``, the point of a block
    of level 0. ``q`` tells the points of a window apart. Blocks of one row (``packed``) are counted
    with numpy where they lie: ``_pairs``."""
    if "asked" in rows.columns:
        return _pairs(rows, keys, len(mate))
    node = [*keys, "k", "j"]
    here = upto("v", "kind", "q", keys=node)
    return rows.withColumns({
        "below": F.expr(f"count_if(kind = {POINT})").over(here), "sums": F.expr(f"sum(IF(kind = {POINT}, {weight}, 0))").over(here),
        "mate": F.expr(f"max(CASE WHEN kind = {POINT} AND k = 0 THEN struct({', '.join([*mate, weight])}) END)").over(per(node))})


def packed(rows: DataFrame, keys: list[str], m: int) -> DataFrame:
    """Blocks of the templates of ``m + 1`` values, one row each, with ``points`` and who of the window has ``asked`` for some of them.

    ``rows`` are values ``x`` by position ``i`` with the tolerance ``r`` of their window. ``a`` and ``b`` are the pairs of equal templates. One
    task ranks the values of a window; what takes time, the counting, is dealt out by blocks of ``PACKED`` positions and more.
    """
    most = PACKED

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        i, x, r = (np.concatenate(c) for c in zip(*[[b.column(c).to_numpy(zero_copy_only=False) for c in ("i", "x", "r")] for b in batches]))
        if len(x) > m:
            for j, found in enumerate(blocks.window_blocks(x[np.argsort(i)], r[0], m, most)):
                yield _batch(keys, key, BLOCKS, [(j, len(x), float(r[0]), *found)])

    return rows.select(*keys, "i", "x", "r").groupBy(*keys).applyInArrow(run, _fields(rows, keys, BLOCKS))


def _pairs(rows: DataFrame, keys: list[str], m: int) -> DataFrame:
    """``(keys, n, r, a, b)`` of ``packed`` blocks: pairs of templates that match in all values, and in all but the last."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select([*BLOCKS][1:]).to_pylist():
                a, b = blocks.block_pairs(row["points"], row["asked"], m)
                yield _batch(keys, key, PAIRS, [(row["n"], row["r"], row["a"] + 2 * a, row["b"] + 2 * b)])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a block is few bytes for its work: tasks aren't merged by size
    return rows.repartition(parts, *keys, "j").groupBy(*keys, "j").applyInArrow(run, _fields(rows, keys, PAIRS))


def _fields(rows: DataFrame, keys: list[str], found: dict[str, str]) -> str:
    return ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys] + [f"{c} {kind}" for c, kind in found.items()])


def _batch(keys: list[str], key: tuple, found: dict[str, str], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of one window: its ``key`` and the columns ``found``."""
    kinds = {"bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.repeat(k, len(rows)) for k in key[:len(keys)]] + [
        pa.array(c, kinds[kind]) for c, kind in zip(zip(*rows), found.values())], [*keys, *found])
