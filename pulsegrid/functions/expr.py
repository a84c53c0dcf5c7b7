"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["series", "w"]


def per(keys: Iterable[str] = KEYS):
    """All rows of one window."""
    return Window.partitionBy(*keys)


def by(*order: str, keys: Iterable[str] = KEYS):
    """Rows of one window in the given order."""
    return Window.partitionBy(*keys).orderBy(*order)


def upto(*order: str, keys: Iterable[str] = KEYS):
    """Rows of one window from its start to the current row."""
    return by(*order, keys=keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def div(a, b) -> Column:
    """Quotient; NULL where the divisor is 0."""
    return F.try_divide(a, b)


def share(predicate: Column) -> Column:
    """Share of rows for which the predicate holds; rows where it is NULL do not count."""
    return F.avg(predicate.cast("double"))


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows where both sides are present; NULL if a side is constant."""
    both = a.isNotNull() & b.isNotNull()
    sa = F.stddev_pop(F.when(both, a))
    sb = F.stddev_pop(F.when(both, b))
    return div(F.covar_pop(a, b), sa * sb)


def combine(frames: list[DataFrame], keys: Iterable[str] = KEYS, how: str = "left") -> DataFrame:
    """Join per-window frames on their key; the first frame names the windows to keep."""
    head, *rest = frames
    for frame in rest:
        head = head.join(frame, list(keys), how)
    return head
