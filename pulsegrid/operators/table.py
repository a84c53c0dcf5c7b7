"""Operators on a finished feature table: cleaning, scaling, correlation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def drop_features(df: DataFrame, names: tuple[str, ...] = ("time", "isseasonal")) -> DataFrame:
    """Leaves out columns by name."""
    return df.drop(*names)


def feature_columns(df: DataFrame, ids: tuple[str, ...] = ("series", "w", "time")) -> list[str]:
    """Numeric columns that are not identifiers."""
    return [f.name for f in df.schema if f.name not in ids and isinstance(f.dataType, T.NumericType)]


def _present(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def varying_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with a sample standard deviation above 0; one pass, one row to the driver."""
    row = df.agg(*[F.stddev_samp(_present(_q(c).cast("double"))).alias(str(i)) for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[i] is not None and row[i] > 0]


def keep_varying(df: DataFrame, ids: tuple[str, ...] = ("series", "w")) -> DataFrame:
    """Drops constant feature columns."""
    cols = feature_columns(df, ids)
    return df.select(*ids, *[_q(c) for c in varying_columns(df, cols)])


def keep_finite(df: DataFrame, ids: tuple[str, ...] = ("series", "w")) -> DataFrame:
    """Keeps rows whose features are all present and finite."""
    tests = [_q(c).isNotNull() & ~F.isnan(_q(c).cast("double")) & (F.abs(_q(c)) < float("inf"))
             for c in feature_columns(df, ids)]
    return df.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def clean(df: DataFrame, ids: tuple[str, ...] = ("series", "w")) -> DataFrame:
    """Drops time and seasonality, then constant columns, then rows that are not finite."""
    names = tuple(c for c in ("time", "isseasonal") if c in df.columns)
    return keep_finite(keep_varying(drop_features(df, names), ids), ids)


def _whole_table(df: DataFrame, stats: list[Column]) -> DataFrame:
    """Adds ``_s``, the one-row statistics of the whole table, as a scalar subquery."""
    return df.withColumn("_s", df.agg(F.struct(*stats).alias("s")).scalar())


def normalise(df: DataFrame, ids: tuple[str, ...] = ("series", "w", "time")) -> DataFrame:
    """(x - mean) / (max - min) per column over the whole table; NULL for a constant column."""
    ids = tuple(c for c in ids if c in df.columns)
    cols = feature_columns(df, ids)
    wide = _whole_table(df, [c for i, name in enumerate(cols) for c in (
        F.avg(_q(name)).alias(f"m{i}"), (F.max(_q(name)) - F.min(_q(name))).alias(f"r{i}"))])
    return wide.select(*ids, *[
        F.try_divide(_q(name) - F.col(f"_s.m{i}"), F.col(f"_s.r{i}")).alias(name) for i, name in enumerate(cols)])


def hours(df: DataFrame, steps: int = 46) -> DataFrame:
    """Adds ``hour`` = time / 3600 and ``label``, the step it falls in between the first and last hour."""
    wide = _whole_table(df, [(F.min("time") / 3600).alias("h0"), (F.max("time") / 3600).alias("h1")])
    wide = wide.withColumn("hour", F.col("time") / 3600)
    size = (F.col("_s.h1") - F.col("_s.h0")) / steps
    at = F.least(F.floor(F.try_divide(F.col("hour") - F.col("_s.h0"), size)), F.lit(steps - 1))
    return wide.withColumn("label", F.round(F.col("_s.h0") + F.coalesce(at, F.lit(0)) * size)).drop("_s")


def long_form(df: DataFrame, ids: tuple[str, ...] = ("series", "w")) -> DataFrame:
    """``(series, w, feature, value)``; missing values are left out."""
    cols = feature_columns(df, ids + ("time",))
    doubles = df.select(*ids, *[_q(c).cast("double").alias(c) for c in cols])
    return doubles.unpivot(list(ids), cols, "feature", "value").where("value is not null")


def _gram_partials(names: list[str]):
    def sums(batches):
        import numpy as np
        import pandas as pd

        d = len(names)
        total = np.zeros((6, d, d))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64")
            p = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x)
            s = x.T @ p
            q = (x * x).T @ p
            total += np.stack([p.T @ p, s, s.T, x.T @ x, q, q.T])
        if total[0].any():
            a, b = np.triu_indices(d)
            yield pd.DataFrame({"a": a, "b": b, **{c: total[i, a, b] for i, c in enumerate(("n", "sa", "sb", "ab", "aa", "bb"))}})

    return sums


def correlation(df: DataFrame, ids: tuple[str, ...] = ("series", "w"), absolute: bool = True) -> DataFrame:
    """``(f1, f2, r)``: Pearson correlation of all pairs of feature columns, each over the rows that have both.

    Missing (NULL or NaN) values leave a pair's sums; infinite ones must be gone. Columns are standardised first. Each
    task multiplies its own rows into matrices of the size of the feature list and emits only those; Spark adds
    the partial sums up.
    """
    cols = feature_columns(df, ids)
    wide = _whole_table(df, [c for i, name in enumerate(cols) for c in (
        F.avg(_present(_q(name).cast("double"))).alias(f"m{i}"), F.stddev_pop(_present(_q(name).cast("double"))).alias(f"s{i}"))])
    z = wide.select(*[
        F.try_divide(_present(_q(c).cast("double")) - F.col(f"_s.m{i}"), F.col(f"_s.s{i}")).alias(f"z{i}")
        for i, c in enumerate(cols)])
    partial = z.mapInPandas(_gram_partials(cols),
                            "a int, b int, n double, sa double, sb double, ab double, aa double, bb double")
    s = partial.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "ab", "aa", "bb")])
    share = lambda e: F.try_divide(e, F.col("n"))
    cov = F.col("ab") - share(F.col("sa") * F.col("sb"))
    va = F.col("aa") - share(F.col("sa") * F.col("sa"))
    vb = F.col("bb") - share(F.col("sb") * F.col("sb"))
    r = F.try_divide(cov, F.sqrt(va * vb))
    r = F.abs(r) if absolute else r
    names = F.array(*[F.lit(c) for c in cols])
    upper = s.select("a", "b", r.alias("r"))
    sides = F.array(F.struct(F.col("a").alias("p"), F.col("b").alias("q")),
                    F.struct(F.col("b").alias("p"), F.col("a").alias("q")))
    both = upper.select("r", F.inline(F.when(F.col("a") == F.col("b"), F.slice(sides, 1, 1)).otherwise(sides)))
    return both.select(names[F.col("p")].alias("f1"), names[F.col("q")].alias("f2"), "r")
