"""Reading and writing series and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_TEXTS = {
    "value_time": T.StructType([T.StructField("value", T.StringType()), T.StructField("time", T.StringType())]),
    "time_value": T.StructType([T.StructField("time", T.StringType()), T.StructField("value", T.StringType())]),
}


def number(text: Column) -> Column:
    """Text to DOUBLE; NULL when it is not a number, and NULL for NaN."""
    v = text.try_cast("double")
    return F.when(~F.isnan(v), v)


def repair(raw: DataFrame, chunk: float = 86400.0) -> DataFrame:
    """``(series, t, y)`` from text columns ``(series, time, value)``.

    A value that is present but is not a number takes the last good value before it; an empty one, or NaN,
    stays missing. Rows without a usable time are dropped, since they have no place in a series. Long
    series are repaired per chunk of time, with the last good value of earlier chunks carried in. Cells of equal
    time count by value, bad ones first, so the result depends neither on chunks nor on the order of rows.
    """
    text = F.trim("value")
    blank = F.col("value").isNull() | (text == "") | (F.lower(text) == "nan")
    typed = raw.select("series", number(F.col("time")).alias("t"), number(F.col("value")).alias("v"),
                       (~blank & F.col("value").try_cast("double").isNull()).alias("bad")).where("t is not null")
    typed = typed.withColumn("chunk", F.floor(F.col("t") / F.lit(float(chunk))))
    good = F.col("v").isNotNull()
    ends = typed.groupBy("series", "chunk").agg(
        F.max_by(F.when(good, F.col("v")), F.when(good, F.struct("t", "v"))).alias("last_v"))
    before = Window.partitionBy("series").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("series", "chunk", F.last("last_v", ignorenulls=True).over(before).alias("carry"))
    inside = Window.partitionBy("series", "chunk").orderBy("t", "v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    held = typed.withColumn("held", F.last("v", ignorenulls=True).over(inside)).join(carry, ["series", "chunk"])
    return held.select("series", "t", F.when(F.col("bad"), F.coalesce("held", "carry")).otherwise(
        F.col("v")).alias("y"))


def read_series_csv(spark: SparkSession, path: str, order: str = "value_time", header: bool = True,
                    series_pattern: str = r"([^/]+)\.csv") -> DataFrame:
    """``(series, time, value)`` as text from one file or a glob of files; the file name names the series.

    ``order`` tells which of the two columns comes first. Pass the result to ``repair``.
    """
    raw = spark.read.csv(path, header=header, schema=TWO_TEXTS[order], enforceSchema=True)
    name = F.regexp_extract(F.input_file_name(), series_pattern, 1)
    return raw.select(name.alias("series"), "time", "value")


def patient_file(patient: int, prefix: str, suffix: str = "_hr.csv") -> str:
    """File name of one patient's heart-rate file: the number is padded to four digits."""
    return f"{prefix}{str(patient).zfill(4)}{suffix}"


def points_from(df: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """``(series, t, y)`` from any table; timestamps become epoch seconds, NaN becomes NULL."""
    t = F.col(time)
    if isinstance(df.schema[time].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        t = F.unix_micros(t.cast("timestamp")) / 1e6
    y = F.col(value).cast("double")
    return df.select(F.col(series).cast("string").alias("series"), t.cast("double").alias("t"),
                     F.when(~F.isnan(y), y).alias("y"))


def write_features(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
                   partition_by: list[str] | None = None) -> None:
    """Writes a feature table. DOUBLE and BOOLEAN keep their type; one file only on request."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def numeric_columns(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    """Columns whose every present cell is a number; one pass, one row to the driver."""
    cols = cols or df.columns
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(str(i))
           for i, c in enumerate(cols)]
    row = df.agg(*bad).first()
    return [c for i, c in enumerate(cols) if row[i] == 0]


def read_feature_csv(spark: SparkSession, path: str) -> DataFrame:
    """A feature table from CSV; columns that are not numbers throughout are left out."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    return as_numbers(raw)


def as_numbers(raw: DataFrame) -> DataFrame:
    """Casts the numeric columns of a text table to DOUBLE and drops the rest."""
    return raw.select(*[F.col(f"`{c}`").try_cast("double").alias(c) for c in numeric_columns(raw)])
