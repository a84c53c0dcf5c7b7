"""Small shared pieces: packing whole rows, staging, sizes that permit a broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.staging import shared_folder, staged

#: Rows of a table that may be sent to every executor; a larger one is shuffled.
BROADCAST_ROWS = 10_000

#: Characters that end a word: blank, and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

__all__ = ["BLANKS", "BLANK_RUN", "BROADCAST_ROWS", "bucketed", "packed", "read", "row_key", "small", "staged", "text_of"]


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(df: DataFrame, column: str) -> Column:
    """The column as text; NULL counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of the frame in one struct ``row``, so that new columns cannot clash with them."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *[e.alias(c) for c, e in columns.items()])


def row_key(identifier: Column, text: Column) -> Column:
    """What tells documents apart: id and text together; repeated rows with both equal are one document."""
    return F.struct(identifier.alias("id"), F.xxhash64(text).alias("h"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a staged table for broadcasting if it has been counted to have at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """The frame as a staged table in buckets of ``key``: it meets other tables by that key without being shuffled again."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"pulsegrid_{uuid.uuid4().hex}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", shared_folder(spark)).saveAsTable(name)
    return spark.table(name)
