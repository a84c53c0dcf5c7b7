"""Distribution features over a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streaming_features(readings: DataFrame, length: str, step: str, late: str) -> DataFrame:
    """Single-pass features per series and sliding window of a streaming ``(series, ts, y)``.

    Windows are aligned to the epoch and closed on the left, as streaming windows are; a window is final
    once the watermark has passed its end. Works on a batch frame as well, without a watermark.
    """
    sd, mu, n = F.stddev_pop("y"), F.avg("y"), F.count("y")
    ratio = F.try_divide(sd, mu)
    grouped = readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(
        "series", F.window("ts", length, step).alias("win"))
    return grouped.agg(
        n.alias("observations"), mu.alias("dn_mean"), (F.max("y") - F.min("y")).alias("dn_range"),
        F.max("y").alias("dn_max"), F.min("y").alias("dn_min"), F.skewness("y").alias("dn_skew1"),
        F.kurtosis("y").alias("dn_kurt1"), F.try_divide(ratio - 1, ratio + 1).alias("dn_burstiness"),
        sd.alias("dn_std"), ratio.alias("dn_cv_1"),
    ).select("series", F.unix_micros(F.col("win.start")).alias("start_us"),
             F.unix_micros(F.col("win.end")).alias("end_us"), "observations", "dn_mean", "dn_range", "dn_max",
             "dn_min", "dn_skew1", "dn_kurt1", "dn_burstiness", "dn_std", "dn_cv_1")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes all that has arrived, appends finished windows to parquet, and stops."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
