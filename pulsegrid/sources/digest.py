"""Content digests of stored items, and comparison of two digest lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def digests(df: DataFrame, key: str, content: str | Column) -> DataFrame:
    """``(item, sha256, bytes)`` per row; every row is hashed where it lies."""
    body = F.col(content) if isinstance(content, str) else content
    return df.select(F.col(key).cast("string").alias("item"),
                     F.sha2(body.cast("binary"), 256).alias("sha256"),
                     F.octet_length(body).cast("long").alias("bytes"))


#: Folders over which files are dealt, so that a folder is listed at once and none holds them all.
FOLDERS = 64


def write_files(texts: DataFrame, path: str) -> None:
    """A file per ``name``, below ``path`` in one of ``FOLDERS`` folders, of its ``line`` values in the order of the frame.

    Tasks write them where they are to stay; a task that runs again writes the same file. A NULL line is empty.
    """
    def written(batches):
        from pyarrow import fs

        system, out, last = None, None, None
        try:
            for pdf in batches:
                for folder, name, line in zip(pdf["folder"], pdf["name"], pdf["line"]):
                    if (folder, name) != last:
                        if out is not None:
                            out.close()
                        at = f"{path}/{folder}"
                        system, place = fs.FileSystem.from_uri(at) if ":/" in at else (fs.LocalFileSystem(), at)
                        if last is None or last[0] != folder:
                            system.create_dir(place, recursive=True)
                        out, last = system.open_output_stream(f"{place}/{name}", compression=None), (folder, name)
                    out.write((line or "").encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        yield from ()

    dealt = texts.select(F.pmod(F.xxhash64("name"), F.lit(FOLDERS)).alias("folder"), "name", "line", F.monotonically_increasing_id().alias("at"))
    dealt.repartition("folder").sortWithinPartitions("folder", "name", "at").mapInPandas(written, "name string").write.format("noop").mode("overwrite").save()


def file_digests(spark: SparkSession, path: str, block: int = 4 << 20) -> DataFrame:
    """``(item, sha256, bytes)`` of whole files of any size.

    Spark lists the files; each is read in blocks where its row is, through the file systems that pyarrow knows.
    """
    def hashed(batches):
        import hashlib

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            rows = []
            for item in pdf["path"]:
                system, place = fs.FileSystem.from_uri(item)
                h, size = hashlib.sha256(), 0
                with system.open_input_stream(place, compression=None) as f:
                    while data := f.read(block):
                        h.update(data)
                        size += len(data)
                rows.append((item, h.hexdigest(), size))
            yield pd.DataFrame(rows, columns=["item", "sha256", "bytes"])

    files = spark.read.format("binaryFile").load(path).select("path")  # the content column is not read
    return files.mapInPandas(hashed, "item string, sha256 string, bytes long")


def compare_digests(old: DataFrame, new: DataFrame) -> DataFrame:
    """Items that are ``missing``, ``added`` or ``changed`` in the new list."""
    a = old.select("item", F.col("sha256").alias("old"))
    b = new.select("item", F.col("sha256").alias("new"))
    status = (F.when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "added")
              .when(F.col("old") != F.col("new"), "changed"))
    return a.join(b, "item", "full_outer").select("item", status.alias("status")).where("status is not null")
