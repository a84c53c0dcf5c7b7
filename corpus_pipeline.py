"""From raw documents to packed sequences: five stages, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import lines, packing, quality, secret_scans, simhash
from pulsegrid.llm.common import read, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; all documents stay, with their new number of characters."""
    d = lines.line_dedup(docs)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("bigint")}
    return d.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; all documents stay, with their new number of characters."""
    return secret_scans.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    cut = staged(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packing.pack(cut).select(F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"),
                                    "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_duplicates),
          ("secret_scans", secrets), ("packing", pack)]

#: SQL has neither the sketches nor the tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result is that of the last."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
