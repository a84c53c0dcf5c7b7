"""Binary and symbolic features of the filled, ordered values of a window."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.expr import KEYS, by, div
from pulsegrid.operators.entropy import entropy_of

METHODS = ("diff", "mean", "median", "iqr")
LETTERS = "du"


def binarize(o: DataFrame, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """``(series, w, method, i, n, b)``: 0/1 sequences. ``diff`` is one shorter than the window."""
    x = F.col("x")
    stats = o.groupBy(*KEYS).agg(
        F.avg("x").alias("mu"), F.count("x").alias("n"),
        F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    rules = {
        "diff": (F.col("x1") - x > 0, F.col("n") - 1),
        "mean": (x - F.col("mu") > 0, F.col("n")),
        "median": (x - F.col("q")[1] > 0, F.col("n")),
        "iqr": ((x > F.col("q")[0]) & (x < F.col("q")[2]), F.col("n")),
    }
    near = o.select(*KEYS, "i", "x", F.lead("x").over(by("i")).alias("x1")).join(stats, KEYS)
    rows = near.select(*KEYS, "i", F.inline(F.array(*[
        F.struct(F.lit(m).alias("method"), rules[m][1].alias("n"), rules[m][0].cast("int").alias("b"))
        for m in methods])))
    return rows.where(F.col("b").isNotNull())


def binary_stats(o: DataFrame, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """Run lengths and halves of the 0/1 sequences; ten numbers per method.

    Only the starts of runs are kept, so a run's length is the distance to the next start.
    """
    keys = KEYS + ["method"]
    bits = binarize(o, methods)
    back = F.lag("b").over(by("i", keys=keys))
    second = F.col("i") >= F.floor(F.col("n") / 2)
    starts = bits.withColumn("back", back).where(F.col("back").isNull() | (F.col("back") != F.col("b")))
    runs = starts.select(*keys, "n", "b", (
        F.coalesce(F.lead("i").over(by("i", keys=keys)), F.col("n")) - F.col("i")).alias("len"))

    def of(b: int) -> Column:
        return F.when(F.col("b") == b, F.col("len"))

    stats = runs.groupBy(*keys).agg(
        (F.count(of(1)) / F.max("n")).alias("pstretch1"),
        *[c.alias(f"{name}stretch{b}") for b in (0, 1) for name, c in (
            ("long", F.coalesce(F.max(of(b)), F.lit(0)).cast("double")),
            ("mean", F.coalesce(F.avg(of(b)), F.lit(0.0))), ("std", F.stddev_samp(of(b))))])
    halves = bits.groupBy(*keys).agg(
        div(F.count_if(second & (F.col("b") == 1)), F.count_if(~second & (F.col("b") == 1))).alias("pupstat2"))
    each = halves.join(stats, keys).withColumns(
        {"meanstretchdiff": F.col("meanstretch1") - F.col("meanstretch0"),
         "stdstretchdiff": F.col("stdstretch1") - F.col("stdstretch0")})
    names = ["pupstat2", "pstretch1", "longstretch0", "meanstretch0", "stdstretch0",
             "longstretch1", "meanstretch1", "stdstretch1", "meanstretchdiff", "stdstretchdiff"]
    return each.groupBy(*KEYS).agg(*[
        F.expr(f"max(CASE WHEN method = '{m}' THEN {c} END)").alias(f"sb_binarymethod_{m}_{c}")
        for m in methods for c in names])


WORDS = {size: ["".join(LETTERS[k] for k in p) for p in product((0, 1), repeat=size)] for size in range(1, 5)}


def _word_counts(coded: DataFrame, how: str) -> DataFrame:
    """Frequencies of the words coded as ``c1`` to ``c4`` and the entropy of each size."""
    freq = coded.groupBy(*KEYS).agg(*[
        F.expr(f"avg(CAST(c{size} = {code} AS DOUBLE))").alias(word)
        for size in WORDS for code, word in enumerate(WORDS[size])])
    prefix = f"sb_motiftwo_{how}_"
    return freq.select(
        *KEYS, *[F.col(w).alias(prefix + w) for size in WORDS for w in WORDS[size]],
        *[F.expr(entropy_of(WORDS[size])).alias(prefix + "h" * size) for size in WORDS])


def _codes(bits: list[str]) -> list[str]:
    return [" + ".join(f"{2 ** (size - 1 - k)} * {bits[k]}" for k in range(size)) + f" AS c{size}" for size in WORDS]


def motifs(led: DataFrame) -> DataFrame:
    """Frequencies of words of one to four steps (d, u) and their entropies; needs lags 1 to 4."""
    at = ["x", "x1", "x2", "x3", "x4"]
    return _word_counts(led.selectExpr(*KEYS, *_codes([f"CAST({b} > {a} AS INT)" for a, b in zip(at, at[1:])])), "diff")


def motifs_of(o: DataFrame, how: str) -> DataFrame:
    """The same for any way to make 0/1 sequences: words of one to four values, d for 0 and u for 1."""
    ahead = [F.lead("b", k).over(by("i")).alias(f"b{k}") for k in (1, 2, 3)]
    return _word_counts(binarize(o, (how,)).select(*KEYS, "b", *ahead).selectExpr(*KEYS, *_codes(["b", "b1", "b2", "b3"])), how)
