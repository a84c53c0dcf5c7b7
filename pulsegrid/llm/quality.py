"""Quality rules with thresholds that each language and source gives itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import BLANK_RUN, BLANKS, packed, small, staged, text_of

SYMBOLS = "#*$%&|<>"

#: Shares that are compared with their group: (name, width where the group has no spread, also from below).
SHARES = (("mean_word_chars", 0.5, True), ("symbol_share", 0.02, False), ("dup_line_share", 0.1, False),
          ("repeat_share", 0.05, False))

#: By share: the two quantiles whose distance is the spread, and how much of ``reach`` the fence stands beyond the upper.
#: Most documents have no repeats, so their spread is in the tail. Documents of symbols are up to a tenth of a group: a
#: quantile above 0.9 would lie among them.
LEVELS = {"mean_word_chars": (0.25, 0.75, 1.0), "symbol_share": (0.25, 0.75, 1.0), "dup_line_share": (0.5, 0.99, 0.25),
          "repeat_share": (0.5, 0.95, 1.0)}


def _repeated_words(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more: equal hashes stand side by side once sorted."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        hit = F.filter(F.sequence(F.lit(0), last), lambda k: (
            F.when(k > 0, s[F.greatest(k - 1, F.lit(0))]["h"] == s[k]["h"]).otherwise(False)
            | F.when(k < last, s[F.least(k + 1, last)]["h"] == s[k]["h"]).otherwise(False)))
        return F.sort_array(F.transform(hit, lambda k: s[k]["i"]))

    def union(at: Column) -> Column:
        return F.when(F.size(at) > 1, F.aggregate(
            F.sequence(F.lit(0), F.greatest(F.size(at) - 2, F.lit(0))), F.lit(3),
            lambda acc, k: acc + F.least(F.lit(3), at[k + 1] - at[k]))).otherwise(0)

    # transform over one element binds an intermediate array once, where a plain expression would repeat it
    return F.transform(F.transform(F.array(ordered), covered), union)[0]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns as they were) and one BIGINT column per count.

    NULL text counts as empty: all counts are 0. Words are runs without blanks; windows of three words are told
    apart by a 64-bit hash.
    """
    t = packed(docs, t=text_of(docs, text))
    t = t.select("row", "t", F.trim(F.col("t"), F.lit(BLANKS)).alias("trimmed"))
    t = t.select("row", "t", F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
                 .otherwise(F.split("trimmed", BLANK_RUN)).alias("words"),
                 F.filter(F.split("t", "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "").alias("lines"))
    w = F.col("words")
    t = t.select("row", "t", "lines", F.size(w).alias("n"), F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
                    lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).alias("windows"))
    windows = F.col("windows")
    without = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    counts = {"n_words": F.col("n"), "word_chars": F.length("t") - without(BLANKS), "n_symbols": without(SYMBOLS),
              "n_lines": F.size("lines"), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
              "n_repeat_words": F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0)
              .otherwise(_repeated_words(windows))}
    return t.select("row", *[c.cast("bigint").alias(k) for k, c in counts.items()])


def shares(m: DataFrame) -> DataFrame:
    """Adds the shares that are compared between documents, and the verdict of the fixed base rules."""
    per_word = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).otherwise(0.0)
    return m.select("*", per_word("word_chars").alias("mean_word_chars"), per_word("n_symbols").alias("symbol_share"),
                    F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines")).otherwise(0.0).alias("dup_line_share"),
                    per_word("n_repeat_words").alias("repeat_share"),
                    ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"))


def fences(m: DataFrame, reach: float = 4.0, accuracy: int = 1000) -> DataFrame:
    """Per language and source, the interval each share must lie in.

    A mergeable quantile sketch per group gives two quantiles of all documents that pass the base rules; the fence
    stands ``reach`` times their distance beyond them, or the part of it that LEVELS names. Only where they are equal
    a fixed width takes the place of the distance. Sketches merge before the shuffle, so a group with a third of all
    rows costs its reducer one sketch per task.
    """
    sketches = m.where(~F.col("base_failed")).groupBy("g_lang", "g_source").agg(
        *[F.percentile_approx(name, list(LEVELS[name][:2]), accuracy).alias(name) for name, _, _ in SHARES])
    bounds = []
    for name, least, below in SHARES:
        q = F.col(name)
        spread = q[1] - q[0]
        beyond = F.when(spread > 0, LEVELS[name][2] * reach * spread).otherwise(reach * least)
        bounds.append((q[1] + beyond).alias(f"{name}_most"))
        if below:
            bounds.append((q[0] - beyond).alias(f"{name}_least"))
    return sketches.select("g_lang", "g_source", *bounds)


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", columns=None,
           reach: float = 4.0) -> DataFrame:
    """``row``, the counts and shares, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules and all its shares lie within the fences of its language and
    source. NULL language or source form groups of their own. A group whose documents all fail the base rules has no
    fence, and none of its documents is kept. Repeated rows each get the same verdict; an empty table gives an empty
    one. ``columns`` names the columns that ``row`` is to hold (all by default).
    """
    docs = docs.select(*dict.fromkeys([*(columns or docs.columns), text, lang, source]))
    m = shares(measure(docs, text))
    kept = [F.col("row")[c].alias(c) for c in (columns or docs.columns)]
    m = staged(m.select(F.struct(*kept).alias("row"), F.col("row")[lang].cast("string").alias("g_lang"),
                        F.col("row")[source].cast("string").alias("g_source"), *m.columns[1:]))
    f = fences(m, reach)
    f = small(staged(f.select(F.col("g_lang").alias("f_lang"), F.col("g_source").alias("f_source"), *f.columns[2:])))
    joined = m.join(f, m.g_lang.eqNullSafe(f.f_lang) & m.g_source.eqNullSafe(f.f_source), "left")
    inside = ~F.col("base_failed")
    for name, _, below in SHARES:
        inside &= F.col(name) <= F.col(f"{name}_most")
        if below:
            inside &= F.col(name) >= F.col(f"{name}_least")
    return joined.select(*m.columns, F.coalesce(inside, F.lit(False)).alias("kept"))


def quality_filter(docs: DataFrame, **options) -> DataFrame:
    """The documents that the quality rules keep, with the columns they had."""
    return judged(docs, **options).where("kept").select("row.*")
