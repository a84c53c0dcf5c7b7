"""Removal of repeated passages by content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import bucketed, packed, staged, text_of

#: Mean lines per chunk and lines under the rolling hash.
DIVISOR, WINDOW = 3, 2

WORD = r"[^\x20\x09-\x0D]"


def line_number(line: Column) -> Column:
    """48 bits of a line's MD5 as BIGINT."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 12), 16, 10).cast("bigint")


def _ends(lines: Column, divisor: int, window: int) -> Column:
    """Last line of each chunk. A cut comes behind a line where the hash rolling over it and the lines before it is a
    multiple of ``divisor``.

    The hash depends on the last ``window`` lines only, so an inserted line moves no cut further down.
    """
    def cut_at(h: Column) -> Column:
        last = F.size(h) - 1
        rolled = lambda i: sum((F.coalesce(F.get(h, i - k), F.lit(0)) % 1_000_003 * (31 ** k) for k in range(1, window)),
                               h[i] % 1_000_003)
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (rolled(i) % divisor == 0))

    return F.transform(F.array(F.transform(lines, line_number)), cut_at)[0]


def _begin(ends: Column, k: Column) -> Column:
    return F.when(k == 0, 0).otherwise(F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 1)


def _chunk_text(lines: Column, ends: Column, k: Column) -> Column:
    return F.array_join(F.slice(lines, _begin(ends, k) + 1, F.get(ends, k) - _begin(ends, k) + 1), "\n")


def _lines(text: str) -> Column:
    return F.split(F.col("row")[text].cast("string"), "\n")


def chunked(docs: DataFrame, text: str = "text", identifier: str = "doc_id", divisor: int = DIVISOR,
            window: int = WINDOW) -> DataFrame:
    """``row`` (all columns), ``key`` of the document, ``ends`` of its chunks, and their ``hashes``.

    The hash is NULL for a chunk of one line or without a word. The table is in buckets of the key.
    """
    t = packed(docs, t=text_of(docs, text))
    t = t.select("row", F.xxhash64(F.col("row")[identifier], "t").alias("key"), F.split("t", "\n").alias("lines"))
    t = t.select("*", _ends(F.col("lines"), divisor, window).alias("ends"))

    def hashed(e: Column, k: Column) -> Column:
        chunk = _chunk_text(F.col("lines"), F.col("ends"), k)
        return F.when((e > _begin(F.col("ends"), k)) & chunk.rlike(WORD), F.xxhash64(chunk))

    return bucketed(t.select("row", "key", "ends", F.transform("ends", hashed).alias("hashes")), "key")


def repeated_chunks(c: DataFrame, text: str, identifier: str) -> DataFrame:
    """(id, key, i) of the chunks that also stand earlier: in a smaller id, or further up.

    Hashes travel first, without text. Chunks whose hash occurs twice are then grouped by their text itself, which
    compares bytes; equal hashes of different texts are told apart there. A document is its id and ``key``: tables meet by the
    key, and ids are compared where they have met.
    """
    own = F.col("row")[identifier]
    each = c.select(own.alias("id"), "key", F.posexplode("hashes").alias("i", "ch")).where("ch is not null")
    twice = staged(each.groupBy("ch").agg(F.count("*").alias("n")).where("n > 1").select(F.col("ch").alias("twice")))
    some = each.join(twice, each.ch == twice.twice, "left_semi").distinct()
    some = staged(some.groupBy(F.col("key").alias("s_key")).agg(F.collect_list(F.struct("id", "i", "ch")).alias("some")))
    mine = F.filter("some", lambda s: s["id"].eqNullSafe(own))
    # bound once per document: the text is split once, not once per chunk
    texts = F.transform(F.array(_lines(text)), lambda lines: F.transform(mine, lambda s: F.struct(
        s["i"].alias("i"), s["ch"].alias("ch"), _chunk_text(lines, F.col("ends"), s["i"]).alias("text"))))[0]
    found = staged(c.join(some, F.col("key") == F.col("s_key")).select(own.alias("id"), "key", F.inline(texts)))
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "key", "i")
    first = staged(found.groupBy("ch", "text").agg(F.min(place).alias("place")).select(
        F.col("ch").alias("f_ch"), F.col("text").alias("f_text"), "place"))
    again = found.join(first, (found.ch == first.f_ch) & (found.text == first.f_text))
    elsewhere = (F.col("key") != F.col("place.key")) | (F.col("i") != F.col("place.i")) | ~F.col("id").eqNullSafe(F.col("place.id"))
    return again.where(elsewhere).select("id", "key", "i").distinct()


def line_dedup(docs: DataFrame, text: str = "text", identifier: str = "doc_id", divisor: int = DIVISOR,
               window: int = WINDOW) -> DataFrame:
    """``row`` (all columns as they were), ``new_text``, ``n_lines``, ``n_chunks``, ``removed_lines``, ``removed_chunks``.

    Of chunks of two or more lines that are equal byte for byte, anywhere in the table, the one in the smallest id
    stays, and there the first; the others go with their lines. NULL ids come before all others. Rows that repeat id
    and text are one document: they get equal results and don't count as copies of each other. NULL and empty text
    has one empty line; NULL stays NULL. A text of which nothing is left becomes empty; no row is dropped.

    The texts are shuffled once, into buckets by document; places and decisions then come to them.
    """
    c = chunked(docs, text, identifier, divisor, window)
    gone = repeated_chunks(c, text, identifier).groupBy(F.col("key").alias("g_key")).agg(
        F.collect_list(F.struct("id", "i")).alias("all"))  # at most the chunks of one document, but for keys that collide
    own = F.filter("all", lambda g: g["id"].eqNullSafe(F.col("row")[identifier]))
    j = c.join(gone, F.col("key") == F.col("g_key"), "left").select("row", "ends", F.transform(own, lambda g: g["i"]).alias("gone"))
    ends, chosen = F.col("ends"), F.sequence(F.lit(0), F.size("ends") - 1)
    stays = F.array_except(chosen, "gone")  # by hash, so linear in the chunks
    left = F.transform(F.array(_lines(text)), lambda lines: F.array_join(
        F.transform(stays, lambda k: _chunk_text(lines, ends, k)), "\n"))[0]
    removed = F.aggregate("gone", F.lit(0), lambda acc, k: acc + F.get(ends, k) - _begin(ends, k) + 1)
    none = F.coalesce(F.size("gone"), F.lit(0)) <= 0
    return j.select("row", F.when(none, F.col("row")[text]).otherwise(left).alias("new_text"),
                    (F.element_at("ends", -1) + 1).cast("bigint").alias("n_lines"), F.size("ends").cast("bigint").alias("n_chunks"),
                    F.when(none, 0).otherwise(removed).cast("bigint").alias("removed_lines"),
                    F.when(none, 0).otherwise(F.size("gone")).cast("bigint").alias("removed_chunks"))


def without_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents with the columns they had, repeated chunks taken out of the text."""
    d = line_dedup(docs, text, **options)
    return d.select(*[(F.col("new_text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
