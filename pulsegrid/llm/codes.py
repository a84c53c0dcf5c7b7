"""Codes of vectors: each part of a vector is named by the nearest entry of a codebook that the parts have shaped."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import packed, small, staged

#: Vectors whose parts share a trie, and leaves of a trie that are walked together.
ROWS, LEAVES = 4096, 512
#: Groups in which the sums of a part's entries are added up.
LOTS = 8
#: Largest component for which 64-bit integers hold squared distances of up to 65,536 dimensions; beyond it Python's integers are used.
NARROW = 1 << 22
LARGEST = (1 << 63) - 1


def whole_numbers(x: np.ndarray, scale: int = 1024) -> np.ndarray:
    """floor(scale * x), exactly: 64-bit integers, or Python's where those are too small."""
    if not x.size or np.abs(x).max() * scale <= NARROW:
        return np.floor(x * scale).astype(np.int64)
    exact = [int(v) * scale if abs(v) > 2.0**52 else math.floor(v * scale) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, number of each row among them)."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), int)
    order = np.array(sorted(range(len(parts)), key=parts.tolist().__getitem__), int)
    rows = parts[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    number = np.empty(len(parts), int)
    number[order] = np.cumsum(new) - 1
    return rows[new], number


def nearest(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) for each of the distinct parts, which are the leaves of a trie in depth-first order.

    A node of the trie is a prefix of dimensions; its vector of distances to all entries is that of its parent plus one
    dimension, worked out once for all leaves below it. Leaves are walked in runs, so that a bounded number of
    such vectors is held; ties go to the lower entry.
    """
    entry, far = np.zeros(len(leaves), int), np.zeros(len(leaves), leaves.dtype)
    differs = leaves[1:] != leaves[:-1]
    shared = np.concatenate([[0], differs.argmax(axis=1)]) if leaves.shape[1] else np.zeros(len(leaves), int)
    for at in range(0, len(leaves), LEAVES):
        run, opens = leaves[at:at + LEAVES], shared[at:at + LEAVES].copy()
        opens[0] = 0
        node = np.zeros(len(run), int)  # of each leaf at the present depth
        sums = np.zeros((1, len(book)), leaves.dtype)
        for d in range(leaves.shape[1]):
            new = opens <= d
            first = np.flatnonzero(new)
            step = run[first, d][:, None] - book[None, :, d]
            sums = sums[node[first]] + step * step
            node = np.cumsum(new) - 1
        best = sums.argmin(axis=1)
        entry[at:at + LEAVES], far[at:at + LEAVES] = best[node], sums[np.arange(len(sums)), best][node]
    return entry, far


def bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end: equal in size, or nearly if the dimension doesn't divide."""
    return [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]


def _blocks(batches, dim: int):
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            b = whole.slice(at, ROWS)
            yield b, whole_numbers(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim))


def _assigned(x: np.ndarray, books: list[np.ndarray], cuts: list[tuple[int, int]]):
    """For each part: its distinct values, the number of each row, and entries and distances of the values."""
    for (a, b), book in zip(cuts, books):
        leaves, number = distinct(x[:, a:b])
        if leaves.dtype != book.dtype:
            leaves, book = leaves.astype(object), book.astype(object)
        yield leaves, number, *nearest(leaves, book)


def refined(kept: DataFrame, books: list[np.ndarray], cuts: list[tuple[int, int]], dim: int) -> list[np.ndarray]:
    """The codebooks after one round: each entry is the floor of the mean of its parts, or what it was.

    A task adds up its own parts and hands on one row per entry that it used; the rows of an entry are then added
    up, whatever the size of the sums.
    """
    import pandas as pd

    def run(batches):
        import pyarrow as pa

        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, x in _blocks(batches, dim):
            for p, (leaves, number, entry, _) in enumerate(_assigned(x, books, cuts)):
                weight = np.bincount(number, minlength=len(leaves))
                part = np.zeros(books[p].shape, leaves.dtype)
                np.add.at(part, entry, leaves * weight[:, None])
                sums[p] += part
                counts[p] += np.bincount(entry, weights=weight, minlength=len(books[p])).astype(np.int64)
        rows = [(p, e, int(counts[p][e]), [str(v) for v in sums[p][e]]) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist()]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["part", "entry", "n", "sums"])

    def means(pdf):
        rows = []
        for (part, entry), of in pdf.groupby(["part", "entry"]):
            n = int(of["n"].sum())
            rows.append((part, entry, [str(sum(map(int, column)) // n) for column in zip(*of["sums"])]))
        return pd.DataFrame(rows, columns=["part", "entry", "mean"])

    new = kept.select("v").mapInArrow(run, "part int, entry int, n bigint, sums array<string>").groupBy(
        "part", F.col("entry") % LOTS).applyInPandas(means, "part int, entry int, mean array<string>")
    out = [b.copy() for b in books]
    for r in new.collect():  # at most parts * entries rows
        mean_ = np.array([int(v) for v in r["mean"]], object)
        if out[r.part].dtype != object and len(mean_) and max(map(abs, mean_)) > NARROW:
            out[r.part] = out[r.part].astype(object)
        out[r.part][r.entry] = mean_
    return out


def valid(vectors: DataFrame, identifier: str, vector: str, columns: list[str]) -> DataFrame:
    """``row``, ``id`` and ``v`` of the vectors without NULL and non-finite components, staged."""
    v = packed(vectors.select(*dict.fromkeys([*columns, identifier, vector])), v=vectors[vector].cast("array<double>"))
    v = v.select(F.struct(*[F.col("row")[c].alias(c) for c in columns]).alias("row"), F.col("row")[identifier].alias("id"), "v")
    return staged(v.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))


def compress(vectors: DataFrame, identifier: str = "vec_id", vector: str = "embedding", parts: int = 4, entries: int = 256,
             rounds: int = 4, columns=None) -> tuple[DataFrame, list[np.ndarray]]:
    """(``row``, ``code``, ``error`` of every vector that is kept; the final codebooks, one array per part).

    Components become floor(1024 * x). The codebooks start as the parts of the vectors with the ``entries`` smallest ids (NULL ids
    last, ties by vector) and go through ``rounds`` of assignment and mean. Only codebooks, whose size the
    parameters bound, travel between driver and tasks; vectors are never shuffled, so copies and hot labels cost nothing.

    NULL vectors and vectors with NULL, NaN or infinite components are dropped, and so are vectors of another length than
    most have (ties: the longer). Fewer vectors than entries make fewer entries. Repeated rows get equal codes. An error beyond a BIGINT
    is the largest BIGINT. An empty table gives an empty one and codebooks without entries.
    """
    kept = valid(vectors, identifier, vector, list(columns or vectors.columns))
    top = kept.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = top.dim if top else 0
    kept = kept.where(F.size("v") == dim)
    cuts = bounds(dim, parts)
    first = [r.v for r in kept.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()]
    start = whole_numbers(np.array(first, float).reshape(len(first), dim))
    books = [start[:, a:b] for a, b in cuts]
    for _ in range(rounds if first else 0):
        books = refined(kept, books, cuts, dim)
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    kind = kept.schema["row"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b, x in _blocks(batches, dim):
            code, error = np.full(len(x), "", object), np.zeros(len(x), object)
            for _, number, entry, far in _assigned(x, books, cuts):
                code += np.array([f"{e:0{digits}x}" for e in entry.tolist()], object)[number]
                error += far.astype(object)[number]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(code.tolist(), pa.string()),
                                              pa.array([min(int(e), LARGEST) for e in error], pa.int64())], ["row", "code", "error"])

    return kept.select("row", "v").mapInArrow(run, f"row {kind}, code string, error bigint"), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Of all components in order of part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``: the errors added up over equal labels, NULLs together; coded rows are staged for it.

    Beyond a BIGINT it is the largest BIGINT.
    """
    coded = staged(coded.withColumn("l", F.col("row")[label]))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint")
    sums = staged(coded.groupBy(F.col("l").alias("s_l")).agg(total.alias("label_error")))
    return coded.join(small(sums), F.col("l").eqNullSafe(F.col("s_l"))).drop("l", "s_l")
