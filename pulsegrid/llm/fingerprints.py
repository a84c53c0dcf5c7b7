"""Fingerprints of documents from which the paragraphs that differ between two versions can be recovered."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import packed, staged, text_of

#: A paragraph ends with a line or a sentence, so that texts on one line have several; every character belongs to one.
PARAGRAPH = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
#: Cells of each of the three tables of a fingerprint; tables of a retry are about four times as wide.
WIDTH = 5
#: Characters and documents that are worked on at once, and cells of retried sketches held at once.
CHARS, DOCUMENTS, CELLS = 1 << 21, 512, 1 << 20

CELL = np.dtype([("n", ">u4"), ("key", ">u8"), ("check", ">u4")])
LOW = np.uint64(0xFFFFFFFF)


def paragraph_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit digests of all paragraphs, number of the text of each). A repeat has a digest of its own, by its count."""
    split, out, owner = re.compile(PARAGRAPH).findall, [], []
    for text in texts:
        seen, n = {}, len(out)
        for p in split(text):
            k = seen.get(p, 0)
            seen[p] = k + 1
            out.append(hashlib.md5(f"{k}:{p}".encode(), usedforsecurity=False).digest())
        owner.append(len(out) - n)
    keys = np.frombuffer(b"".join(out), ">u8").reshape(-1, 2)[:, 0].astype(np.uint64)
    return keys, np.repeat(np.arange(len(texts)), owner)


def _check(keys: np.ndarray) -> np.ndarray:
    """32 bits that follow from a digest but not from the sum of several."""
    return (keys >> np.uint64(32)) * (keys & LOW) >> np.uint64(16) & LOW


def _cells(keys: np.ndarray, owner: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each digest in each of the three tables of its owner."""
    return [(owner * 3 + j) * width + ((keys >> np.uint64(16 * j) & LOW) % np.uint64(width)).astype(np.int64) for j in range(3)]


class Sketches:
    """Sketches of several documents: for each cell the number of digests in it, their sum and that of their checks.

    Sums are exclusive ors. Sketches of equal width subtract cell by cell; digests that both have vanish.
    """

    def __init__(self, keys: np.ndarray, owner: np.ndarray, documents: int, width: int):
        self.width = width
        self.n = np.zeros(documents * 3 * width, np.int64)
        self.key, self.check = np.zeros(len(self.n), np.uint64), np.zeros(len(self.n), np.uint64)
        self.add(keys, owner, 1)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign) -> None:
        check = _check(keys)
        for cell in _cells(keys, owner, self.width):
            np.add.at(self.n, cell, sign)
            np.bitwise_xor.at(self.key, cell, keys)
            np.bitwise_xor.at(self.check, cell, check)

    def subtract(self, mine: np.ndarray, other: np.ndarray) -> Sketches:
        """Document ``mine[i]`` less document ``other[i]``, for each i."""
        out = Sketches(np.zeros(0, np.uint64), np.zeros(0, np.int64), len(mine), self.width)
        rows = lambda a, of: a.reshape(-1, 3 * self.width)[of]
        out.n = (rows(self.n, mine) - rows(self.n, other)).ravel()
        out.key, out.check = ((rows(a, mine) ^ rows(a, other)).ravel() for a in (self.key, self.check))
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digests, their document, +1 or -1 for the side that has them, documents of which all cells became empty).

        A cell with one digest gives it away; taking it out of its other cells lays further ones bare. Consumes the sketch.
        """
        size, found = 3 * self.width, []
        for _ in range(size):  # a round at least empties a cell for good
            pure = np.flatnonzero((np.abs(self.n) == 1) & (_check(self.key) == self.check))
            key, document, table = self.key[pure], pure // size, pure % size // self.width
            own = (key >> (16 * table).astype(np.uint64) & LOW) % np.uint64(self.width) == (pure % self.width).astype(np.uint64)
            pure, key, document = pure[own], key[own], document[own]
            if not len(pure):
                break
            order = np.lexsort((key, document))  # a digest may be alone in two of its cells
            new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (document[order][1:] != document[order][:-1])])
            pick = order[new]
            key, document, sign = key[pick], document[pick], self.n[pure[pick]]
            self.add(key, document, -sign)
            found.append((key, document, sign))
        keys, documents, signs = (np.concatenate(c) for c in zip(*found)) if found else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        empty = ~((self.n != 0) | (self.key != 0) | (self.check != 0)).reshape(-1, size).any(axis=1)
        return keys, documents, signs, empty

    def packed(self) -> list[bytes]:
        """Each document's cells in order: number, sum and check, big-endian."""
        cells = np.empty(len(self.n), CELL)
        cells["n"], cells["key"], cells["check"] = self.n, self.key, self.check
        data, step = cells.tobytes(), 3 * self.width * CELL.itemsize
        return [data[at:at + step] for at in range(0, len(data), step)]


def differences(keys: np.ndarray, owner: np.ndarray, base: Sketches, mine: np.ndarray, other: np.ndarray):
    """(digests, pair, side) of the paragraphs in which the documents of each pair differ.

    The base sketches are subtracted and peeled; pairs that differ in more than they can hold are sketched again, about
    four times as wide, until the peeling of each comes to its end.
    """
    out, open_, width, sketches = [], np.arange(len(mine)), base.width, base
    starts = np.searchsorted(owner, np.arange(owner[-1] + 2 if len(owner) else 1))
    while len(open_):
        failed = []
        for at in range(0, len(open_), max(1, CELLS // (3 * width))):
            pairs = open_[at:at + max(1, CELLS // (3 * width))]
            a, b = mine[pairs], other[pairs]
            if sketches is None:  # only the documents of these pairs, numbered anew
                used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
                spans = [(starts[u], starts[u + 1]) if u + 1 < len(starts) else (0, 0) for u in used]
                k = np.concatenate([keys[x:y] for x, y in spans])
                o = np.repeat(np.arange(len(used)), [y - x for x, y in spans])
                s, a, b = Sketches(k, o, len(used), width), place[:len(a)], place[len(a):]
            else:
                s = sketches
            key, pair, side, empty = s.subtract(a, b).peel()
            good = empty[pair]
            out.append((key[good], pairs[pair[good]], side[good]))
            failed.append(pairs[~empty])
        open_, width, sketches = np.concatenate(failed), 4 * width + 3, None
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int))


def likeness(sizes: np.ndarray, pair: np.ndarray, side: np.ndarray, mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Paragraphs that both have, of all that one has; 1 for two documents without any."""
    less = np.bincount(pair[side > 0], minlength=len(mine))
    more = np.bincount(pair[side < 0], minlength=len(mine))
    both, union = sizes[mine] - less, sizes[mine] + more
    return np.where(union > 0, both / np.maximum(union, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by as many characters from the start of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(texts: list[str], width: int) -> list[tuple]:
    """(n_chars, digest of the edited text, fingerprint, fingerprint of the edited text, two likenesses) of each text but the
    last, which only follows."""
    n = len(texts) - 1
    new = [edited(t, f) for t, f in zip(texts, texts[1:])]
    keys, owner = paragraph_keys(texts + new)
    base = Sketches(keys, owner, 2 * n + 1, width)
    mine, other = np.tile(np.arange(n), 2), np.concatenate([np.arange(n) + n + 1, np.arange(n) + 1])
    _, pair, side = differences(keys, owner, base, mine, other)
    near = likeness(np.bincount(owner, minlength=2 * n + 1), pair, side, mine, other).tolist()
    cells = base.packed()
    return [(len(texts[i]), hashlib.sha256(new[i].encode()).digest(), cells[i], cells[n + 1 + i], near[i], near[n + i])
            for i in range(n)]


#: What tasks hand on: results, and the text and place of the first and last document of a range.
RESULT = ("n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double")


def versions(docs: DataFrame, text: str = "text", identifier: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``id`` and, for each document and its edited text, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (binary), ``near_edited`` and ``near_next``.

    The edited text ends with the start of the next document in ascending id (after the last: the first). Documents are
    shuffled once, into ranges of ids, and read in order with one block of them in memory; the last of a range meets the first
    of the next through a table of two rows per range. NULL text is empty. NULL ids come first; documents of one id are
    ordered by a hash of their text, and repeated rows are documents of their own. Texts without paragraphs have an
    empty sketch and are like each other (1). A table with one document has it as its own next; an empty table gives an empty one.
    """
    import pyarrow as pa

    order = ["id", "h", "s"]
    t = docs.select(docs[identifier].alias("id"), text_of(docs, text).alias("t"))
    t = t.select("id", F.xxhash64("t").alias("h"), F.monotonically_increasing_id().alias("s"), "t")
    kind = t.schema["id"].dataType.simpleString()
    ranged = t.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches):
        id_type = None

        def batch(rows, results, end=None):
            fields = [pa.array([r[0] for r in rows], id_type), pa.array([r[1] for r in rows], pa.int64()),
                      pa.array([r[2] for r in rows], pa.int64()), pa.array([end] * len(rows), pa.string()),
                      pa.array([r[3] if end else None for r in rows], pa.string())]
            fields += [pa.array([x[k] for x in results] if results else [None] * len(rows), kinds[k]) for k in range(len(kinds))]
            return pa.RecordBatch.from_arrays(fields, [*order, "place", "t", *names])

        held, chars, begun = [], 0, False
        for whole in batches:
            id_type = whole.schema.field("id").type
            for at in range(0, whole.num_rows, DOCUMENTS):
                part = whole.slice(at, DOCUMENTS)
                for row in zip(*(part.column(c).to_pylist() for c in (*order, "t"))):
                    if not begun:
                        yield batch([row], None, "first")
                        begun = True
                    held.append(row)
                    chars += len(row[3])
                    if len(held) > 1 and (chars >= CHARS or len(held) > DOCUMENTS):
                        yield batch(held[:-1], _compared([r[3] for r in held], width))
                        held, chars = held[-1:], len(row[3])
        if len(held) > 1:
            yield batch(held[:-1], _compared([r[3] for r in held], width))
        if held:
            yield batch(held[-1:], None, "last")

    done = staged(ranged.mapInArrow(run, f"id {kind}, h bigint, s bigint, place string, t string, {RESULT}"))
    # first and last rows of the ranges take turns; each last one is followed by the first of the next range
    ends = staged(done.where("place is not null").select(*order, "place", "t"))
    turn = staged(ends.select(*order, "place").withColumn("r", F.expr("row_number() over (order by id, h, s, place)"))
                  .withColumn("of", F.expr("count(*) over ()")))
    named = ends.join(turn.select(*[F.col(c).alias(f"r_{c}") for c in (*order, "place")], "r", "of"), F.col("id").eqNullSafe(F.col("r_id"))
                      & (F.col("h") == F.col("r_h")) & (F.col("s") == F.col("r_s")) & (F.col("place") == F.col("r_place")))
    named = staged(named.select("id", "t", "place", "r", F.when(F.col("r") == F.col("of"), 1).otherwise(F.col("r") + 1).alias("then")))
    first = named.where("place = 'first'").select(F.col("t").alias("following"), F.col("r").alias("f_r"))
    pairs = named.where("place = 'last'").join(first, F.col("then") == F.col("f_r")).select("id", "t", "following")

    def finish(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                b = whole.slice(i, 1)
                (result,) = _compared(b.column("t").to_pylist() + b.column("following").to_pylist(), width)
                yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array([v], k) for v, k in zip(result, kinds))], ["id", *names])

    rest = pairs.mapInArrow(finish, f"id {kind}, {RESULT}")
    return done.where("place is null").select("id", *names).unionByName(rest)


def compared(pairs: DataFrame, a: str, b: str, width: int = WIDTH) -> DataFrame:
    """``row`` (all columns), ``only_a``, ``only_b`` (digests of the paragraphs that one version has and the other lacks,
    as hexadecimal text, sorted) and ``likeness`` of two versions in each row. NULL text is empty."""
    import pyarrow as pa

    t = packed(pairs, a=text_of(pairs, a), b=text_of(pairs, b))

    def run(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                r = whole.slice(i, 1)
                keys, owner = paragraph_keys(r.column("a").to_pylist() + r.column("b").to_pylist())
                mine, other = np.zeros(1, int), np.ones(1, int)
                key, pair, side = differences(keys, owner, Sketches(keys, owner, 2, width), mine, other)
                near = likeness(np.bincount(owner, minlength=2), pair, side, mine, other)
                only = [pa.array([sorted(f"{k:016x}" for k in key[side == s].tolist())], pa.list_(pa.string())) for s in (1, -1)]
                yield pa.RecordBatch.from_arrays([r.column("row"), *only, pa.array(near)], ["row", "only_a", "only_b", "likeness"])

    kind = t.schema["row"].dataType.simpleString()
    return t.mapInArrow(run, f"row {kind}, only_a array<string>, only_b array<string>, likeness double")
