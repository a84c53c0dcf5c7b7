"""Near duplicates by SimHash fingerprints that meet under Golay codewords."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.bpe import ROWS
from pulsegrid.llm.common import staged, text_of
from pulsegrid.llm.components import components

#: Bits of the three segments of a fingerprint; each is padded with zeros to the 23 bits of the code.
SEGMENTS = (22, 21, 21)
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SHINGLE, SEED = 3, 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half the XXH64 of the text's shingles (repeats count); 0 without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks cut
    if not words:
        return 0
    joined = b" ".join(words)
    one = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return one(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = (stops - sizes)[:len(words) - shingle + 1].tolist()
    hashes = np.fromiter((one(joined[a:b], SEED) for a, b in zip(starts, stops[shingle - 1:].tolist())), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        counts += np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", identifier: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``id`` and ``fp`` (BIGINT with the fingerprint's bits) of every row; NULL text counts as empty."""
    import pyarrow as pa

    t = docs.select(docs[identifier].alias("id"), text_of(docs, text).alias("t"))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                fp = np.array([fingerprint(x, shingle) for x in b.column("t").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp)], ["id", "fp"])

    return t.mapInArrow(run, f"id {t.schema['id'].dataType.simpleString()}, fp bigint")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome of 23-bit words: what division by the generator leaves."""
    w = words.astype(np.int64)
    for bit in range(22, 10, -1):
        w = np.where(w >> bit & 1, w ^ (GENERATOR << (bit - 11)), w)
    return w


@lru_cache(maxsize=1)
def corrections() -> np.ndarray:
    """Error pattern by syndrome: the code is perfect, each of 2^11 syndromes has one pattern of at most three errors."""
    patterns = np.array([sum(1 << i for i in c) for k in range(4) for c in combinations(range(23), k)], np.int64)
    table = np.zeros(1 << 11, np.int64)
    table[_remainder(patterns)] = patterns
    return table


def codeword_index(segments: np.ndarray) -> np.ndarray:
    """The 12 message bits of the codeword nearest to each 23-bit word."""
    return (segments ^ corrections()[_remainder(segments)]) >> 11


def segment_keys(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each segment its own index, and the indices (a row each) of all words one bit or none away."""
    out, at = [], 0
    for bits in SEGMENTS:
        segment = (fps >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64)
        flips = np.array([0, *(1 << i for i in range(bits))], np.int64)
        out.append((codeword_index(segment), codeword_index(segment[:, None] ^ flips[None, :])))
        at += bits
    return out


def keyed(fps: DataFrame) -> DataFrame:
    """``fp``, ``key`` and ``home`` for distinct fingerprints.

    Three errors in three segments leave two segments with at most one error each. The key names such two segments and
    a codeword of each: a fingerprint is at home under its own codewords, and visits those of all words one bit away,
    which are the homes of whatever differs there by one bit. A segment has one to a few different codewords nearby.
    """
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4 * ROWS):
                fp = whole.slice(at, 4 * ROWS).column("fp").to_numpy(zero_copy_only=False)
                near = segment_keys(fp.view(np.uint64))
                rows, keys, homes = [], [], []
                every = np.arange(len(fp))
                for n, (i, j) in enumerate(combinations(range(3), 2)):
                    rows.append(every)
                    keys.append(n << 24 | near[i][0] << 12 | near[j][0])
                    homes.append(np.ones(len(fp), bool))
                    first, second = (np.sort(near[x][1], axis=1) for x in (i, j))
                    new = [np.concatenate([np.ones((len(fp), 1), bool), np.diff(s, axis=1) != 0], axis=1) for s in (first, second)]
                    r, a, b = np.nonzero(new[0][:, :, None] & new[1][:, None, :])
                    rows.append(r)
                    keys.append(n << 24 | first[r, a] << 12 | second[r, b])
                    homes.append(np.zeros(len(r), bool))
                r = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays([pa.array(fp[r]), pa.array(np.concatenate(keys).astype(np.int32)),
                                                  pa.array(np.concatenate(homes))], ["fp", "key", "home"])

    return fps.select("fp").mapInArrow(run, "fp bigint, key int, home boolean")


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs a < b of distinct fingerprints that differ in at most ``distance`` (up to 3) bits."""
    k = staged(keyed(fps))
    home = k.where("home").select("key", F.col("fp").alias("b"))
    visit = k.where("not home").select("key", F.col("fp").alias("a"))
    return visit.join(home, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
                                         ).select("a", "b")


def near_duplicates(docs: DataFrame, text: str = "text", identifier: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``id``, ``fp`` and ``component`` (the smallest id reachable over linked fingerprints) of every row.

    Equal fingerprints are merged before anything is compared. NULL text counts as empty: texts without words have
    fingerprint 0. Rows may repeat; a NULL id is linked like any other but is never the smallest, unless its group has
    no other; an empty table gives an empty one.
    """
    f = staged(fingerprints(docs, text, identifier, shingle))
    one = staged(f.groupBy("fp").agg(F.min("id").alias("least")))
    c = components(links(one))
    named = one.join(c, one.fp == c.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    named = staged(named)
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component"))
    by_fp = staged(named.join(least, named.root == least.r).select(F.col("fp").alias("c_fp"), "component"))
    return f.join(by_fp, f.fp == by_fp.c_fp).select("id", "fp", "component")


def one_of_each(docs: DataFrame, text: str = "text", identifier: str = "doc_id", **options) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; rows that repeat that id all stay.

    A document with a NULL id stays if its group has no id at all.
    """
    d = near_duplicates(docs, text, identifier, **options)
    kept = d.where(F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("kept_id")).distinct()
    return docs.join(kept, docs[identifier].eqNullSafe(kept.kept_id), "left_semi")
