"""Byte-level BPE: encoding with a priority queue of merge ranks over a linked list, and decoding."""

from __future__ import annotations

import heapq
import json
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import text_of

# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries of each of a cache's two generations, and the longest piece that is kept.
CACHED, CACHED_CHARS = 300_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Generations(dict):
    """A cache of bounded size: when full it becomes the old generation, whose entries return when asked for."""

    def __init__(self, make, entries: int | None = None):
        super().__init__()
        self.make, self.old, self.entries = make, {}, entries or CACHED

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Awkward(Exception):
    """A text whose blanks don't stand alone between words."""


class Codec:
    """Encodes texts to little-endian 32-bit ids and back, after a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        vocab, letters = j["model"]["vocab"], byte_letters()
        self.of_byte = [vocab[c] for c in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in j["model"]["merges"])
        self.merge = {vocab[a] << 32 | vocab[b]: rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        back = {c: b for b, c in enumerate(letters)}
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(PATTERN)
        self.pieces = Generations(self.merged)
        self.first = Generations(lambda s: self.between_blanks(s, s))
        self.other = Generations(lambda s: self.between_blanks(s, " " + s))

    def merged(self, piece: str) -> bytes:
        """Merges a piece: the queue holds rank and place; an entry whose pair is no longer there is skipped."""
        of_byte, find = self.of_byte, self.merge.get
        ids = [of_byte[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            m = find(ids[i] << 32 | ids[i + 1])
            if m is not None:
                queue.append((m, i))
        heapq.heapify(queue)
        while queue:
            m, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n or find(ids[i] << 32 | ids[j]) != m:
                continue
            ids[i], ids[j] = m & 0xFFFFFFFF, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = find(ids[i] << 32 | ids[k])
                if m is not None:
                    heapq.heappush(queue, (m, i))
            h = before[i]
            if h >= 0:
                m = find(ids[h] << 32 | ids[i])
                if m is not None:
                    heapq.heappush(queue, (m, h))
        return array("I", [x for x in ids if x >= 0]).tobytes()

    def between_blanks(self, bare: str, piece: str) -> bytes:
        if not bare or bare[0].isspace() or bare[-1].isspace():
            raise Awkward
        return b"".join(map(self.pieces.__getitem__, self.words.findall(piece)))

    def plain(self, text: str) -> bytes:
        """A text without special tokens. A blank between two words starts a piece whatever stands around it."""
        head, *rest = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.other.__getitem__, rest))
        except Awkward:
            return b"".join(map(self.pieces.__getitem__, self.words.findall(text)))

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return self.plain(text)
        return b"".join(self.special[s].to_bytes(4, "little") if s in self.special else self.plain(s)
                        for s in self.cut_special.split(text) if s)

    def decode(self, ids: bytes) -> str:
        a = array("I")
        a.frombytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, a)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per Python worker, with its caches."""
    return Codec(path)


ROWS = 500


def _mapped(df: DataFrame, column: str, out: str, kind: str, make) -> DataFrame:
    """The frame with ``column`` replaced by ``out`` of Spark type ``kind``, worked out in small Arrow batches."""
    import pyarrow as pa

    types = {"binary": pa.large_binary(), "string": pa.large_string()}
    kept = [c for c in df.columns if c != column]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column), f"`{out}` {kind}"])

    def run(batches):
        one = make()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                made = pa.array([one(x) for x in b.column(column).to_pylist()], types[kind]).cast(
                    pa.binary() if kind == "binary" else pa.string())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), made], [*kept, out])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """``id`` and ``ids``: the token ids of the whole text as little-endian unsigned 32-bit integers, in one binary.

    NULL text counts as empty and has no ids. Special tokens of the file are recognised in the text. Rows may repeat
    and ids may be NULL; an empty table gives an empty one. Words are cached in bounded memory per worker.
    """
    t = docs.select(docs[identifier].alias("id"), text_of(docs, text).alias("t"))
    return _mapped(t, "t", "ids", "binary", lambda: codec(path).encode)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``decoded`` in place of ``ids``: the vocabulary's strings one after the other; bytes that are no UTF-8 are replaced.

    NULL ids count as none.
    """
    e = encoded.withColumn("ids", F.coalesce("ids", F.lit(b"")))
    return _mapped(e, "ids", "decoded", "string", lambda: codec(path).decode)
