"""Packing of token pieces into sequences as a cutting-stock problem, solved by column generation."""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.bpe import CACHED_CHARS, ROWS, Generations, byte_letters
from pulsegrid.llm.common import staged, text_of

#: Tokens per unit of length in the linear program, and pieces in which documents of a length are ranked.
UNIT, BUCKETS = 16, 256
#: Pieces shorter than 1 / SHORT of a sequence are bundled to nearly whole ones, in buckets of about BUNDLES sequences.
SHORT, BUNDLES = 32, 16

#: Letters that have one small form each, and a mark or none behind them.
PLAIN = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)").fullmatch

#: How the tokenizer cuts a lower-cased word of printable ASCII.
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall

#: Entries of each generation of known words.
KNOWN = 600_000

#: What str.split() takes for white space though Unicode doesn't.
MORE_BLANKS = ("\x1c", "\x1d", "\x1e", "\x1f")


class Words:
    """Ids of a text by the tokenizers library, word by word, for a tokenizer that drops white space.

    White space then cuts a text into words that don't touch each other, so the ids of a word are the same in every text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.words = Generations(self.word, KNOWN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spelling = {b: c for b, c in enumerate(byte_letters()) if chr(b) != c}  # how a byte-level model writes bytes
        # another kind of tokenizer encodes whole words only
        self.direct = all(self.letters(w) == self.whole(w) == self.whole(w.upper()) and self.whole(w + m) == self.whole(w) + self.whole(m)
                          for w in ("hello", "été", "übergrößen", "øyn") for m in ".,;:!?" if w.upper().lower() == w)
        marks = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
        self.cuts = self.direct and all(self.cut(w) == self.whole(w) for m in marks for w in (
            m, f"a{m}B", f"{m}{m}re1", f"don{m}t{m}S", f"we{m}LL{m}m9{m}VEx", f"{m}d{m}{m}R{m}re", f"12{m}z{m}st3{m}Dog", f"a{m}'s'{m}'Re{marks}"))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes:
        """A word of small letters, past the normalizer and the cutting into pieces, which leave it as it is."""
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.spelling)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def cut(self, word: str) -> bytes:
        """A word of printable ASCII, past the normalizer, which lower-cases it; parts of letters share what is cached."""
        return b"".join([self.words[p] if p.isalpha() else self.letters(p) for p in CUT(word.lower())])

    def word(self, word: str) -> bytes:
        """Letters and a mark behind them don't touch, and the tokenizer lower-cases: such words share what is cached."""
        plain = PLAIN(word) if self.direct else None
        if plain is None:
            if self.cuts and word.isascii() and word.isprintable() and len(word) <= CACHED_CHARS and not any(t in word for t in self.special):
                return self.cut(word)
            return self.whole(word)
        low, mark = plain[1].lower(), plain[2]
        if mark:
            return self.words[low] + self.words[mark]
        return self.letters(low) if low == word else self.words[low]

    def encode(self, text: str) -> bytes:
        if any(c in text for c in MORE_BLANKS):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(maxsize=4)
def words(path: str) -> Words:
    return Words(path)


def pieces(docs: DataFrame, path: str, length: int = 4096, end: int = 2, text: str = "text", identifier: str = "doc_id",
           with_ids: bool = False) -> DataFrame:
    """Each document's ids with ``end`` behind them, cut into pieces of ``length`` and a rest.

    Columns: id, start, length, crc (of the ids as little-endian 32-bit integers), doc_tokens and, if wanted, ids as one
    binary. NULL text counts as empty: its one piece is ``end`` alone.
    """
    import pyarrow as pa

    t = docs.select(docs[identifier].alias("id"), text_of(docs, text).alias("t"))
    cut = "array<struct<start:bigint,length:bigint,crc:bigint,doc_tokens:bigint,ids:binary>>"
    field = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("doc_tokens", pa.int64()),
                                ("ids", pa.binary())]))
    last, step = int(end).to_bytes(4, "little"), 4 * length

    def run(batches):
        encode = words(path).encode
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b, out = whole.slice(at, ROWS), []
                for x in b.column("t").to_pylist():
                    ids = encode(x) + last
                    out.append([{"start": s // 4, "length": len(p) // 4, "crc": zlib.crc32(p), "doc_tokens": len(ids) // 4,
                                 "ids": p if with_ids else None}
                                for s in range(0, len(ids), step) for p in [ids[s:s + step]]])
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, field)], ["id", "p"])

    kind = t.schema["id"].dataType.simpleString()
    p = t.mapInArrow(run, f"id {kind}, p {cut}").select("id", F.explode("p").alias("p")).select("id", "p.*")
    return p if with_ids else p.drop("ids")


def _best_pattern(prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of lengths 1..room with the highest price, repeats allowed: an unbounded knapsack by dynamic programming."""
    value, taken = np.zeros(room + 1), np.zeros(room + 1, int)
    for w in range(1, room + 1):
        v = prices[:w] + value[w - 1::-1][:w]  # length l leaves w - l
        best = int(np.argmax(v))
        if v[best] > value[w - 1] + 1e-12:
            value[w], taken[w] = v[best], best + 1
        else:
            value[w] = value[w - 1]
    pattern, w = np.zeros(room, int), room
    while w > 0:
        if taken[w]:
            pattern[taken[w] - 1] += 1
            w -= taken[w]
        else:
            w -= 1
    return float(value[room]), pattern


def column_generation(demand: dict[int, int], room: int, gap: float = 2e-4, rounds: int = 4000) -> list[tuple[float, dict[int, int]]]:
    """Fractional numbers of patterns that meet the demand per length with nearly the fewest sequences.

    Starts with patterns of one length each. In each round the dual prices of the lengths go into the knapsack; its
    pattern enters the basis. Ends when prices allow at most ``gap`` of improvement.
    """
    lengths = sorted(c for c, n in demand.items() if n > 0)
    if not lengths:
        return []
    at = np.array(lengths) - 1
    d = np.array([float(demand[c]) for c in lengths])
    basis = np.diag([room // c for c in lengths]).astype(float)
    inverse, x = np.linalg.inv(basis), d / (room // np.array(lengths))
    for r in range(rounds):
        prices = np.zeros(room)
        dual = inverse.sum(axis=0)
        prices[at] = np.maximum(dual, 0)
        value, pattern = _best_pattern(prices, room)
        column = pattern[at].astype(float)
        if float(dual @ column) <= 1 + 1e-9 or x.sum() * (1 - 1 / value) <= gap * x.sum():
            break
        direction = inverse @ column
        positive = direction > 1e-9
        ratio = np.full(len(x), np.inf)
        ratio[positive] = x[positive] / direction[positive]
        leaving = int(np.argmin(ratio))
        step = max(ratio[leaving], 0.0)
        x = np.maximum(x - step * direction, 0)
        x[leaving] = step
        basis[:, leaving] = column
        if r % 64 == 63:  # afresh against rounding errors
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ d, 0)
        else:
            pivot = inverse[leaving] / direction[leaving]
            inverse = inverse - np.outer(direction, pivot)
            inverse[leaving] = pivot
    return [(float(n), {c: int(round(k)) for c, k in zip(lengths, basis[:, j]) if round(k)}) for j, n in enumerate(x)]


def plan(demand: dict[int, int], room: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank behind the last, per sequence, first sequence) for every length's documents.

    Patterns are used a whole number of times; what rounding leaves, at most a basis of patterns, is packed first-fit
    by falling length.
    """
    left, out, sequence = dict(demand), [], 0
    done = dict.fromkeys(demand, 0)

    def use(pattern, times):
        nonlocal sequence
        for c, k in pattern.items():
            out.append((c, done[c], done[c] + k * times, k, sequence))
            done[c] += k * times
            left[c] -= k * times
        sequence += times

    for n, pattern in column_generation(demand, room):
        times = min([int(n + 1e-6), *(left[c] // k for c, k in pattern.items())])
        if times > 0:
            use(pattern, times)
    while any(left.values()):  # each turn empties a length or fills a sequence
        pattern, space = {}, room
        for c in sorted((c for c in left if left[c]), reverse=True):
            k = min(left[c], space // c)
            if k:
                pattern[c], space = k, space - k * c
        use(pattern, min(left[c] // k for c, k in pattern.items()))
    return out


def _bundled(cut: DataFrame, length: int) -> DataFrame:
    """The pieces with bucket ``b``, number of their ``bundle`` (NULL for a long piece), ``item_length`` of the bundle or of the
    piece itself, and ``opens``: 1 for a long piece and for the first of a bundle, else 0. Staged.

    Short pieces of about equal length, up to a power of two, are laid end to end in buckets; those that begin in the same
    stretch are a bundle. A stretch is so much less than a sequence that the last piece still fits.
    """
    none = F.lit(None).cast("bigint")
    long = cut.where(F.col("length") >= length // SHORT).select(
        "*", F.pmod(F.xxhash64("id", "start"), F.lit(BUCKETS)).cast("int").alias("b"), none.alias("place"), none.alias("bundle"),
        F.col("length").alias("item_length"), F.lit(1).alias("opens"))
    short = cut.where(F.col("length") < length // SHORT).withColumn("bits", F.length(F.bin("length")))
    tokens = {r.bits: r.n for r in short.groupBy("bits").agg(F.sum("length").alias("n")).collect()}  # a row per power of two
    parts = F.lit(1).cast("bigint")
    for bits, n in tokens.items():
        parts = F.when(F.col("bits") == bits, F.lit(1 + n // (BUNDLES * length)).cast("bigint")).otherwise(parts)
    short = short.withColumn("place", F.pmod(F.xxhash64("id", "start"), parts))
    at = F.expr("sum(length) over (partition by bits, place order by id, start, crc rows between unbounded preceding and current row) - length")
    stretch = F.lit(length + 2) - F.call_function("shiftleft", F.lit(1), F.col("bits"))
    short = short.withColumn("bundle", F.floor(at / stretch))
    one = "partition by bits, place, bundle"
    short = short.select(*cut.columns, F.pmod(F.xxhash64("bits", "place"), F.lit(BUCKETS)).cast("int").alias("b"),
                         F.struct("bits", "place").alias("place"), "bundle", F.expr(f"sum(length) over ({one})").alias("item_length"),
                         F.expr(f"CASE WHEN row_number() over ({one} order by id, start, crc) = 1 THEN 1 ELSE 0 END").alias("opens"))
    return staged(long.withColumn("place", F.lit(None).cast(short.schema["place"].dataType)).unionByName(short))


def pack(cut: DataFrame, length: int = 4096, unit: int = UNIT) -> DataFrame:
    """The staged pieces with ``sequence_id`` (gapless from 0) and ``offset`` in it.

    The linear program sees lengths in units, rounded up: a histogram of at most length / unit numbers goes to the
    driver and a plan of patterns comes back, whatever the size of the corpus. Short pieces, on which rounding would lose
    much, are bundled first, by running sums in buckets; a bundle is planned like a piece, and its pieces follow one another in it.
    Pieces of a length are ranked in buckets, so a length that a third of all pieces have is no single task. Repeated rows are
    pieces of their own.
    """
    room = length // unit
    bundled = _bundled(cut, length)
    # the bucket of a piece depends on its document, not on its length
    p = bundled.select("*", F.ceil(F.col("item_length") / unit).cast("int").alias("c"))
    counts = staged(p.groupBy("c", "b").agg(F.sum("opens").alias("n")))  # at most room * BUCKETS rows
    demand = {r.c: r.n for r in counts.groupBy("c").agg(F.sum("n").alias("n")).collect()}
    spark = cut.sparkSession
    intervals = spark.createDataFrame(plan(demand, room), "p_c int, low long, high long, per long, first long")
    before = counts.select(F.col("c").alias("o_c"), F.col("b").alias("o_b"), F.expr(
        "sum(n) over (partition by c order by b) - n").alias("before"))
    ranked = p.withColumn("k", F.expr("sum(opens) over (partition by c, b order by place, bundle, id, start, crc rows between unbounded preceding and current row)") - 1)
    ranked = ranked.join(F.broadcast(before), (F.col("c") == F.col("o_c")) & (F.col("b") == F.col("o_b"))).select(
        *p.columns, (F.col("k") + F.col("before")).alias("rank"))
    placed = ranked.join(F.broadcast(intervals), (F.col("c") == F.col("p_c")) & (F.col("rank") >= F.col("low"))
                         & (F.col("rank") < F.col("high")))
    placed = placed.select(*p.columns, "rank", (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("per")))
                           .cast("bigint").alias("sequence_id"))
    return placed.select(*cut.columns, "sequence_id", F.expr(
        "sum(length) over (partition by sequence_id order by c desc, rank, id, start, crc rows between unbounded preceding and current row) - length").cast("bigint").alias("offset"))


def sequences(packed: DataFrame, length: int = 4096, pad: int = 0) -> DataFrame:
    """``sequence_id`` and ``ids``: the sequences themselves, from packed pieces that carry their ids.

    Filled up to ``length`` with ``pad``, except where the tokens are a power of two in number.
    """
    import pyarrow as pa

    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))

    def run(batches):
        for b in batches:
            out = []
            for ps in b.column("p").to_pylist():
                ids = np.frombuffer(b"".join(x["ids"] for x in ps), "<u4").astype("int32")
                n = len(ids) if len(ids) & (len(ids) - 1) == 0 else length
                out.append(np.concatenate([ids, np.full(n - len(ids), pad, "int32")]))
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), pa.array(out, pa.list_(pa.int32()))], ["sequence_id", "ids"])

    return grouped.mapInArrow(run, "sequence_id bigint, ids array<int>")
