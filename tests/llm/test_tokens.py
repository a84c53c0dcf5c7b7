"""BPE coding and packing against the tokenizers library; sharding by its laws."""

import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm import bpe, packing, sharding
from tests.llm.conftest import ODD

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", " ", "\n", "\t", "a", "b", "é", "\x1c", "\x85", "\xa0", "1", "２", ".", "'s", "<|endoftext|>", "<|startoftext|>", "the", " the",
         "日", "The", "AND.", "end,", "x!", "́", "‍", "😀", "\r", "\x00", "'ll", "İ", "ſ", "K", "Σ"]


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def odd_texts():
    r = random.Random(5)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(3000)] + ["", " " * 500, "a" * 20_000, "x " * 9000]


def test_ids_equal_the_library(odd_texts):
    t, c, w = library(BYTES), bpe.Codec(BYTES), packing.Words(WORDS)
    other = library(WORDS)
    for s in odd_texts:
        ids = t.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(c.encode(s), "<u4").tolist() == ids, repr(s)
        assert c.decode(c.encode(s)) == t.decode(ids, skip_special_tokens=False)
        assert np.frombuffer(w.encode(s), "<u4").tolist() == other.encode(s, add_special_tokens=False).ids, repr(s)


def test_ascii_words_are_cut_as_the_library_does():
    w, r = packing.Words(WORDS), random.Random(7)
    assert w.direct and w.cuts
    for _ in range(5000):
        x = "".join(r.choice("abzABZstREllVEmdT'''.-_/()<>|\\\"#$&*+=0189") for _ in range(r.randint(1, 12)))
        assert w.word(x) == w.whole(x), x
    for x in ("<|endoftext|>", "a<|endoftext|>b", "<|x", "a\x00b", "don\x7ft", "x" * 200 + "-1"):
        assert w.word(x) == w.whole(x), x


def test_decoding_any_ids():
    ids = [random.Random(3).randrange(50257) for _ in range(3000)]
    assert bpe.Codec(BYTES).decode(array("I", ids).tobytes()) == library(BYTES).decode(ids, skip_special_tokens=False)


def test_cache_is_bounded_and_forgets_nothing_needed(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    g = bpe.Generations(lambda s: s.upper().encode())
    for k in [*range(40), *range(40)]:
        assert g[f"k{k}"] == f"K{k}".encode()
        assert len(g) <= 5 and len(g.old) <= 5


def test_encode_and_decode_frames(odd, empty):
    e = bpe.encode(odd, BYTES)
    back = bpe.decode(e, BYTES)
    assert Counter((r.id, r.decoded) for r in back.collect()) == Counter((o[0], o[1] or "") for o in ODD)
    assert bpe.decode(bpe.encode(empty, BYTES), BYTES).count() == 0


def check_packing(rows, texts, length):
    t, by_doc, by_seq = library(WORDS), {}, {}
    for r in rows:
        by_doc.setdefault((r.id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in texts:
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [2], "<u4")
        parts = sorted(by_doc[i, len(ids)], key=lambda r: r.start)
        copies = len(parts) * 0 + sum(r.length for r in parts) // len(ids)
        assert sum(r.length for r in parts) == copies * len(ids)
        for r in parts:
            assert r.crc == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return sum(r.length for r in rows) / (length * len(by_seq))


def test_packing(docs, odd, empty, texts):
    cut = packing.staged(packing.pieces(docs, WORDS, with_ids=True))
    packed = packing.staged(packing.pack(cut))
    assert check_packing(packed.collect(), list(texts.items()), 4096) > 0.95
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = np.array(whole[r.sequence_id][r.offset:r.offset + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.crc
    check_packing(packing.pack(packing.staged(packing.pieces(odd, WORDS, 64)), 64, 4).collect(), [(o[0], o[1] or "") for o in ODD], 64)
    assert packing.pack(packing.staged(packing.pieces(empty, WORDS))).count() == 0


def test_plan_covers_demand_with_few_sequences():
    r = random.Random(1)
    for room, top in ((48, 400), (20, 5000), (7, 3)):
        demand = {c: r.randrange(top) for c in range(1, room + 1)}
        plan = packing.plan(demand, room)
        got = Counter()
        used = Counter()
        for c, low, high, per, first in sorted(plan):
            assert low == got[c] and (high - low) % per == 0
            got[c] = high
            for s in range((high - low) // per):
                used[first + s] += c * per
        assert got == Counter({c: n for c, n in demand.items() if n}) and max(used.values(), default=0) <= room
        fractional = sum(x for x, _ in packing.column_generation(demand, room))
        least = max(sum(c * n for c, n in demand.items()) / room, sum(n for c, n in demand.items() if 2 * c > room))
        assert least <= fractional + 1e-6 and len(used) <= 1.001 * fractional + room


def check_shards(rows, shards):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_sharding(spark, docs, odd, empty, texts):
    rows = sharding.shard(docs).collect()
    check_shards(rows, 16)
    assert {(r.id, r.size, r.text_crc32) for r in rows} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    rows = sharding.shard(odd).collect()
    check_shards(rows, 16)
    assert len(rows) == len(ODD) and sharding.shard(empty).count() == 0


def test_sharding_gathers_groups_and_splits_a_hot_one(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 6}") for i in range(6000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    check_shards(out, 8)
    where = {}
    for r in out:
        where.setdefault(r.text_crc32, Counter())[r.shard] += 1
    hot = max(where.values(), key=lambda c: sum(c.values()))
    small = [c for c in where.values() if c is not hot]
    together = sum(max(c.values()) for c in small) / sum(sum(c.values()) for c in small)
    assert together > 0.6 and max(hot.values()) > 1.5 * 2000 / 8  # dealt at random, 1/8 of either stands together


def test_rounds_of_sharding_write_files_by_links(spark, monkeypatch):
    """A small table of a round is one file, not one per shuffle partition; more links make more files; no row is lost."""
    rows = [(i, "\n".join(f"a line long enough to be shared, number {(i * 7 + j * 13) % 90}" for j in range(4)) + str(i)) for i in range(120)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    linked, v = sharding.links(d), sharding.vertices(sharding._documents(d, "text", "doc_id"), 120 / 4, 4)
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in held}
    written, staged = [], sharding.staged
    monkeypatch.setattr(sharding, "staged", lambda df: written.append(staged(df)) or written[-1])
    try:
        for k, x in held.items():
            spark.conf.set(k, x)
        for links, most in ((1 << 17, 1), (linked.count() // 2, 3)):
            monkeypatch.setattr(sharding, "FILE_LINKS", links)
            written.clear()
            assert sharding.propagate(v, linked, 4, 120 / 4).count() == v.count()
            files = [len(t.inputFiles()) for t in written[1:]]  # the first is made before the rounds
            assert len(files) >= 2 and max(files) <= most and (most == 1 or max(files) > 1)
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


def test_a_round_of_sharding_writes_two_tables(spark, monkeypatch):
    line = lambda k: f"line {k} ".ljust(50, "x")
    docs = [(i, f"{line(i % 5)}\n{line(5 + i % 3)}\n{i}") for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    linked, v = sharding.links(d), sharding.vertices(sharding._documents(d, "text", "doc_id"), 300 / 4, 4)
    tables, rounds, staged, chances = [], [], sharding.staged, sharding._chances
    monkeypatch.setattr(sharding, "staged", lambda df: tables.append(1) or staged(df))
    monkeypatch.setattr(sharding, "_chances", lambda *a: rounds.append(1) or chances(*a))
    out = sharding.propagate(v, linked, 4, 300 / 4).select("g", "crc", "v", "n", "shard").collect()
    assert len(out) == 300 and len({(r.g, r.crc, r.v) for r in out}) == 300 and {r.shard for r in out} <= set(range(4))
    assert rounds and len(tables) <= 2 * len(rounds) + 3


def cut_share(out, texts):
    """Of all pairs of documents with equal texts, the share that lies in two shards."""
    groups = {}
    for r in out:
        groups.setdefault(texts[r.id], []).append(r.shard)
    pairs = lambda n: n * (n - 1) // 2
    every = sum(pairs(len(x)) for x in groups.values())
    return 1 - sum(pairs(n) for x in groups.values() for n in Counter(x).values()) / max(every, 1)


def test_equal_texts_stay_together(spark):
    """Where no group exceeds a shard: hardly a pair is cut. A group with a third of all rows fills three of eight shards."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    out = sharding.shard(docs).collect()
    check_shards(out, 16)
    assert cut_share(out, texts) <= 0.02
    sizes = [120, 110, 90] + [40] * 8 + [7] * 20  # all shards hold 125
    texts = dict(enumerate(f"text {k}" for k, n in enumerate(sizes) for _ in range(n)))
    texts |= {i: f"single {i}" for i in range(len(texts), 1000)}
    out = sharding.shard(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 8).collect()
    check_shards(out, 8)
    assert cut_share(out, texts) <= 0.02
    texts = {i: "hot" if i % 3 == 0 else f"text {i // 4}" for i in range(6000)}
    out = sharding.shard(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 8).collect()
    check_shards(out, 8)
    hot = Counter(r.shard for r in out if texts[r.id] == "hot")
    assert len(hot) <= 4 and cut_share([r for r in out if texts[r.id] != "hot"], texts) <= 0.02


def test_documents_that_share_lines_move_together(spark):
    """Families of different texts with lines in common: most end in one shard, where by chance an eighth would."""
    line = lambda k, i: f"a long enough line of family {k} with number {i} in it"
    texts = {k * 20 + m: "\n".join([line(k, i) for i in range(6) if (m + i) % 5] + [f"own line {k} {m} that nobody else has in his text"])
             for k in range(60) for m in range(20)}
    out = sharding.shard(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 8).collect()
    check_shards(out, 8)
    shard = {r.id: r.shard for r in out}
    together = sum(max(Counter(shard[k * 20 + m] for m in range(20)).values()) for k in range(60))
    assert together > 0.6 * len(texts)


@pytest.mark.parametrize("least,most", [(3, 3), (40, 40), (3, 42), (100, 600)])
def test_short_pieces_leave_little_padding(spark, least, most):
    from pyspark.sql import functions as F

    n = (F.col("id") * 2654435761 % (most - least + 1) + least).cast("bigint")
    cut = spark.range(0, 200_000 if most < 50 else 40_000).select(
        "id", F.lit(0).cast("bigint").alias("start"), n.alias("length"), F.lit(0).cast("bigint").alias("crc"), n.alias("doc_tokens"))
    packed = packing.staged(packing.pack(packing.staged(cut)))
    each = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("low"), F.max(F.col("offset") + F.col("length")).alias("high"),
                                             F.count_distinct("offset").alias("places"), F.count("*").alias("pieces")).collect()
    assert all(r.n == r.high <= 4096 and r.low == 0 and r.places == r.pieces for r in each)  # gapless, no two at one place
    assert sorted(r.sequence_id for r in each) == list(range(len(each)))
    assert sum(r.n for r in each) == cut.agg(F.sum("length")).first()[0] and sum(r.n for r in each) >= 0.95 * 4096 * len(each)
    print(least, most, sum(r.n for r in each) / 4096 / len(each))
