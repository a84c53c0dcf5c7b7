"""Shards of equal row counts by balanced label propagation over documents that share texts or lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import staged, text_of

#: Into how many parts a text is dealt that fits into no shard; texts with more than 1 / LARGE of a shard, of which there are at most
#: LARGE times the shards, are placed before all others.
SALTS, LARGE = 256, 16
#: Pieces per shard in which rows are numbered.
PIECES = 256
#: Least characters of a line that links the documents which have it.
LINE_CHARS = 40
#: Share of the vertices that may follow their neighbours in one round, so that two don't change places for ever.
SHARE = 0.6
#: Part of a shard by which it may be too full while vertices move; least share by which a round must lower the cut, and rounds
#: without such a gain after which they stop.
SLACK, GAIN, PATIENCE = 0.05, 0.005, 2
#: Links per file of the tables that every round writes: small rounds don't write a file per shuffle partition.
FILE_LINKS = 1 << 17


def _documents(docs: DataFrame, text: str, identifier: str) -> DataFrame:
    t = docs.select(docs[identifier].alias("id"), text_of(docs, text).alias("t"))
    return t.select("id", (F.octet_length("t").cast("bigint") + 1).alias("size"), F.crc32(F.col("t").cast("binary")).alias("crc"),
                    F.xxhash64("t").alias("g"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))


def _first_shard(room: dict) -> Column:
    """By hash, in proportion to the room that large texts have left."""
    left = [max(0.0, room[s]) for s in sorted(room)]
    upto = [sum(left[:s + 1]) / (sum(left) or 1.0) for s in range(len(left) - 1)]
    place = F.pmod(F.xxhash64("g", "crc", "v"), F.lit(1_000_003)) / 1_000_003
    return F.size(F.filter(F.array(*[F.lit(u) for u in upto]), lambda u: u <= place)) if upto else F.lit(0)


def placed_first(parts: dict, quota: float, shards: int) -> tuple[list[tuple], dict]:
    """(g, crc, v, n, shard) of the large texts, and the room they leave in each shard, given the rows of their parts: the largest first, each into the shard with most
    room, as a whole if it fits there; else its parts fill one shard after the other."""
    room, out = {s: quota for s in range(shards)}, []
    for (g, crc), of in sorted(parts.items(), key=lambda x: (-sum(x[1].values()), x[0])):
        total, s = sum(of.values()), max(room, key=lambda s: (room[s], -s))
        if total <= room[s]:
            out.append((g, crc, -1, total, s))
            room[s] -= total
            continue
        for v, n in sorted(of.items()):
            if room[s] < n:
                s = max(room, key=lambda s: (room[s], -s))
            out.append((g, crc, v, n, s))
            room[s] -= n
    return out, room


def vertices(d: DataFrame, quota: float, shards: int) -> DataFrame:
    """(g, crc, v, n, shard, fixed): a vertex per text, or several for a text that fits into no shard. Large texts have their place."""
    parts = staged(d.groupBy("g", "crc", "salt").agg(F.count("*").alias("n")))
    texts = staged(parts.groupBy("g", "crc").agg(F.sum("n").alias("total")))
    large = texts.where(F.col("total") > quota / LARGE).select(F.col("g").alias("t_g"), F.col("crc").alias("t_crc"))
    of = {}
    for r in parts.join(large, (F.col("g") == F.col("t_g")) & (F.col("crc") == F.col("t_crc"))).collect():  # at most LARGE * shards * SALTS
        of.setdefault((r.g, r.crc), {})[r.salt] = r.n
    first, room = placed_first(of, quota, shards)
    first = d.sparkSession.createDataFrame(first, "g long, crc long, v int, n long, shard int")
    rest = texts.where(F.col("total") <= quota / LARGE).select("g", "crc", F.lit(-1).alias("v"), F.col("total").alias("n"))
    return staged(rest.withColumn("shard", _first_shard(room).cast("int")).withColumn("fixed", F.lit(False)).unionByName(
        first.withColumn("fixed", F.lit(True))))


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """(g, crc, hub, weight): documents with equal lines are neighbours, and meet at the line as a hub.

    A line counts for less the more texts have it. Lines of one text only link nothing and are left out.
    """
    t = docs.select(text_of(docs, text).alias("t"))
    t = t.select(F.xxhash64("t").alias("g"), F.crc32(F.col("t").cast("binary")).alias("crc"), F.explode(F.array_distinct(F.transform(
        F.filter(F.split("t", "\n"), lambda x: F.length(x) >= LINE_CHARS), lambda x: F.xxhash64(x)))).alias("hub"))
    t = staged(t.distinct())
    shared = staged(t.groupBy(F.col("hub").alias("s_hub")).agg(F.count("*").alias("texts")).where("texts > 1"))
    return staged(t.join(shared, F.col("hub") == F.col("s_hub")).select("g", "crc", "hub", (1.0 / F.col("texts")).alias("weight")))


def _chances(flow: dict, load: dict, quota: float) -> list[tuple[int, int, float]]:
    """For each pair of shards, the share of the rows that want to move which may: swaps, and room below the quota."""
    out = []
    for (s, t), want in sorted(flow.items()):
        into = sum(n for (_, x), n in flow.items() if x == t)
        room = max(0.0, quota - load.get(t, 0)) * want / into
        out.append((s, t, min(SHARE, (min(want, flow.get((t, s), 0)) + room) / want)))
    return out


def propagate(v: DataFrame, linked: DataFrame, shards: int, quota: float) -> DataFrame:
    """The vertices that have links, with the shard that propagation gives them.

    In each round every hub takes the label that most of its rows have, and a vertex that isn't fixed asks for the label
    with most weight among its hubs. Flows between shards, a table of shards squared, tell how many may go: as many as
    come back, and what the target has room for; a hash of vertex and round picks them. Rounds end when nobody asks, or
    when the weight of links that lead to another shard no longer falls by ``GAIN``; the best round counts.
    A vertex carries its links, so that hubs and votes are one shuffle each; sums are kept per shard, in columns. The tables
    of a round have as many files as the number of links asks for.
    """
    key, every, files = ["g", "crc", "v"], range(shards), 1 + linked.count() // FILE_LINKS
    lists = linked.groupBy(F.col("g").alias("l_g"), F.col("crc").alias("l_crc")).agg(F.collect_list(F.struct("hub", "weight")).alias("links"))
    moving = staged(v.join(lists, (F.col("g") == F.col("l_g")) & (F.col("crc") == F.col("l_crc"))).select(*v.columns, "links"))
    still = {r.shard: r.n for r in v.where("fixed").groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row per shard
    least, kept, rounds, tired = None, moving, 0, 0
    while True:
        here = moving.select(*key, "n", "shard", F.explode("links").alias("l")).select(*key, "n", "shard", "l.hub", "l.weight")
        in_shard = here.groupBy("hub").agg(*[F.sum(F.when(F.col("shard") == s, F.col("n")).otherwise(0)).alias(f"w{s}") for s in every])
        # tables on both sides of the next join: a line that very many texts have is split there
        at = staged(in_shard.select(F.col("hub").alias("b_hub"), F.array_max(F.array(*[
            F.struct(F.col(f"w{s}").alias("w"), F.xxhash64("hub", F.lit(s)).alias("h"), F.lit(s).alias("s")) for s in every]))["s"].alias("label")).coalesce(files))
        votes = here.join(at, F.col("hub") == F.col("b_hub")).groupBy(*[F.col(c).alias(f"v_{c}") for c in key]).agg(
            *[F.sum(F.when(F.col("label") == s, F.col("weight")).otherwise(0.0)).alias(f"w{s}") for s in every])
        best = F.array_max(F.array(*[F.struct(F.col(f"w{s}").alias("w"), (F.col("shard") == s).alias("stays"), F.xxhash64("g", F.lit(s)).alias("h"),
                                              F.lit(s).alias("s")) for s in every]))["s"]
        away = sum((F.when(F.col("shard") != s, F.col(f"w{s}")).otherwise(0.0) for s in every), F.lit(0.0))
        asked = staged(moving.join(votes, [F.col(c) == F.col(f"v_{c}") for c in key]).select(
            *v.columns, "links", best.alias("best"), away.alias("away")).coalesce(files))
        cut, load, flow = 0.0, dict(still), {}
        for r in asked.groupBy("shard", "best", "fixed").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("away")).alias("cut")).collect():
            cut += r.cut  # at most 2 * shards squared rows
            if not r.fixed:
                load[r.shard] = load.get(r.shard, 0) + r.n
                if r.shard != r.best:
                    flow[r.shard, r.best] = r.n
        if least is None or cut < least * (1 - GAIN):
            least, kept, tired = cut, moving, 0
        else:
            tired += 1
            if tired == PATIENCE:
                return kept
        if not flow:
            return kept
        chances = {(s, t): c for s, t, c in _chances(flow, load, quota * (1 + SLACK))}
        chance = F.expr(f"array({', '.join(f'{float(chances.get((s, t), 0))!r}D' for s in every for t in every)})")
        lot = F.pmod(F.xxhash64("g", "crc", "v", F.lit(rounds)), F.lit(1_000_000)) / 1_000_000
        goes = ~F.col("fixed") & (lot < F.get(chance, F.col("shard") * shards + F.col("best")))
        moving = asked.select("g", "crc", "v", "n", F.when(goes, F.col("best")).otherwise(F.col("shard")).cast("int").alias("shard"), "fixed", "links")
        rounds += 1


def shard(docs: DataFrame, shards: int = 16, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard`` and ``slot`` of every row; counts differ by one at most.

    Equal texts are one group, told by 96 bits of hash, and a group starts in one shard; documents that share lines move towards
    each other. Only a group that fits into no shard is dealt into 256 parts by its ids, so one with a third
    of all rows fills a few shards and no more. Where counts are evened, texts without a copy leave first. NULL text is empty (size
    1, in a group with empty texts); rows may repeat, ids may be NULL; each row gets its own slot. An empty table gives
    an empty one.
    """
    d = staged(_documents(docs, text, identifier))
    rows = d.count()
    v = vertices(d, rows / shards, shards)
    moved = propagate(v, links(docs, text), shards, rows / shards)
    m = moved.select(F.col("g").alias("m_g"), F.col("crc").alias("m_crc"), F.col("v").alias("m_v"), F.col("shard").alias("m_shard"))
    v = v.join(m, (F.col("g") == F.col("m_g")) & (F.col("crc") == F.col("m_crc")) & (F.col("v") == F.col("m_v")), "left").select(
        F.col("g").alias("v_g"), F.col("crc").alias("v_crc"), "v", F.coalesce("m_shard", "shard").cast("int").alias("s"), (F.col("n") > 1).alias("copies"),
        "fixed")
    v = staged(v)
    at = d.join(v, (F.col("g") == F.col("v_g")) & (F.col("crc") == F.col("v_crc")) & ((F.col("v") == -1) | (F.col("v") == F.col("salt"))))
    # large texts first, their rows in many pieces; then texts with copies, each in one piece; single texts last
    hashed = F.pmod(F.xxhash64("g", "crc", "v"), F.lit(PIECES))
    piece = F.when(F.col("fixed"), F.pmod("salt", F.lit(PIECES))).when(F.col("copies"), hashed + PIECES).otherwise(hashed + 2 * PIECES)
    at = staged(at.select("id", "size", "crc", "g", "salt", "s", piece.cast("int").alias("piece")))
    counts = at.groupBy("s", "piece").agg(F.count("*").alias("n")).collect()  # at most shards * 3 * PIECES rows
    total, before = dict.fromkeys(range(shards), 0), []
    for s, piece, n in sorted(counts):
        before.append((s, piece, total[s]))
        total[s] += n
    offsets = at.sparkSession.createDataFrame(before, "o_s int, o_piece int, before long")
    ranked = at.withColumn("r", F.expr("row_number() over (partition by s, piece order by g, crc, salt, id, size)") - 1)
    ranked = ranked.join(F.broadcast(offsets), (F.col("s") == F.col("o_s")) & (F.col("piece") == F.col("o_piece"))).select(
        "id", "size", "crc", "s", (F.col("r") + F.col("before")).alias("r"))
    fullest = sorted(total, key=lambda s: (-total[s], s))
    quota = {s: rows // shards + (i < rows % shards) for i, s in enumerate(fullest)}
    return ranked.select("id", "size", F.col("crc").alias("text_crc32"), *_even(total, quota))


def _even(total: dict, quota: dict) -> list[Column]:
    """Shard and slot: the first ``quota`` rows of a shard stay, the others fill the shards with fewer, in order."""
    base, starts, targets, slots, over = [], [], [], [], 0
    for s in sorted(total):
        base.append(over - quota[s])
        over += max(0, total[s] - quota[s])
    place = 0
    for t in sorted(total):
        if total[t] < quota[t]:
            starts, targets, slots = starts + [place], targets + [t], slots + [total[t] - place]
            place += quota[t] - total[t]
    of = lambda values, kind: F.array(*[F.lit(x).cast(kind) for x in values or [0]])
    keeps = F.col("r") < of([quota[s] for s in sorted(total)], "bigint")[F.col("s")]
    moved = F.col("r") + of(base, "bigint")[F.col("s")]
    into = F.size(F.filter(of(starts, "bigint"), lambda x: x <= moved)) - 1
    return [F.when(keeps, F.col("s")).otherwise(F.get(of(targets, "int"), into)).cast("int").alias("shard"),
            F.when(keeps, F.col("r")).otherwise(moved + F.get(of(slots, "bigint"), into)).cast("bigint").alias("slot")]
