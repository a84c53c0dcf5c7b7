"""The trie of conversation prefixes, with totals of every subtree."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import small, staged
from pulsegrid.llm.contraction import subtree_totals

#: Turns of a conversation that are put in order by one task, and ids that are joined to one text.
BLOCK, IDS = 1024, 4096
#: Conversations that share the opening of the first of them, and the bound of its length.
FAMILY, OPENING = 5, 9


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """``c``, ``a`` and ``b`` (two hashes of role and text), ``bytes`` and ``part``, ``idx``: the place in the global order.

    Rows are ordered by conversation, turn (NULL first) and the hashes in ranges, so that a conversation with a third of all
    turns is many tasks; equal rows are spread by where they were read. Texts stay behind.
    """
    c = conversations
    r, t = (F.coalesce(c[x].cast("string"), F.lit("")) for x in (role, text))
    rows = c.where(c[conv].isNotNull()).select(
        c[conv].cast("bigint").alias("c"), c[turn].alias("turn"), F.xxhash64(r, t).alias("a"), F.xxhash64(t, F.lit("turn"), r).alias("b"),
        F.octet_length(t).cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("s"))
    order = ["c", "turn", "a", "b", "s"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return staged(placed.select("c", "a", "b", "bytes", F.shiftright("at", 33).alias("part"),
                                F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("idx")))


def own_turns(placed: DataFrame) -> DataFrame:
    """``c, i, a, b, bytes`` (position from 0) and ``n``, the number of turns, of every row."""
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row per range
    before = staged(sizes.select(F.col("part").alias("p_part"), F.expr("sum(n) over (order by part) - n").alias("before")))
    ranked = placed.join(small(before), F.col("part") == F.col("p_part")).select(
        "c", "a", "b", "bytes", (F.col("before") + F.col("idx")).alias("rank"))
    ranked = staged(ranked)
    whole = staged(ranked.groupBy(F.col("c").alias("w_c")).agg(F.min("rank").alias("first"), F.count("*").alias("n")))
    return staged(ranked.join(whole, F.col("c") == F.col("w_c")).select(
        "c", (F.col("rank") - F.col("first")).alias("i"), "a", "b", "bytes", "n"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``c, i, a, b, bytes, n`` of the rebuilt conversations, ``c`` and ``n`` of all of them, also of those without a turn).

    Conversation c starts with the first h turns of c - c % 5, all if there are fewer, and goes on with its own after the
    first h; h is the CRC-32 of its decimal number modulo 9. At most 8 turns go to at most 5 conversations.
    """
    first = turns.where("i = 0").select("c", "n")
    open_ = F.crc32(F.col("c").cast("string").cast("binary")) % OPENING
    convs = first.select("c", "n", (F.col("c") - F.col("c") % FAMILY).alias("source"), open_.alias("h"))
    sources = first.select(F.col("c").alias("s_c"), F.col("n").alias("s_n"))
    convs = staged(convs.join(sources, F.col("source") == F.col("s_c"), "left").select(
        F.col("c").alias("k_c"), "source", "h", F.least("h", F.coalesce("s_n", F.lit(0))).alias("taken"),
        (F.least("h", F.coalesce("s_n", F.lit(0))) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")))
    own = turns.join(convs, F.col("c") == F.col("k_c")).where("i >= h").select(
        "c", (F.col("i") - F.col("h") + F.col("taken")).alias("i"), "a", "b", "bytes", F.col("total").alias("n"))
    heads = turns.where(F.col("i") < OPENING).join(convs, F.col("c") == F.col("source")).where("i < taken").select(
        F.col("k_c").alias("c"), "i", "a", "b", "bytes", F.col("total").alias("n"))
    return staged(own.unionByName(heads)), convs.select(F.col("k_c").alias("c"), F.col("total").alias("n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds ``x, y``, 128 bits that name the turns up to this one with their order, and ``px, py`` of those before it.

    Each turn adds its hash with its position by exclusive or; blocks of a conversation are ordered apart and meet
    through a table with one row per block.
    """
    rows = turns.withColumns({"hx": F.xxhash64("i", "a", "b"), "hy": F.xxhash64("b", "i", "a"),
                              "block": F.floor(F.col("i") / BLOCK)})
    rows = staged(rows)
    totals = rows.groupBy("c", "block").agg(F.bit_xor("hx").alias("tx"), F.bit_xor("hy").alias("ty"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("c").alias("t_c"), F.col("block").alias("t_block"),
                           *[F.coalesce(F.bit_xor(t).over(earlier), F.lit(0)).alias(t) for t in ("tx", "ty")])
    here = Window.partitionBy("c", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", F.bit_xor("hx").over(here).alias("lx"), F.bit_xor("hy").over(here).alias("ly"))
    j = local.join(totals, (F.col("c") == F.col("t_c")) & (F.col("block") == F.col("t_block")))
    j = j.select("c", "i", "n", "bytes", "hx", "hy", F.col("lx").bitwiseXOR(F.col("tx")).alias("x"),
                 F.col("ly").bitwiseXOR(F.col("ty")).alias("y"))
    return j.select("c", (F.col("i") + 1).alias("depth"), "n", "bytes", "x", "y",
                    F.col("x").bitwiseXOR(F.col("hx")).alias("px"), F.col("y").bitwiseXOR(F.col("hy")).alias("py"))


def digest_of_ids(ends: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and ``sha``: the SHA-256 of the ids ``c`` of each key, ascending, as decimal numbers joined by commas.

    Ids are sorted in ranges and joined to texts of at most 4096 ids where they lie; one reader per key takes these
    texts in order and holds one of them.
    """
    order = [*key, "c"]
    at = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ids = F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",")
    texts = at.groupBy(*key, F.floor(F.col("at") / IDS).alias("chunk")).agg(F.min("c").alias("first"), ids.alias("ids"))
    texts = texts.select(*key, "first", "ids").repartition(*key).sortWithinPartitions(*key, "first")

    def run(batches):
        import pyarrow as pa

        now, sha = None, None
        for whole in batches:
            done = []
            for r in whole.to_pylist():
                k = tuple(r[c] for c in key)
                if k != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(r["ids"].encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done)], [*key, "sha"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, sha.hexdigest())], [*key, "sha"])

    return texts.mapInArrow(run, ", ".join(f"{k} bigint" for k in key) + ", sha string")


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` and
    ``saved_tokens`` of the subtree, ``ends_sha256`` of the members that end there.

    NULL role and text are empty. Rows with a NULL conversation belong to none. Turns of equal number are ordered by a hash
    of role and text; repeated rows are turns of their own. Prefixes are told apart by their depth and 128 bits of hash.
    Other columns, whatever their names, are not read. A table without conversations gives one without nodes.
    """
    turns, convs = rebuilt(own_turns(numbered(conversations, conv, turn, role, text)))
    steps = staged(prefixes(turns))
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id", "n_convs", zero.alias("saved"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("px", "py")])
    below = steps.groupBy("depth", "x", "y").agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("px").alias("px"),
        F.max("py").alias("py")).select("depth", "x", "y", "conv_id", "n_convs",
                                        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), "px", "py")
    nodes = staged(below.unionByName(root).withColumn("id", F.monotonically_increasing_id()))
    above = nodes.select((F.col("depth") + 1).alias("a_depth"), F.col("x").alias("a_x"), F.col("y").alias("a_y"),
                         F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = staged(nodes.join(above, (F.col("depth") == F.col("a_depth")) & (F.col("px") == F.col("a_x"))
                               & (F.col("py") == F.col("a_y")), "left").drop("a_depth", "a_x", "a_y", "px", "py"))
    kids = linked.where("parent is not null").groupBy(F.col("parent").alias("k_id")).agg(F.count("*").alias("kids"))
    linked = staged(linked.join(kids, F.col("id") == F.col("k_id"), "left").select(
        *linked.columns, F.coalesce("kids", zero).alias("n_children")))
    totals = subtree_totals(linked.select("id", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")
                                          .alias("n_leaves"), F.col("saved").alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    last = steps.where("depth = n").select("depth", "x", "y", "c").unionByName(
        convs.where("n = 0").select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "c"))
    ends = staged(digest_of_ids(last, ["depth", "x", "y"])).select(
        F.col("depth").alias("e_depth"), F.col("x").alias("e_x"), F.col("y").alias("e_y"), "sha")
    out = linked.join(totals.withColumnRenamed("id", "t_id"), F.col("id") == F.col("t_id"))
    out = out.join(ends, (F.col("depth") == F.col("e_depth")) & (F.col("x") == F.col("e_x")) & (F.col("y") == F.col("e_y")), "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
