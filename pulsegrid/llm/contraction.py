"""Sums over all subtrees of a forest by parallel tree contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import staged


def _rake(live: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(all nodes with ``leaf``, inner nodes with what their leaves handed up, ``branches`` left and one of them as ``only``)."""
    parents = live.where("parent is not null").groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("kids"))
    marked = staged(live.join(parents, live.id == parents.p, "left").select(*live.columns, F.col("p").isNull().alias("leaf")))
    handed = [F.sum(F.when(F.col("leaf"), F.col(v) + F.col(f"e_{v}")).otherwise(0)).alias(f"up_{v}") for v in values]
    up = marked.where("parent is not null").groupBy(F.col("parent").alias("p")).agg(
        *handed, F.count(F.when(~F.col("leaf"), 1)).alias("branches"), F.min(F.when(~F.col("leaf"), F.col("id"))).alias("only"))
    inner = marked.where(~F.col("leaf")).join(up, F.col("id") == F.col("p")).select(
        "id", "parent", *[(F.col(v) + F.col(f"up_{v}")).alias(v) for v in values], *[f"e_{v}" for v in values], "branches", "only")
    return marked, staged(inner)


def _compress(inner: DataFrame, values: list[str], turn: int) -> DataFrame:
    """Inner nodes that stay, hung below the parent of a chain node that went; ``gone`` names it and ``g_*`` what it adds.

    A node with one branch and a parent is a link of a chain. Of neighbouring links the one of higher rank may go; the
    ranks change from round to round, so about a third of every chain goes in each.
    """
    link = inner.where("branches = 1 and parent is not null").select(
        "id", "only", F.struct(F.xxhash64("id", F.lit(turn)), "id").alias("rank"))
    below = link.select(F.col("id").alias("b_id"), F.col("rank").alias("b_rank"))
    lower = link.join(below, link.only == below.b_id).select(
        F.when(F.col("rank") < F.col("b_rank"), F.col("id")).otherwise(F.col("b_id")).alias("l_id")).distinct()
    flagged = staged(inner.join(lower, inner.id == lower.l_id, "left").select(*inner.columns, (
        (F.col("branches") == 1) & F.col("parent").isNotNull() & F.col("l_id").isNull()).alias("goes")))
    goes = flagged.where("goes").select(F.col("id").alias("gone"), F.col("parent").alias("g_parent"), F.col("only").alias("heir"),
                                        *[F.col(v).alias(f"g_{v}") for v in values], *[F.col(f"e_{v}").alias(f"ge_{v}") for v in values])
    stays = flagged.where("not goes").join(goes, F.col("id") == F.col("heir"), "left")
    # the gone node's own total is that of its heir, with what the heir hands up on the way and the gone node's own value
    return staged(stays.select(
        "id", F.coalesce("g_parent", "parent").alias("parent"), *values, "gone",
        *[(F.col(f"e_{v}") + F.col(f"g_{v}")).alias(f"g_{v}") for v in values],
        *[(F.col(f"e_{v}") + F.coalesce(F.col(f"g_{v}") + F.col(f"ge_{v}"), F.lit(0))).alias(f"e_{v}") for v in values]))


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and, for each of ``values``, its sum over the node and everything below it.

    ``tree`` has ``id`` (unique), ``parent`` (NULL for a root) and BIGINT values without NULL. Rounds alternate a rake,
    which takes all leaves off and adds them to their parents, and a compress, which takes links out of unary chains;
    both shrink the forest by a share of its nodes, so rounds grow with the logarithm of their number, for long
    chains and for wide trees. Rounds are then taken back in reverse: a link's total follows from that of the node that
    took its place. Every round is a staged table, and a parent with very many children gets partial sums. A table
    without nodes gives one without rows; parents that don't exist hang nothing; a cycle is an error.
    """
    known = tree.select(F.col("id").alias("k_id"))
    live = staged(tree.join(known, tree.parent == known.k_id, "left").select(
        "id", F.col("k_id").alias("parent"), *values, *[F.lit(0).cast("bigint").alias(f"e_{v}") for v in values]))
    rounds = []
    while not live.isEmpty():
        marked, inner = _rake(live, values)
        leaves = marked.where("leaf").select("id", *values)
        if leaves.isEmpty():
            raise ValueError("parents form a cycle")
        after = _compress(inner, values, len(rounds))
        rounds.append((leaves, after.where("gone is not null").select(
            "gone", F.col("id").alias("heir"), *[f"g_{v}" for v in values])))
        live = after.select("id", "parent", *values, *[f"e_{v}" for v in values])
    totals = tree.select("id", *values).limit(0)
    for leaves, gone in reversed(rounds):
        regrown = gone.join(totals, gone.heir == totals.id).select(
            F.col("gone").alias("id"), *[(F.col(v) + F.col(f"g_{v}")).alias(v) for v in values])
        totals = staged(totals.unionByName(leaves).unionByName(regrown))
    return totals
