"""Everything that supports an item: ancestor closure over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.staging import staged


def reach(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(item, next, depth)``: all items reached from each item along ``(src, dst)``, shortest depth; cycles end.

    Each round joins the reached pairs with themselves, which doubles the depth they cover, and is written to the
    shared folder; the rounds are the logarithm of the longest chain. Both sides of a join are staged tables, so an
    item that very many others reach is split at run time. Only two sums per round come to the driver.
    """
    pairs = staged(edges.select(F.col("src").alias("item"), F.col("dst").alias("next"), F.lit(1).cast("bigint").alias("depth"))
                   .where("item <> next").distinct())
    size = lambda df: tuple(df.agg(F.count("*"), F.sum("depth")).first())
    last, now = None, size(pairs)
    while last != now:
        on = pairs.select(F.col("item").alias("from"), F.col("next").alias("to"), F.col("depth").alias("more"))
        longer = pairs.join(on, pairs["next"] == on["from"]).select("item", F.col("to").alias("next"), (F.col("depth") + F.col("more")).alias("depth"))
        if max_depth is not None:
            longer = longer.where(F.col("depth") <= max_depth)
        pairs = staged(pairs.unionByName(longer.where("item <> next")).groupBy("item", "next").agg(F.min("depth").alias("depth")))
        last, now = now, size(pairs)
    return pairs


#: Rounds after which the pairs found so far are written to one table.
MERGE = 16


def supports(edges: DataFrame, starts: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(start, item, depth)``: all items reached from each start by the shortest way, or those within ``max_depth`` steps if given.

    A frontier moves on from the starts, one step a round, and leaves out what it has visited, so what is read and written
    is in proportion to what the starts reach; nothing else of the graph is closed. Rounds are as many as the longest shortest
    way. Frontiers are staged, so an item that very many starts reach, or with very many edges, is split at run time.
    A start doesn't support itself; NULL items have no edges.

    Beside the pairs go the items that a round has reached, and the edges that leave them: the next round reads those edges only,
    and looks through visited pairs only for items that an earlier round has reached, too.
    """
    steps = staged(edges.select(F.col("src").alias("s_src"), F.col("dst").alias("next")).where("s_src <> next"))
    frontier = staged(starts.select("start", F.col("start").alias("item"), F.lit(0).cast("bigint").alias("depth")).where("start is not null").distinct())
    visited, used, seen, depth = frontier, steps, None, 0
    while (max_depth is None or depth < max_depth) and not frontier.isEmpty():
        if depth:  # edges may repeat, but the first round reads each once; from here on many starts share them
            level = staged(frontier.select(F.col("item").alias("i")).distinct())
            used = staged(steps.join(level, F.col("s_src") == F.col("i"), "left_semi").distinct())
            seen = level if seen is None else staged(seen.unionByName(level).distinct())
        depth += 1
        ahead = frontier.join(used, frontier["item"] == used["s_src"]).select("start", F.col("next").alias("item")).where("start <> item").distinct()
        if seen is not None:
            again = staged(seen.join(used.select("next"), F.col("i") == F.col("next"), "left_semi"))
            if not again.isEmpty():
                before = visited.select("start", "item").join(again, F.col("item") == F.col("i"), "left_semi")
                ahead = ahead.join(before, ["start", "item"], "left_anti")
        frontier = staged(ahead.withColumn("depth", F.lit(depth).cast("bigint")))
        visited = visited.unionByName(frontier)
        if depth % MERGE == 0:
            visited = staged(visited)
    return visited.where("depth > 0")
