"""Connected components of a links table by alternating star contraction; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import BROADCAST_ROWS, staged

#: Where minima are shuffled to the links, the links of a node are dealt to so many tasks, and its minimum to all of them.
SALT = 8
#: A round's links are written by a task for so many of them, by FEW tasks at least: the number of files goes by the number of links, not by the shuffle's partitions.
LINKS_A_FILE, FEW = 50_000, 8


def with_minimum(links: DataFrame, minima: DataFrame, n_links: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """links(u, v) with m of minima(u, m); minima, at most 2 * n_links rows, are broadcast while these are few, else shuffled, a node's links in SALT parts."""
    if 2 * n_links <= most:
        return links.join(F.broadcast(minima), "u")
    copies = minima.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALT)).cast("int")).join(copies, ["u", "salt"]).drop("salt")


def counted(edges: DataFrame) -> tuple:
    """How many links there are, and the sum of their hashes: equal if a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest node that it is linked to, by any path) for every node of links other than roots.

    Links with a null or equal ends are ignored; repeated links count once. Only linked nodes are ever moved, minima are
    taken with partial aggregation, and no hub's links meet in one task.
    """
    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    before = counted(edges)
    n_links = before[0]
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = with_minimum(both.where("v > u"), least, n_links).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = with_minimum(down, lowest, n_links).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(lowest.select("u", F.col("m").alias("v")))
        edges = staged(small.distinct().coalesce(max(FEW, n_links // LINKS_A_FILE)), "links")
        now = counted(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, n_links = now, now[0]
    raise RuntimeError(f"links did not settle in {most_rounds} rounds")
