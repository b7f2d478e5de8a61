"""Selections whose result depends on an order, as rounds of joins; each round is written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or one of our own where that is unset (as in tests)."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="groundwork-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: what is used more than once is made once."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of one block that a task passes through in order.
BLOCK = 20_000
#: A selection of at most so many nodes is broadcast to their links; beyond that the same joins shuffle.
SMALL = 500_000


def _block_pass(nodes: DataFrame, links: DataFrame, blocks: int) -> DataFrame:
    """seq and kept (false: absent) of the nodes(block, seq, key, set, waits, needs) that are decided whatever earlier blocks keep, but for dropped ones; links(block, s1, s2) lie within a block.

    A task passes through a block in seq order. A node with a kept neighbour is dropped, one that waits for an earlier block, or has a neighbour that does, waits, and the others are
    kept. A node that needs another one, of the same block, to be dropped is absent if that one is kept, and waits while it does.
    """
    none = F.lit(None).cast("long")
    told = links.select("block", F.lit(-1).cast("long").alias("seq"), F.col("s1").alias("key"), F.col("s2").alias("set"), F.lit(False).alias("waits"), none.alias("needs")).union(nodes.select("block", "seq", "key", "set", "waits", "needs"))

    def run(batches):
        block, near, kept, waiting = None, {}, set(), set()
        for batch in batches:
            out = []
            for b, seq, key, own, waits, needs in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if b != block:
                    block, near, kept, waiting = b, {}, set(), set()
                if seq < 0:  # a link: these come first
                    near.setdefault(key, []).append(own)
                    continue
                if needs in kept:
                    out.append((seq, False))
                    continue
                met = [(key,), *(() if own is None else (own, *near.get(own, ())))]
                if not kept.isdisjoint(met) and needs not in waiting:
                    continue
                mine = waiting if waits or needs in waiting or not waiting.isdisjoint(met) else kept
                mine.update((seq, (key,)))
                if own is not None:
                    mine.add(own)
                if mine is kept:
                    out.append((seq, True))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.bool_())], names=["seq", "kept"])

    return told.repartition(blocks, "block").sortWithinPartitions("block", "seq").mapInArrow(run, "seq long, kept boolean")


def first_fit(nodes: DataFrame, near: DataFrame, block: int = BLOCK) -> DataFrame:
    """seq (0 or more, distinct) of the nodes(seq, key, set) that a pass in seq order drops.

    A node is dropped if an earlier kept node has its key or its set, or a set that near(s1, s2; both directions) links with its set; otherwise it is kept and
    knocks out others. Null sets are linked with nothing. Links are between sets, so no pairs of nodes are ever made. Nodes may have needs, the seq of an earlier node: they exist only if
    that one is dropped, else they neither are dropped nor knock out.

    The nodes are cut into blocks of consecutive ones, of at most about `block`. In each round the tasks pass through all blocks at once; what depends on an earlier
    block waits for the next round. The first live block is always decided, so there are at most as many rounds as blocks, and a chain of links within a
    block takes one; no task ever holds more than a block.
    """
    n = nodes.count()
    blocks = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // block))
    conditional = "needs" in nodes.columns
    told = nodes.select(F.col("seq").cast("long").alias("seq"), "key", "set", (F.col("needs") if conditional else F.lit(None)).cast("long").alias("needs"))
    live = cut(told.withColumn("together", F.coalesce("needs", "seq")).repartitionByRange(blocks, "together").select("seq", "key", "set", "needs", F.lit(False).alias("lost"), F.spark_partition_id().alias("block")))
    links = written(near.select("s1", "s2").where("s1 <> s2"), "links")  # as Parquet, which packs numbers that recur; rows twice do no harm
    small = F.broadcast if n <= SMALL else lambda df: df
    dropped = live.select("seq").limit(0)
    while live.take(1):
        open_ = live.where("NOT lost")  # what has a kept neighbour but may be absent touches nothing more
        by_key = open_.groupBy("key").agg(F.min("block").alias("key_block"))
        by_set = open_.where("set IS NOT NULL").groupBy("set").agg(F.min("block").alias("set_block"))
        by_link = links.join(small(by_set.withColumnRenamed("set", "s1")), "s1").groupBy(F.col("s2").alias("set")).agg(F.min("set_block").alias("near_block"))
        first = F.least("key_block", "set_block", "near_block")
        placed = open_.join(by_key, "key", "left").join(by_set, "set", "left").join(by_link, "set", "left")
        held = open_.where("set IS NOT NULL").select("block", "set").distinct()
        inside = links.join(small(held.withColumnRenamed("set", "s1")), "s1").join(small(held.withColumnRenamed("set", "s2")), ["block", "s2"])
        decided = cut(_block_pass(placed.select("block", "seq", "key", "set", (first < F.col("block")).alias("waits"), "needs"), inside, blocks))
        kept = cut(live.join(decided.where("kept").select("seq"), "seq", "left_semi").select("seq", "key", "set"))
        hit_keys = kept.select("key", F.col("seq").alias("kept_key"))
        own = kept.where("set IS NOT NULL").select("set", "seq")
        reached = links.join(small(own.select(F.col("set").alias("s1"), "seq")), "s1").select(F.col("s2").alias("set"), "seq").union(own)
        hit_sets = reached.groupBy("set").agg(F.min("seq").alias("kept_set"))
        hit = F.col("lost") | F.coalesce(F.col("kept_key") < F.col("seq"), F.lit(False)) | F.coalesce(F.col("kept_set") < F.col("seq"), F.lit(False))
        marked = live.join(decided.select("seq"), "seq", "left_anti").join(hit_keys, "key", "left").join(hit_sets, "set", "left")
        marked = cut(marked.select("seq", "key", "set", "needs", "block", hit.alias("out")))
        gone = marked.where("out AND needs IS NULL").select("seq")
        dropped, rest = dropped.union(gone), marked.where("NOT out OR needs IS NOT NULL")
        if conditional:  # what needs a node dropped now exists; what needs one kept now does not
            met, missed = gone.select(F.col("seq").alias("needs"), F.lit(True).alias("met")), kept.select(F.col("seq").alias("needs"))
            rest = cut(rest.join(missed, "needs", "left_anti").join(met, "needs", "left").withColumn("met", F.coalesce("met", F.lit(False))))
            dropped = dropped.union(rest.where("out AND met").select("seq"))
            rest = rest.where("NOT (out AND met)").withColumn("needs", F.when(~F.col("met"), F.col("needs")))
        live = rest.select("seq", "key", "set", "needs", F.col("out").alias("lost"), "block")
    return dropped


#: So few of the best pairs are passed through in order by one task; more go in rounds of joins.
FEW = 20_000


def _capped_in_order(pairs: DataFrame, cap: int) -> DataFrame:
    """What capped_pairs accepts of few pairs."""

    def run(batches):
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["place"])
        used, out = Counter(), []
        for r in rows:
            if used[r["a"]] < cap and used[r["b"]] < cap:
                used.update((r["a"], r["b"]))
                out.append(r["place"])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["place"])

    placed = cut(pairs.withColumn("place", F.row_number().over(Window.orderBy("rank")).cast("long")))
    accepted = placed.select("a", "b", "place").coalesce(1).mapInArrow(run, "place long")
    return placed.join(accepted, "place").select("a", "b", "rank")


def capped_pairs(pairs: DataFrame, cap: int = 2, most: int | None = None, few: int = FEW) -> DataFrame:
    """The pairs(a, b, rank; ranks distinct) that a pass in rank order accepts if each end may be used cap times; the first `most` of them.

    A pass in order needs no pair after the last one it accepts, so for the first `most` longer and longer beginnings, of up to `few` pairs, are passed
    through first. Else each round every end marks its best live pairs, as many as it has uses left; a pair marked by both ends is accepted.
    """
    live = cut(pairs.select("a", "b", "rank"))
    n = live.count()
    size = min(few, n if most is None else 16 * most)
    while 0 < size and (most is not None or n <= size):
        some = cut(_capped_in_order(live if n <= size else live.orderBy("rank").limit(size), cap))
        if n <= size or some.count() >= most:
            return some if most is None else some.orderBy("rank").limit(most)
        if size == few:
            break
        size = min(few, 4 * size)
    accepted = live.limit(0)
    while live.take(1):
        uses = accepted.select(F.col("a").alias("end")).union(accepted.select(F.col("b").alias("end"))).groupBy("end").agg(F.count("*").alias("used"))
        ends = live.select("rank", F.col("a").alias("end")).union(live.select("rank", F.col("b").alias("end")))
        place = F.row_number().over(Window.partitionBy("end").orderBy("rank"))
        marked = ends.withColumn("place", place).where(F.col("place") <= cap).join(uses, "end", "left").where(F.col("place") <= cap - F.coalesce("used", F.lit(0)))
        both = marked.groupBy("rank").agg(F.count("*").alias("marks")).where("marks = 2").select("rank")
        accepted = cut(accepted.union(live.join(both, "rank", "left_semi").select("a", "b", "rank")))
        full = accepted.select(F.col("a").alias("end")).union(accepted.select(F.col("b").alias("end"))).groupBy("end").agg(F.count("*").alias("used")).where(F.col("used") >= cap).select("end")
        rest = live.join(both, "rank", "left_anti").join(full.withColumnRenamed("end", "a"), "a", "left_anti").join(full.withColumnRenamed("end", "b"), "b", "left_anti")
        live = cut(rest.select("a", "b", "rank"))
    return accepted if most is None else accepted.orderBy("rank").limit(most)


def numbered(df: DataFrame, category: str, order: list[str], number: str = "n") -> DataFrame:
    """Adds 1, 2, ... within each of few categories in order, without one task per category: ranges of rows are counted first and offset."""
    ranged = cut(df.repartitionByRange(category, *order).sortWithinPartitions(category, *order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy(category, "__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(category).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col(category).alias("__c"), F.col("__part").alias("__p"), before.alias("__before"))
    local = F.row_number().over(Window.partitionBy(category, "__part").orderBy(*order))
    return ranged.withColumn("__local", local).join(offsets, F.col(category).eqNullSafe(F.col("__c")) & (F.col("__part") == F.col("__p"))).withColumn(number, F.col("__local") + F.col("__before")).drop("__part", "__local", "__before", "__c", "__p")


def smallest(df: DataFrame, draw: str, ties: list[str], m: int, digits: int = 3, few: int = 4096) -> DataFrame:
    """The m rows of df that are least in draw (a hexadecimal string, equally long in all rows) and then in ties; of rows equal in both any.

    Counts of the draws' next digits (16 ** digits numbers come to the driver) narrow the m-th place down until few rows share its beginning; rows below are
    told by a filter, and only those that share it are numbered, by ranges.
    """
    begin, left = "", m
    while True:
        at = F.substring(draw, len(begin) + 1, digits)
        counts = sorted((r.d, r.n) for r in df.where(F.startswith(F.col(draw), F.lit(begin))).groupBy(at.alias("d")).agg(F.count("*").alias("n")).collect())
        if sum(n for _, n in counts) <= left:
            return df.where((F.col(draw) < begin) | F.startswith(F.col(draw), F.lit(begin)))
        for d, n in counts:
            if left < n:
                break
            left -= n
        begin += d
        if n <= few or not d:
            break
    tied = df.where(F.startswith(F.col(draw), F.lit(begin))).withColumn("__tie", F.monotonically_increasing_id()).withColumn("__all", F.lit(1))
    taken = numbered(tied, "__all", [draw, *ties, "__tie"], "__place").where(F.col("__place") <= left).drop("__tie", "__all", "__place")
    return df.where(F.col(draw) < begin).unionByName(taken)
