"""Prefix scans within groups of any size: rows are cut into ranges of their order, each range is scanned alone, and what the ranges before it add comes from one row a range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundwork.operators.greedy import cut


def ranged(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df in ranges of (group, order), numbered in __part; a large group lies in many ranges."""
    return cut(df.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()))


def running_max(df: DataFrame, group: str, order: list[str], value: str, name: str, inclusive: bool) -> DataFrame:
    """Adds the greatest value of the rows before each one in its group (with its own, if inclusive) to rows of ranged(); null where there is none."""
    local = F.max(value).over(Window.partitionBy(group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    tops = df.groupBy(group, "__part").agg(F.max(value).alias("__top"))
    before = F.max("__top").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = tops.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), before.alias("__before")).where("__before IS NOT NULL")
    told = df.withColumn("__local", local).join(offsets, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")), "left")
    return told.withColumn(name, F.greatest("__local", "__before")).drop("__local", "__before", "__g", "__p")
