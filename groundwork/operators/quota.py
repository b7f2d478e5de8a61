"""Quotas, removals, unions and new ids of rounds of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundwork.operators.greedy import numbered


def quota_per_category(rows: DataFrame, target: int) -> DataFrame:
    """The first target rows of each category in seq order; Spark cuts each task's rows to that many before they meet."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("category").orderBy("seq"))).where(F.col("__n") <= target).drop("__n")


def without_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select("id").distinct(), "id", "left_anti")


def removed(rows: DataFrame, ids: DataFrame, reason: str) -> DataFrame:
    return rows.join(ids.select("id").distinct(), "id", "left_semi").withColumn("reason", F.lit(reason))


def merge_rounds(kept: DataFrame, new: DataFrame) -> DataFrame:
    return kept.unionByName(new)


def renumber(rows: DataFrame, width: int = 3) -> DataFrame:
    """id becomes old_id; new ids count up within each category in the order of the old ids as strings (A-1000 stands before A-101)."""
    n = F.col("n").cast("string")
    return numbered(rows.withColumnRenamed("id", "old_id"), "category", ["old_id"], "n").withColumn("id", F.concat_ws("-", "category", F.lpad(n, F.greatest(F.lit(width), F.char_length(n)), F.lit("0")))).drop("n")
