"""The catalogue of the worst rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MITIGATION = "review by hand"


def worst_k(composites: DataFrame, k: int = 3) -> DataFrame:
    """The k rows with the lowest composite per category, ties in seq order; worst_rank from 1."""
    rank = F.row_number().over(Window.partitionBy("category").orderBy("composite", "seq"))
    return composites.withColumn("worst_rank", rank).where(F.col("worst_rank") <= k)


def lowest_dims(scores: DataFrame, k: int = 3) -> DataFrame:
    """row_id, dim, score, dim_rank of the k lowest scores per row of scores(row_id, dim, dim_pos, score), ties in dim_pos order."""
    rank = F.row_number().over(Window.partitionBy("row_id").orderBy("score", "dim_pos"))
    return scores.withColumn("dim_rank", rank).where(F.col("dim_rank") <= k).select("row_id", "dim", "score", "dim_rank")


def mitigation(low: DataFrame, texts: Mapping[str, str], default: str = DEFAULT_MITIGATION) -> DataFrame:
    """row_id, mitigation: the text of the lowest of the row's low dimensions that has one."""
    known = F.broadcast(low.sparkSession.createDataFrame(list(texts.items()), "dim string, advice string"))  # as many rows as the parameter has
    best = low.join(known, "dim", "left").groupBy("row_id").agg(F.min_by("advice", F.when(F.col("advice").isNotNull(), F.col("dim_rank"))).alias("advice"))
    return best.select("row_id", F.coalesce("advice", F.lit(default)).alias("mitigation"))


def catalogue(rows: DataFrame, composites: DataFrame, scores: DataFrame, flags: DataFrame, texts: Mapping[str, str], k: int = 3) -> DataFrame:
    """row_id, category, worst_rank, composite, question, answer, clarifier (with its axis), low_dims, flags, passed, regen_count, seeds, mitigation of the worst rows.

    rows(row_id, question, answer, clarifying_question, clarification_axis, passed, regen_count, seed_clause_ids).
    """
    worst = worst_k(composites, k)
    few = lowest_dims(scores.join(worst.select("row_id"), "row_id", "left_semi"))
    shown = few.groupBy("row_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dim_rank", F.concat("dim", F.lit("="), F.col("score").cast("string")).alias("t")))), lambda d: d["t"]), ", ").alias("low_dims"))
    asked = F.coalesce("clarifying_question", F.lit(""))
    clarifier = F.when(asked != "", F.concat(asked, F.lit(" (axis: "), F.coalesce("clarification_axis", F.lit("")), F.lit(")"))).otherwise("")
    told = worst.join(rows.select("row_id", "question", "answer", clarifier.alias("clarifier"), "passed", "regen_count", F.array_join("seed_clause_ids", ",").alias("seeds")), "row_id").join(shown, "row_id", "left").join(mitigation(few, texts), "row_id", "left")
    told = told.join(flags.select("row_id", F.array_join("flags", ",").alias("flags")), "row_id", "left")
    return told.select("row_id", "category", "worst_rank", "composite", "question", "answer", "clarifier", "passed", "regen_count", "seeds", F.coalesce("low_dims", F.lit("")).alias("low_dims"), F.coalesce("flags", F.lit("")).alias("flags"), F.coalesce("mitigation", F.lit(DEFAULT_MITIGATION)).alias("mitigation"))
