"""Scores of rows: tasks, shapes and composites. Long scores are row_id, category, judge, dim, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JUDGES = ("grounding", "category_fit", "clarity", "citation_accuracy")
EXTRA: Mapping[str, Sequence[str]] = {"B": ("clarifier_quality",), "C": ("ambiguity_framing",)}


def judge_tasks(rows: DataFrame, judges: Sequence[str] = JUDGES, extra: Mapping[str, Sequence[str]] = EXTRA) -> DataFrame:
    """row_id, judge: every judge that scores the row."""
    own = F.array().cast("array<string>")
    for category, names in extra.items():
        own = F.when(F.col("category") == category, F.array(*map(F.lit, names))).otherwise(own)
    return rows.select("row_id", F.explode(F.concat(F.array(*map(F.lit, judges)), own)).alias("judge"))


def cited_text(rows: DataFrame, citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """row_id, cited: blocks "### id, line end, text" of the distinct known cited clauses in first-seen order, or "(none)"."""
    first = citations.groupBy("row_id", "clause_id").agg(F.min(F.struct("branch_pos", "cite_pos")).alias("at"))
    blocks = first.join(clauses.select("clause_id", "verbatim_text"), "clause_id").select("row_id", "at", F.concat(F.lit("### "), "clause_id", F.lit("\n"), "verbatim_text").alias("block"))
    joined = blocks.groupBy("row_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "block"))), lambda b: b["block"]), "\n\n").alias("cited"))
    return rows.select("row_id").join(joined, "row_id", "left").select("row_id", F.coalesce("cited", F.lit("(none)")).alias("cited"))


def flatten_scores(nested: DataFrame) -> DataFrame:
    """row_id, key (judge.dim), score of nested(row_id, judge, scores map)."""
    return nested.select("row_id", "judge", F.explode("scores").alias("dim", "score")).select("row_id", F.concat_ws(".", "judge", "dim").alias("key"), "score")


def unflatten_scores(flat: DataFrame) -> DataFrame:
    """row_id, judge, dim, score; a key is cut at its first dot, one without a dot is both."""
    dot = F.instr("key", ".")
    dim = F.when(dot > 0, F.substring(F.col("key"), dot + 1, F.char_length("key"))).otherwise(F.col("key"))
    return flat.select("row_id", F.substring_index("key", ".", 1).alias("judge"), dim.alias("dim"), "score")


def composite(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """row_id, category, composite: the mean score to 2 decimals, 0.0 without scores."""
    total, n = F.sum("score"), F.count("score")
    mean = scores.groupBy("row_id").agg((F.floor((total * 200 + n) / (n * 2)) / 100).alias("mean"))  # in whole numbers, so that ties round up
    return rows.select("row_id", "category").join(mean, "row_id", "left").select("row_id", "category", F.coalesce("mean", F.lit(0.0)).alias("composite"))


def failure_flags(flags: DataFrame) -> DataFrame:
    """row_id, flags: the sorted distinct flags of all judges, from flags(row_id, flags array)."""
    return flags.groupBy("row_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("flags"))


def composite_by_category(composites: DataFrame, categories: DataFrame) -> DataFrame:
    """category, n, mean, low, high of every category; zeros where it has no rows."""
    told = composites.groupBy("category").agg(F.count("*").alias("n"), F.avg("composite").alias("mean"), F.min("composite").alias("low"), F.max("composite").alias("high"))
    zero = F.lit(0.0)
    return categories.select("category").join(told, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"), *(F.coalesce(c, zero).alias(c) for c in ("mean", "low", "high")))


def dim_distribution(scores: DataFrame) -> DataFrame:
    """dim, s1 to s5: how often each score was given."""
    return scores.groupBy("dim").agg(*(F.count_if(F.col("score") == s).alias(f"s{s}") for s in range(1, 6)))


def low_rows(scores: DataFrame, most: int = 2) -> DataFrame:
    """row_id of the rows with any score of at most `most`."""
    return scores.groupBy("row_id").agg(F.bool_or(F.col("score") <= most).alias("low")).where("low").select("row_id")


