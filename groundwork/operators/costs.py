"""Cost and volume of model calls. Calls are stage, model, input_tokens, output_tokens, latency_ms, count; prices are per million tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = ("input_tokens", "output_tokens", "latency_ms")


def call_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls with cost_usd; a model without a price costs 0.0. Prices are one row per model: Spark broadcasts them by their size."""
    priced = calls.join(prices.select("model", "input_per_mtok", "output_per_mtok"), "model", "left")
    cost = F.col("input_tokens") / 1e6 * F.col("input_per_mtok") + F.col("output_tokens") / 1e6 * F.col("output_per_mtok")
    return priced.withColumn("cost_usd", F.coalesce(cost, F.lit(0.0))).drop("input_per_mtok", "output_per_mtok")


def stage_rollup(costed: DataFrame) -> DataFrame:
    """Sums per stage and model; a call counts once at least."""
    return costed.groupBy("stage", "model").agg(*(F.sum(c).alias(c) for c in _SUMS), F.sum("cost_usd").alias("cost_usd"), F.sum(F.greatest("count", F.lit(1))).alias("count"))


def run_totals(costed: DataFrame) -> DataFrame:
    """One row of totals; wall_ms is from the first start to the last end of calls(started, ended in ms)."""
    return costed.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS[:2]), F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("cost_usd"), F.coalesce(F.sum(F.greatest("count", F.lit(1))), F.lit(0)).alias("calls"), (F.max("ended") - F.min("started")).alias("wall_ms"))


def combine_runs(costed: DataFrame) -> DataFrame:
    """run, calls, cost_usd and wall_ms of each run part, and their total (run null) without a wall time of its own."""
    by_run = costed.groupBy("run").agg(F.sum(F.greatest("count", F.lit(1))).alias("calls"), F.sum("cost_usd").alias("cost_usd"), (F.max("ended") - F.min("started")).alias("wall_ms"))
    total = by_run.agg(F.lit(None).cast("string").alias("run"), F.sum("calls").alias("calls"), F.sum("cost_usd").alias("cost_usd"), F.lit(None).cast("long").alias("wall_ms"))
    return by_run.unionByName(total)


def cost_estimate(tasks: DataFrame, expected: DataFrame, prices: DataFrame) -> DataFrame:
    """judge, n, cost_usd of planned tasks(judge) by expected(judge, model, input_tokens, output_tokens) per task."""
    planned = tasks.groupBy("judge").agg(F.count("*").alias("n")).join(expected, "judge")
    return call_cost(planned, prices).select("judge", "n", (F.col("n") * F.col("cost_usd")).alias("cost_usd"))
