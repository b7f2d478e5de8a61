"""A round over nested rows: read, validate, cut to quota, gate by the schema, write. Nested rows have the columns of sources.io.QA_SCHEMA and a row_id."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.jobs.bindings import Tables
from groundwork.operators import quota, schema_gate, validate
from groundwork.operators.greedy import shared_folder, written
from groundwork.sources import io

ROW_SCHEMA = io.QA_SCHEMA + ", row_id long"


def flat_rows(nested: DataFrame) -> DataFrame:
    """The flat columns of nested rows; their order is that of row_id."""
    return nested.select("row_id", F.col("row_id").alias("seq"), "id", "category", "question", "answer", "clarifying_question", "clarification_axis", F.col("ambiguity.type").alias("ambiguity_type"), "should_escalate")


def flat_branches(nested: DataFrame) -> DataFrame:
    """row_id, branch_pos (from 1), answer of the rows' branches."""
    return nested.select("row_id", F.posexplode("answer_branches").alias("at", "b")).select("row_id", (F.col("at") + 1).alias("branch_pos"), F.col("b.answer").alias("answer"))


def run_round(nested: DataFrame, clauses: DataFrame, folder: str, provider: str, target: int = 15) -> DataFrame:
    """row_id and state (dropped, over_quota, schema_failure or written) of every nested row; dataset, dropped and schema_failures stand in the folder."""
    rows, branches, citations = flat_rows(nested), flat_branches(nested), written(validate.flatten_citations(nested), "citations")
    keyed = rows.join(validate.cite_keys(citations), "row_id", "left").withColumn("cite_key", F.coalesce("cite_key", F.lit("")))
    twice = validate.dedupe_rows(keyed, ["category"]).select(F.col("seq").alias("row_id"))
    report = written(validate.validate_rows(rows, branches, citations, clauses, twice, provider), "reports")
    io.write_dropped(validate.dropped_rows(nested, report), f"{folder}/dropped")
    chosen = written(quota.quota_per_category(validate.kept_rows(rows, report), target).select("row_id"), "chosen")
    errors = written(schema_gate.nested_schema_errors(nested.join(chosen, "row_id", "left_semi")), "schema-errors")
    io.write_dataset(nested, errors, f"{folder}/dataset", "row_id")
    io.write_schema_failures(errors, f"{folder}/schema_failures")
    gated = errors.select("row_id", F.when(F.size("errors") > 0, "schema_failure").otherwise("written").alias("gated"))
    state = F.when(~F.col("passed"), "dropped").otherwise(F.coalesce("gated", F.lit("over_quota")))
    return report.select("row_id", "passed").join(gated, "row_id", "left").select("row_id", state.alias("state"))


def folder_for(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def nested_rows(t: Tables) -> DataFrame:
    """The logical rows, branches and citations as nested rows; gaps are put in by id, so that every rule of the schema is broken somewhere."""
    relevance = F.when((F.col("row_id") % 5 == 0) & (F.col("cite_pos") == 2), "loose").otherwise("direct")
    cited = t.citations.select("row_id", "branch_pos", "cite_pos", F.struct("clause_id", F.col("excerpt").alias("verbatim_excerpt"), relevance.alias("relevance")).alias("c"))
    held = cited.groupBy("row_id", "branch_pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("cite_pos", "c"))), lambda x: x["c"]).alias("cites"))
    none = F.array().cast(f"array<{io.CITATION}>")
    axis = F.when((F.col("row_id") % 10 == 1) & (F.col("branch_pos") == 2), None).otherwise(F.concat(F.lit("axis "), "branch_pos"))
    items = t.branches.join(held, ["row_id", "branch_pos"], "left").select("row_id", "branch_pos", F.struct(axis.alias("axis_value"), "answer", F.coalesce("cites", none).alias("clause_citations")).alias("b"))
    branches = items.groupBy("row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("branch_pos", "b"))), lambda x: x["b"]).alias("answer_branches"))
    own = held.where("branch_pos = 0").select("row_id", "cites")
    told = t.qa.join(own, "row_id", "left").join(branches, "row_id", "left")
    missing = F.when(F.col("conv_id") % 8 == 1, None).otherwise("what is missing")
    meta = F.struct(
        F.lit("v1").alias("prompt_version"), F.when(F.col("conv_id") % 21 != 2, "large").alias("model"), F.array("seed1", "seed2").alias("seed_clause_ids"), F.lit(None).cast("string").alias("retrieval_trace"),
        F.lit("2026-01-01T00:00:00Z").alias("timestamp"), F.lit(0.25).alias("cost_usd"), F.struct(F.lit(10).alias("input"), F.lit(5).alias("output")).alias("tokens"), F.lit(7).alias("latency_ms"), F.col("regen_count").alias("regen_count"),
    )
    return told.select(
        "id", "category", "question", "persona", "answer", "clarifying_question", "clarification_axis", "answer_branches", F.coalesce("cites", none).alias("clause_citations"),
        F.when(F.col("ambiguity_type").isNotNull(), F.struct(F.col("ambiguity_type").alias("type"), F.lit("what is known").alias("what_is_known"), missing.alias("what_is_missing"))).alias("ambiguity"),
        "confidence", "should_escalate", meta.alias("generation_meta"), "row_id",
    )


def stored_rows(t: Tables) -> DataFrame:
    """The nested rows, written as JSON lines and read again."""
    t.write("clauses", "qa", "citations")
    path = folder_for(t, "rows")
    nested_rows(t).write.json(path)
    return io.read_rows(t.spark, path, ROW_SCHEMA)
