"""Readers and writers of the files that rounds leave behind. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CITATION = "struct<clause_id: string, verbatim_excerpt: string, relevance: string>"
QA_SCHEMA = f"""id string, category string, question string, persona string, user_context string, answer string, clarifying_question string,
clarification_axis string, answer_branches array<struct<axis_value: string, answer: string, clause_citations: array<{CITATION}>>>,
clause_citations array<{CITATION}>, ambiguity struct<type: string, what_is_known: string, what_is_missing: string>, confidence string, should_escalate boolean,
generation_meta struct<prompt_version: string, model: string, seed_clause_ids: array<string>, retrieval_trace: string, timestamp: string, cost_usd: double,
tokens: struct<input: int, output: int>, latency_ms: int, regen_count: int>,
validator_report struct<passed: boolean, checks: map<string,string>, reasons: array<string>>,
judge_report struct<scores: map<string,int>, failure_flags: array<string>, composite: double>"""
CLAUSE_FILE = "meta struct<source_md_sha256: string, curated_at: string>, clauses array<struct<clause_id: string, title: string, verbatim_text: string, line_start: int, line_end: int, parent: string, topics: array<string>>>"


def read_rows(spark: SparkSession, path: str, schema: str = QA_SCHEMA) -> DataFrame:
    """One row per JSON line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_clauses(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """One row per clause of {meta, clauses} objects (one per file, or one per line), in their order (pos from 0), with the hash of the source they were cut from."""
    whole = spark.read.schema(CLAUSE_FILE).option("multiLine", not by_line).json(path)
    return whole.select(F.col("meta.source_md_sha256").alias("source_sha256"), F.posexplode("clauses").alias("pos", "c")).select("source_sha256", "pos", "c.*")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """row_id, injected, human_scores (map), notes of hand-labelled rows."""
    return spark.read.schema("row struct<id: string, category: string>, human_scores map<string,int>, notes string, injected_failure string, labelled_at string").json(path).select(F.col("row.id").alias("row_id"), F.col("row.category").alias("category"), F.col("injected_failure").alias("injected"), "human_scores", "notes")


def read_pricing(spark: SparkSession, path: str) -> DataFrame:
    """model, input_per_mtok, output_per_mtok from a JSON object keyed by model."""
    text = spark.read.text(path, wholetext=True)
    prices = F.from_json("value", "map<string, struct<input_per_mtok: double, output_per_mtok: double>>")
    return text.select(F.explode(prices).alias("model", "p")).select("model", "p.input_per_mtok", "p.output_per_mtok")


def write_dataset(rows: DataFrame, errors: DataFrame, path: str, key: str = "id") -> None:
    """The rows whose errors(key, errors) are empty, as JSON lines."""
    rows.join(errors.where(F.size("errors") == 0).select(key), key, "left_semi").write.mode("overwrite").json(path)


def write_schema_failures(errors: DataFrame, path: str) -> None:
    errors.where(F.size("errors") > 0).select("id", "errors").write.mode("overwrite").json(path)


def write_dropped(rows: DataFrame, path: str) -> None:
    """Append rejected rows(..., reasons)."""
    rows.write.mode("append").json(path)


def write_reports(tables: dict[str, DataFrame], folder: str) -> None:
    """Each small table as one Parquet folder of its name."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
