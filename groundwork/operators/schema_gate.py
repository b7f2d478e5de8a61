"""The schema of a finished row, checked column by column. Rows are flat (see validate), with branches and citations as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions.text import AMBIGUITY_TYPES

ID_PATTERN = r"^[ABC]-\d{3}$"
RELEVANCE = ("direct", "supporting", "contrast")  # fixed values of the schema


def _short(col: str, least: int) -> Column:
    return F.coalesce(F.char_length(col), F.lit(0)) < least


def row_errors(id_pattern: str = ID_PATTERN) -> list[Column]:
    """Error texts (null where there is none) of rows(id, category, question, persona, answer, clarifying_question, clarification_axis, n_branches,
    ambiguity_type, confidence, should_escalate, regen_count)."""
    c = F.col("category")
    b = F.coalesce(F.col("n_branches"), F.lit(0))

    def error(bad: Column, text: str) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.lit(text))

    return [
        error(~F.coalesce(F.col("id").rlike(id_pattern), F.lit(False)), "id: pattern"),
        error(~F.coalesce(c.isin("A", "B", "C"), F.lit(False)), "category: not one of A, B, C"),
        error(_short("question", 10), "question: too short"),
        error(F.col("persona").isNull(), "persona: required"),
        error(~F.coalesce(F.col("confidence").isin("high", "medium", "low"), F.lit(False)), "confidence: not one of high, medium, low"),
        error(F.col("should_escalate").isNull(), "should_escalate: required"),
        error(F.coalesce(F.col("regen_count"), F.lit(-1)) < 0, "regen_count: below 0"),
        error((c == "A") & _short("answer", 10), "answer: too short"),
        error((c == "A") & F.col("clarifying_question").isNotNull(), "clarifying_question: must be null"),
        error((c == "A") & (b > 0), "answer_branches: must be null"),
        error((c != "C") & F.col("ambiguity_type").isNotNull(), "ambiguity: must be null"),
        error((c == "B") & _short("clarifying_question", 10), "clarifying_question: too short"),
        error((c == "B") & _short("clarification_axis", 3), "clarification_axis: too short"),
        error((c == "B") & (b < 2), "answer_branches: fewer than 2"),
        error((c == "C") & F.col("ambiguity_type").isNull(), "ambiguity: required"),
        error((c == "C") & ~F.col("ambiguity_type").isin(*AMBIGUITY_TYPES), "ambiguity.type: unknown"),
        error((c == "C") & ~F.col("should_escalate"), "should_escalate: must be true"),
        error((c == "C") & F.col("clarifying_question").isNotNull(), "clarifying_question: must be null"),
    ]


def schema_errors(rows: DataFrame, citations: DataFrame, id_pattern: str = ID_PATTERN) -> DataFrame:
    """row_id, id, category, errors (array in a fixed order, those of citations last)."""
    bad = citations.where("branch_pos = 0 AND (clause_id IS NULL OR excerpt IS NULL)").groupBy("row_id").agg(F.lit("clause_citations: incomplete").alias("cite_error"))
    told = rows.join(bad, "row_id", "left")
    return told.select("row_id", "id", "category", F.array_compact(F.array(*row_errors(id_pattern), F.col("cite_error"))).alias("errors"))


def nested_errors() -> list[Column]:
    """Error texts (null where there is none) of what stands inside nested rows(answer_branches, clause_citations, ambiguity, generation_meta)."""
    cites, branches, meta = F.col("clause_citations"), F.col("answer_branches"), F.col("generation_meta")

    def error(bad: Column, text: str) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.lit(text))

    def lacks(of: Column, *names: str) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | of[n].isNull()
        return out

    return [
        error(cites.isNull(), "clause_citations: required"),
        error(F.exists(cites, lambda c: lacks(c, "clause_id", "verbatim_excerpt")), "clause_citations: incomplete"),
        error(F.exists(cites, lambda c: ~F.coalesce(c["relevance"].isin(*RELEVANCE), F.lit(False))), "clause_citations.relevance: unknown"),
        error(F.exists(branches, lambda b: lacks(b, "axis_value", "answer", "clause_citations")), "answer_branches: incomplete"),
        error(F.col("ambiguity").isNotNull() & lacks(F.col("ambiguity"), "type", "what_is_known", "what_is_missing"), "ambiguity: incomplete"),
        error(meta.isNull() | lacks(meta, "prompt_version", "model", "timestamp", "cost_usd", "tokens", "latency_ms", "regen_count") | lacks(meta["tokens"], "input", "output"), "generation_meta: incomplete"),
    ]


def nested_schema_errors(nested: DataFrame, id_pattern: str = ID_PATTERN) -> DataFrame:
    """row_id, id, category, errors (array in a fixed order) of nested rows."""
    flat = nested.withColumns({"n_branches": F.coalesce(F.size("answer_branches"), F.lit(0)), "ambiguity_type": F.col("ambiguity.type"), "regen_count": F.col("generation_meta.regen_count")})
    return flat.select("row_id", "id", "category", F.array_compact(F.array(*row_errors(id_pattern), *nested_errors())).alias("errors"))


def valid_share(errors: DataFrame) -> DataFrame:
    """category, n, n_valid, share."""
    ok = F.count_if(F.size("errors") == 0)
    return errors.groupBy("category").agg(F.count("*").alias("n"), ok.alias("n_valid"), (ok / F.count("*")).alias("share"))
