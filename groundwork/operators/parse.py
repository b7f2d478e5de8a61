"""Responses as text to rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions import tolerant_json
from groundwork.functions.text import text_or_empty
from groundwork.operators.greedy import numbered

RESPONSE = "reject boolean, reason string, question string, answer string, clarifying_question string, clarification_axis string, ambiguity_type string, confidence string, should_escalate boolean"


def json_slice(content: Column) -> Column:
    """From the first { to the last } of the trimmed text, without code fences if it starts with one; null if there is none."""
    body = F.trim(content)
    bare = F.when(F.startswith(body, F.lit("```")), F.regexp_replace(body, r"```(json)?", "")).otherwise(body)
    first, last = F.instr(bare, "{"), F.char_length(bare) - F.instr(F.reverse(bare), "}") + 1
    return F.when((first > 0) & (F.instr(bare, "}") > 0) & (last > first), F.substring(bare, first, last - first + 1))


def json_rungs(text: Column) -> list[Column]:
    """The text as it is, without trailing commas, and then without control characters."""
    plain = F.regexp_replace(text, r",(\s*[}\]])", "$1")
    return [text, plain, F.regexp_replace(plain, r"[\x00-\x1F]", " ")]


def parse_responses(responses: DataFrame, schema: str = RESPONSE) -> DataFrame:
    """responses(cand_id, content, ...) with parsed (a struct) and error (why it is null).

    The slice and the rung that parses are exploded one-element arrays, so that the optimizer does not repeat them in what follows.
    """
    sliced = responses.withColumn("json", F.explode(F.array(json_slice(text_or_empty("content")))))
    good = F.coalesce(*(F.when(F.try_parse_json(t).isNotNull(), t) for t in json_rungs(F.col("json"))))
    read = sliced.withColumn("good", F.explode(F.array(good)))
    error = F.when(F.col("json").isNull(), "no JSON object").when(F.col("good").isNull(), "JSON does not parse")
    return read.withColumns({"parsed": F.from_json("good", schema), "error": error}).drop("json", "good")


def repair_responses(parsed: DataFrame, schema: str = RESPONSE) -> DataFrame:
    """parsed (as parse_responses gives it) with repaired: responses that do not parse are read once more by the tolerant reader, from their first { on; the others stay as they are.

    Only rejects go to Python. What cannot be read, or has none of the schema's fields, keeps its error.
    """
    fields = [f.split()[0] for f in schema.split(", ")]
    kept, bad = parsed.where("error IS NULL"), parsed.where("error IS NOT NULL")

    @F.pandas_udf("string")
    def fixed(content: pd.Series) -> pd.Series:
        return content.map(tolerant_json.repaired)

    read = bad.withColumn("__read", F.explode(F.array(F.from_json(fixed(text_or_empty("content")), schema))))
    some = F.coalesce(*(F.col("__read")[f].cast("string") for f in fields)).isNotNull()
    told = read.withColumns({"parsed": F.when(some, F.col("__read")), "error": F.when(some, None).otherwise(F.col("error")), "repaired": F.coalesce(some, F.lit(False))}).drop("__read")
    return kept.withColumn("repaired", F.lit(False)).unionByName(told)


def parse_rejects(parsed: DataFrame) -> DataFrame:
    """cand_id, error, content of the responses that do not parse."""
    return parsed.where("error IS NOT NULL").select("cand_id", "error", "content")


def self_rejects(parsed: DataFrame, shown: int = 120) -> DataFrame:
    """cand_id, reason (its first characters) of the responses that reject themselves."""
    return parsed.where(F.coalesce(F.col("parsed.reject"), F.lit(False))).select("cand_id", F.substring(text_or_empty("parsed.reason"), 1, shown).alias("reason"))


def normalise_rows(rows: DataFrame) -> DataFrame:
    """rows(category, answer, clarifying_question, clarification_axis, ambiguity_type, confidence, should_escalate, ...) with each category's forced values."""
    c = F.col("category")
    return rows.withColumns(
        {
            "answer": F.when(c != "B", F.col("answer")),
            "clarifying_question": F.when(c == "B", F.col("clarifying_question")),
            "clarification_axis": F.when(c == "B", F.col("clarification_axis")),
            "ambiguity_type": F.when(c == "C", F.col("ambiguity_type")),
            "confidence": F.when(c == "C", "low").otherwise(F.coalesce("confidence", F.when(c == "A", "high").otherwise("medium"))),
            "should_escalate": F.when(c == "C", True).otherwise(F.coalesce("should_escalate", F.lit(False))),
        }
    )


def assign_ids(rows: DataFrame, width: int = 3) -> DataFrame:
    """Adds id: category, hyphen and the row's number among its category's rows in seq order."""
    return numbered(rows, "category", ["seq"], "n").withColumn("id", F.concat_ws("-", "category", F.lpad(F.col("n").cast("string"), F.greatest(F.lit(width), F.char_length(F.col("n").cast("string"))), F.lit("0")))).drop("n")
