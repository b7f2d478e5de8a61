"""Nested rows: their schema, and a whole round from JSON lines to the written files."""

import json

import pytest
from pyspark.sql import functions as F

from groundwork.jobs import rounds
from groundwork.operators import schema_gate, source
from groundwork.sources import io

META = {"prompt_version": "v1", "model": "m", "seed_clause_ids": ["c1"], "timestamp": "t", "cost_usd": 0.1, "tokens": {"input": 1, "output": 2}, "latency_ms": 3, "regen_count": 0}
CITE = {"clause_id": "c1", "verbatim_excerpt": "within 15 days", "relevance": "direct"}


def row(row_id, **changes):
    base = {"row_id": row_id, "id": f"A-{row_id:03d}", "category": "A", "question": f"What holds for the refund number {row_id * 7919}?", "persona": "p", "answer": "It settles within 15 days.", "clause_citations": [CITE], "confidence": "high", "should_escalate": False, "generation_meta": META}
    return base | changes


def branch(**changes):
    return {"axis_value": "card", "answer": "It is ten long.", "clause_citations": []} | changes


def stored(spark, tmp_path, data):
    (tmp_path / "rows.jsonl").write_text("\n".join([*map(json.dumps, data), ""]))
    return io.read_rows(spark, str(tmp_path / "rows.jsonl"), rounds.ROW_SCHEMA)


@pytest.mark.parametrize(
    ("changes", "error"),
    [
        ({}, None),
        ({"clause_citations": None}, "clause_citations: required"),
        ({"clause_citations": [CITE | {"clause_id": None}]}, "clause_citations: incomplete"),
        ({"clause_citations": [CITE, CITE | {"relevance": "loose"}]}, "clause_citations.relevance: unknown"),
        ({"clause_citations": [{k: v for k, v in CITE.items() if k != "relevance"}]}, "clause_citations.relevance: unknown"),
        ({"generation_meta": None}, "generation_meta: incomplete"),
        ({"generation_meta": META | {"tokens": {"input": 1}}}, "generation_meta: incomplete"),
        ({"category": "B", "id": "B-001", "clarifying_question": "Which method is it?", "clarification_axis": "method", "answer_branches": [branch(), branch(axis_value=None)]}, "answer_branches: incomplete"),
        ({"category": "C", "id": "C-001", "should_escalate": True, "ambiguity": {"type": "silent", "what_is_known": "k"}}, "ambiguity: incomplete"),
    ],
)
def test_nested_schema(spark, tmp_path, changes, error):
    found = schema_gate.nested_schema_errors(stored(spark, tmp_path, [row(1, **changes)])).first().errors
    assert error in found if error else found == []


def test_a_round(spark, tmp_path):
    clauses = spark.createDataFrame([("c1", "Refunds settle within 15 days.")], "clause_id string, verbatim_text string")
    again = row(1)["question"].upper()
    data = [
        row(1), row(2, question=again), row(3, clause_citations=[CITE | {"clause_id": "c9"}]), row(4, answer="It takes 99 days."), row(5, persona=None), row(6), row(7), row(8),
        row(9, category="B", id="B-001", answer=None, clarifying_question="Which method is it?", clarification_axis="method", answer_branches=[branch(), branch(axis_value="bank", clause_citations=[CITE])]),
        row(10, category="C", id="C-001", answer="Please escalate.", should_escalate=True, confidence="low", ambiguity={"type": "silent", "what_is_known": "k", "what_is_missing": "m"}),
    ]
    got = {r.row_id: r.state for r in rounds.run_round(stored(spark, tmp_path, data), clauses, str(tmp_path / "out"), "the provider", target=4).collect()}
    assert got == {1: "written", 2: "dropped", 3: "dropped", 4: "dropped", 5: "schema_failure", 6: "written", 7: "written", 8: "over_quota", 9: "written", 10: "written"}
    written = io.read_rows(spark, str(tmp_path / "out/dataset"), rounds.ROW_SCHEMA)
    assert sorted(r.row_id for r in written.collect()) == [1, 6, 7, 9, 10]
    assert written.where("row_id = 9").select(F.col("answer_branches")[1]["clause_citations"][0]["clause_id"]).first()[0] == "c1"
    dropped = spark.read.json(str(tmp_path / "out/dropped"))
    assert {r.row_id: r.reasons for r in dropped.collect()} == {2: ["duplicate question"], 3: ["unknown clause c9", "not in cited text: 15 days"], 4: ["not in cited text: 99 days"]}
    assert [r.errors for r in spark.read.json(str(tmp_path / "out/schema_failures")).collect()] == [["persona: required"]]


def test_a_round_of_no_rows(spark, tmp_path):
    clauses = spark.createDataFrame([], "clause_id string, verbatim_text string")
    assert rounds.run_round(stored(spark, tmp_path, [row(1)]).limit(0), clauses, str(tmp_path / "out"), "the provider").count() == 0


def test_lines_end_at_every_line_end(spark):
    text = "a\r\nb\rc\nd\x0be\x0cf\x1cg\x1dh\x1ei\x85j\u2028k\u2029\n\nl\n"
    got = source.lines(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")).orderBy("line_no").collect()
    assert [r.line for r in got] == text.splitlines()


def test_pages_without_text(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>"), (2, "<script>x</script><p> </p>"), (3, None), (4, "")], "page_id long, html string")
    assert sorted(r.page_id for r in source.empty_pages(pages).collect()) == [2, 3, 4]
