"""Retries that carry the state of the pass, against a plain loop."""

import random

import pytest

from groundwork.operators import greedy, validate

ROWS = "row_id long, seq long, category string, question string, answer string, clarifying_question string, clarification_axis string, ambiguity_type string, should_escalate boolean"
CITES = "row_id long, branch_pos int, cite_pos int, clause_id string, excerpt string"


def alike(a, b):
    x, y = set(a.split()), set(b.split())
    return bool(x and y) and len(x & y) / len(x | y) >= 0.8


def plain(first, again, good):
    """row_id, passed, regen_count of a sequential pass over (row_id, category, question, cites); good(row): whether all other checks pass."""
    kept, out = [], []

    def check(row):
        _, cat, q, cites = row
        hit = any(c == cat and (k == q or (s == cites and alike(k, q))) for c, k, s in kept)
        if not hit:
            kept.append((cat, q, cites))
        return not hit and good(row)

    retry = {r[0]: r for r in again}
    for row in first:
        ok, used = check(row), 0
        if not ok and row[0] in retry:
            ok, used = check(retry[row[0]]), 1
        out.append((row[0], ok, used))
    return out


@pytest.mark.parametrize("block", [3, 20_000])
def test_retries_are_part_of_the_order(spark, monkeypatch, block):
    monkeypatch.setattr(validate, "first_fit", lambda nodes, near: greedy.first_fit(nodes, near, block))
    rng = random.Random(block)
    clauses = spark.createDataFrame([("c1", "one text"), ("c2", "two texts")], "clause_id string, verbatim_text string")

    def some(i):
        return (i, rng.choice("AX"), " ".join(rng.sample("abcdefg", rng.choice([4, 5, 6]))) + ("" if rng.random() < 0.7 else " as you mentioned"), frozenset(rng.choice([["c1"], ["c2"], ["c1", "c2"]])))

    first = [some(i) for i in range(60)]
    again = [(i, c, q if rng.random() < 0.3 else some(i)[2], s) for i, c, q, s in first if rng.random() < 0.8]  # some ask their original's question again

    def tables(rows):
        told = spark.createDataFrame([(i, i, c, q, "Yes.", None, None, None, False) for i, c, q, _ in rows], ROWS).repartition(2)
        return told, spark.createDataFrame([], "row_id long, branch_pos int, answer string"), spark.createDataFrame([(i, 0, j, c, "text") for i, _, _, s in rows for j, c in enumerate(sorted(s))], CITES)

    got = validate.validate_with_retries(tables(first), tables(again), clauses, ["category"], "the provider").collect()
    want = plain(first, again, lambda row: "as you mentioned" not in row[2])
    assert sorted((r.row_id, r.passed, r.regen_count) for r in got) == want
    assert {u for _, _, u in want} == {0, 1} and all((r.feedback == "") == (r.regen_count == 0 and r.passed) for r in got)
    assert all(r.passed == (r.reasons == []) for r in got)


def test_a_retry_that_repeats_its_own_original_is_a_duplicate(spark):
    clauses = spark.createDataFrame([("c1", "text")], "clause_id string, verbatim_text string")
    none = spark.createDataFrame([], "row_id long, branch_pos int, answer string")

    def tables(*rows):
        return spark.createDataFrame([(i, i, "A", q, a, None, None, None, False) for i, q, a in rows], ROWS), none, spark.createDataFrame([(i, 0, 0, "c1", "text") for i, _, _ in rows], CITES)

    first = tables((1, "what is due", "It might be."), (2, "who pays", "Yes."), (3, "who pays", "Yes."))
    again = tables((1, "what is due", "Ten."), (2, "never asked", "No."), (3, "never asked", "No."))
    got = {r.row_id: (r.passed, r.regen_count, r.reasons) for r in validate.validate_with_retries(first, again, clauses, ["category"], "x").collect()}
    assert got == {1: (False, 1, ["duplicate question"]), 2: (True, 0, []), 3: (True, 1, [])}
