import random

import pytest
from pyspark.sql import functions as F

from groundwork.functions.text import question_key
from groundwork.operators import greedy, parse, schema_gate, validate

CLAUSES = [("c1", "Refunds settle within 15 days of the “request” date."), ("c2", "Fees are 2 percent.")]


def clauses(spark):
    return spark.createDataFrame(CLAUSES, "clause_id string, verbatim_text string")


def rows(spark, data):
    return spark.createDataFrame([(i, i, *r) for i, r in enumerate(data)], "row_id long, seq long, category string, question string, answer string")


def cites(spark, data):
    return spark.createDataFrame(data, "row_id long, branch_pos int, cite_pos int, clause_id string, excerpt string")


def test_citations(spark):
    r = rows(spark, [("A", "q", "a"), ("A", "q", "a"), ("A", "q", "a"), ("A", "q", "a"), ("B", "q", "a"), ("B", "q", "a"), ("A", "q", "a")])
    c = cites(spark, [(0, 0, 0, "c1", 'the "request" date'), (1, 0, 0, "c9", "x"), (2, 0, 0, "c1", "made up"), (5, 0, 0, "c2", ""), (5, 1, 0, "c2", "nope"), (5, 2, 0, "c7", "x"), (6, 0, 0, "c2", None)])
    got = dict(validate.check_citations(r, c, clauses(spark)).collect())
    assert got == {0: None, 1: "unknown clause c9", 2: "excerpt not in c1", 3: "no citation", 4: None, 5: "excerpt not in c2", 6: None}


def test_a_missing_clause_id_is_unknown(spark):
    r, c = rows(spark, [("A", "q", "a"), ("B", "q", "a")]), cites(spark, [(0, 0, 0, None, "x"), (0, 0, 1, "c9", "x"), (1, 1, 0, None, None)])
    assert dict(validate.check_citations(r, c, clauses(spark)).collect()) == {0: "unknown clause null", 1: "unknown clause null"}
    assert {(r.row_id, r.code) for r in validate.strict_citation_audit(c, clauses(spark)).collect()} == {(0, "unknown_clause"), (1, "unknown_clause_in_branch")}


def test_strict_audit_reports_every_failure(spark):
    c = cites(spark, [(0, 0, 0, "c1", 'the "request" date'), (0, 0, 1, "c9", "x"), (0, 1, 0, "c2", "nope"), (0, 1, 1, "c8", "x")])
    assert sorted((r.branch_pos, r.cite_pos, r.code) for r in validate.strict_citation_audit(c, clauses(spark)).collect()) == [(0, 0, "excerpt_not_substring"), (0, 1, "unknown_clause"), (1, 0, "branch_excerpt_not_substring"), (1, 1, "unknown_clause_in_branch")]


def test_grounding_is_by_substring_and_own_citations_only(spark):
    r = rows(spark, [("A", "q", "In 5 days."), ("A", "q", "In 6 days, or 18% or so."), ("B", "q", None), ("A", "q", "no number")])
    c = cites(spark, [(0, 0, 0, "c1", ""), (1, 0, 0, "c1", ""), (2, 1, 0, "c2", "")])
    b = spark.createDataFrame([(2, 1, "It is 2 percent.")], "row_id long, branch_pos int, answer string")
    got = dict(validate.check_grounding(r, b, c, clauses(spark)).collect())
    assert got == {0: None, 1: "not in cited text: 6 days", 2: "not in cited text: 2 percent", 3: None}


@pytest.mark.parametrize(("question", "bad"), [("  It is so?", True), ("Italy?", False), ("As you mentioned, why?", True), (None, False), ("Why is this so?", False)])
def test_self_containment(spark, question, bad):
    df = spark.createDataFrame([(question,)], "q string")
    assert (df.select(validate.self_containment_reason(F.col("q"))).first()[0] is not None) == bad


def test_structures(spark):
    one = spark.range(1)

    def of(column):
        return one.select(column).first()[0]

    lit = F.lit
    assert of(validate.struct_a_reason(lit(1), lit("It MIGHT be, it might."))) == "hedges: might"
    assert of(validate.struct_a_reason(lit(1), lit("Almighty independence"))) is None
    assert of(validate.struct_a_reason(lit(None).cast("int"), lit("Yes."))) == "no citation"
    assert of(validate.struct_b_reason(lit("Which payment method?"), lit("payment_method"), lit(2))) is None
    assert of(validate.struct_b_reason(lit("Which one?"), lit("a__b"), lit(2))) is None  # an empty token is in any text
    assert of(validate.struct_b_reason(lit("Which one?"), lit("account"), lit(2))) == "axis not named"
    assert of(validate.struct_b_reason(lit("Which method?"), lit("method"), lit(1))) == "fewer than 2 branches"
    assert of(validate.struct_c_reason(lit("silent"), lit("For your information."), lit(True), "Acme Bank")) is None
    assert of(validate.struct_c_reason(lit("silent"), lit("Clearly, escalate."), lit(True), "Acme Bank")) == "confident answer"
    assert of(validate.struct_c_reason(lit("silent"), lit("Escalate."), lit(False), "Acme Bank")) == "no escalation flag"
    assert of(validate.struct_c_reason(lit("silent"), lit("Contact ACME Bank."), lit(True), "Acme Bank")) is None
    assert of(validate.struct_c_reason(lit("silent"), lit("Contact the bank."), lit(True), "Acme Bank")) == "no escalation words"
    assert of(validate.struct_c_reason(lit("odd"), lit("Escalate."), lit(True), "Acme Bank")) == "unknown ambiguity type"


def test_key_keeps_accents(spark):
    df = spark.createDataFrame([("  ¿Qué_es,  ÉL?  ",), (None,)], "q string")
    assert [r[0] for r in df.select(question_key(F.col("q"))).collect()] == ["qué_es él", ""]


def brute_first_fit(rows, least=0.8):
    kept, dropped = [], []
    for seq, scope, cite, question in rows:
        tokens = set(question.split())
        hit = any(s == scope and (q == question or (c == cite and tokens and set(q.split()) and len(tokens & set(q.split())) / len(tokens | set(q.split())) >= least)) for _, s, c, q in kept)
        (dropped if hit else kept).append((seq, scope, cite, question))
    return sorted(d[0] for d in dropped)


@pytest.mark.parametrize("block", [4, 20, 20_000])
def test_dedupe_equals_the_sequential_pass(spark, monkeypatch, block):
    monkeypatch.setattr(validate, "first_fit", lambda nodes, near: greedy.first_fit(nodes, near, block))
    rng = random.Random(5)
    data = [(i, rng.choice("xy"), rng.choice(["", "c1"]), " ".join(rng.sample("abcdef", rng.choice([0, 4, 5, 6])))) for i in range(90)]
    df = spark.createDataFrame([(i, i, s, c, q) for i, s, c, q in data], "row_id long, seq long, scope string, cite_key string, question string")
    assert sorted(r.seq for r in validate.dedupe_rows(df, ["scope"]).collect()) == brute_first_fit(data)


def test_a_long_chain_of_near_copies(spark):
    words = [f"w{i}" for i in range(600)]
    data = [(i, "x", "", " ".join(words[i : i + 40])) for i in range(500)]  # each hits the few before and after it
    df = spark.createDataFrame([(i, i, s, c, q) for i, s, c, q in data], "row_id long, seq long, scope string, cite_key string, question string")
    assert sorted(r.seq for r in validate.dedupe_rows(df, ["scope"]).collect()) == brute_first_fit(data)


@pytest.mark.parametrize("few", [0, 7, 1000])
def test_greedy_pairs_equal_the_sequential_pass(spark, few):
    rng = random.Random(8)
    pairs = list({tuple(sorted(rng.sample(range(14), 2))) for _ in range(50)})
    rng.shuffle(pairs)
    used, want = dict.fromkeys(range(14), 0), []
    for rank, (a, b) in enumerate(pairs):
        if used[a] < 2 and used[b] < 2 and len(want) < 9:
            used[a], used[b] = used[a] + 1, used[b] + 1
            want.append(rank)
    df = spark.createDataFrame([(a, b, r) for r, (a, b) in enumerate(pairs)], "a long, b long, rank long")
    assert sorted(r["rank"] for r in greedy.capped_pairs(df, 2, 9, few).collect()) == want
    assert sorted(r["rank"] for r in greedy.capped_pairs(df, 2, None, few).collect())[:9] == want
    assert greedy.capped_pairs(df.limit(0), 2, 9, few).count() == 0


def test_numbering_and_empty_tables(spark):
    df = spark.createDataFrame([("B", 5), ("A", 3), ("A", 1), ("B", 2), (None, 1)], "category string, seq long")
    assert sorted((str(r.category), r.seq, r.n) for r in greedy.numbered(df, "category", ["seq"]).collect()) == [("A", 1, 1), ("A", 3, 2), ("B", 2, 1), ("B", 5, 2), ("None", 1, 1)]
    assert greedy.numbered(df.limit(0), "category", ["seq"]).count() == 0
    assert validate.check_citations(rows(spark, []), cites(spark, []), clauses(spark)).count() == 0


@pytest.mark.parametrize(
    ("content", "question"),
    [('{"question": "q1"}', "q1"), ('```json\n{"question": "q2"}\n```', "q2"), ('So: {"question": "q3", } end', "q3"), ('{"question": "q\x014"}', "q 4"), ('{"question": ', None), ("", None), (None, None)],
)
def test_parse_ladder(spark, content, question):
    got = parse.parse_responses(spark.createDataFrame([(1, content)], "cand_id long, content string")).first()
    assert (got.parsed.question if got.parsed else None) == question
    assert (got.error is None) == (question is not None)


def test_schema_errors(spark):
    names = "row_id long, id string, category string, question string, persona string, answer string, clarifying_question string, clarification_axis string, n_branches int, ambiguity_type string, confidence string, should_escalate boolean, regen_count int"
    good = (1, "A-001", "A", "What is it then?", "p", "It is ten long.", None, None, 0, None, "high", False, 0)
    bad = (2, "A-1", "A", "What is it then?", "p", "It is ten long.", "Which?", None, 0, None, "sure", False, -1)
    open_c = (3, "C-003", "C", "What is it then?", "p", "Escalate it.", None, None, 0, "silent", "low", False, 0)
    got = schema_gate.schema_errors(spark.createDataFrame([good, bad, open_c], names), cites(spark, []))
    assert {r.row_id: r.errors for r in got.collect()} == {1: [], 2: ["id: pattern", "confidence: not one of high, medium, low", "regen_count: below 0", "clarifying_question: must be null"], 3: ["should_escalate: must be true"]}
