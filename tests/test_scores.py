import random

import pytest

from groundwork.operators import agreement, audit, costs, scores
from groundwork.sources import io


def kappa_by_confusion(pairs, k=5):
    n = len(pairs)
    o = [[sum(p == (i, j) for p in pairs) for j in range(1, k + 1)] for i in range(1, k + 1)]
    rows, cols = [sum(r) for r in o], [sum(c) for c in zip(*o, strict=True)]
    w = [[(i - j) ** 2 / (k - 1) ** 2 for j in range(k)] for i in range(k)]
    den = sum(w[i][j] * rows[i] * cols[j] / n for i in range(k) for j in range(k))
    return 0.0 if den == 0 else 1 - sum(w[i][j] * o[i][j] for i in range(k) for j in range(k)) / den


@pytest.mark.parametrize("pairs", [[(i, i) for i in (5, 4, 3, 2, 1)], [(5, 1)] * 4, [(3, 3)] * 4, [(random.Random(1).randint(1, 5), random.Random(i).randint(1, 5)) for i in range(50)], [(9, 1), (2, 3), (1, 1)]])
def test_kappa(spark, pairs):
    df = spark.createDataFrame([("d", a, b) for a, b in pairs], "dim string, a int, b int")
    assert agreement.quadratic_kappa(df).first().kappa == pytest.approx(kappa_by_confusion(pairs))


def test_catch_rate(spark):
    labels = spark.createDataFrame([(1, "wrong_citation"), (2, "vague_clarifier"), (3, "odd"), (4, None), (5, "confident_in_C")], "row_id long, injected string")
    got = spark.createDataFrame([(1, "citation_accuracy.clause_id_correct_scope", 2), (2, "clarifier_quality.specificity", 1), (2, "clarifier_quality.not_vague", 5)], "row_id long, dim string, score int")
    assert tuple(agreement.catch_rate(labels, got).first()) == (4, 2, 0.5)
    assert agreement.catch_rate(labels.limit(0), got).first().rate == 0.0


def test_costs(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"m": {"input_per_mtok": 3.0, "output_per_mtok": 15.0}}')
    prices = io.read_pricing(spark, str(tmp_path / "p.json"))
    calls = spark.createDataFrame([("s", "m", 1_000_000, 1_000_000, 5, 0), ("s", "x", 10, 10, 5, 1)], "stage string, model string, input_tokens long, output_tokens long, latency_ms long, count long")
    assert sorted(r.cost_usd for r in costs.call_cost(calls, prices).collect()) == [0.0, 18.0]
    assert sum(r["count"] for r in costs.stage_rollup(costs.call_cost(calls, prices)).collect()) == 2


def test_composite_ties_and_empties(spark):
    rows = spark.createDataFrame([(1, "A"), (2, "B")], "row_id long, category string")
    s = spark.createDataFrame([(1, 4)] * 7 + [(1, 5)], "row_id long, score int")
    assert {r.row_id: r.composite for r in scores.composite(rows, s).collect()} == {1: 4.13, 2: 0.0}


def test_flips(spark):
    v = spark.createDataFrame([(1, "a", "A", "pass"), (2, "a", "A", "fail"), (3, "a", "A", "pass"), (2, "b", "A", "fail"), (1, "c", "A", "fail")], "round int, id string, category string, verdict string")
    assert sorted(tuple(r) for r in audit.verdict_flips(v).collect()) == [(2, "a", "broken"), (2, "b", "new"), (3, "a", "fixed")]


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"meta": {"source_md_sha256": "s"},\n "clauses": [{"clause_id": "c2", "topics": ["x"]}, {"clause_id": "c1"}]}')
    assert [(r.pos, r.clause_id, r.source_sha256) for r in io.read_clauses(spark, str(tmp_path / "c.json")).orderBy("pos").collect()] == [(0, "c2", "s"), (1, "c1", "s")]
    (tmp_path / "l.jsonl").write_text('{"row": {"id": "A-001", "category": "A"}, "human_scores": {"d": 4}, "injected_failure": null}\n\n')
    assert io.read_labels(spark, str(tmp_path / "l.jsonl")).first().human_scores == {"d": 4}
    (tmp_path / "r.jsonl").write_text('{"id": "A-001", "category": "A"}\n\n{"id": "A-1", "category": "A"}\n')
    rows = io.read_rows(spark, str(tmp_path / "r.jsonl"))
    errors = spark.createDataFrame([("A-001", []), ("A-1", ["id: pattern"])], "id string, errors array<string>")
    io.write_dataset(rows, errors, str(tmp_path / "out"))
    io.write_schema_failures(errors, str(tmp_path / "bad"))
    for _ in range(2):
        io.write_dropped(errors, str(tmp_path / "dropped"))
    io.write_reports({"errors": errors}, str(tmp_path / "reports"))
    assert [r.id for r in io.read_rows(spark, str(tmp_path / "out")).collect()] == ["A-001"]
    assert [r.id for r in spark.read.json(str(tmp_path / "bad")).collect()] == ["A-1"]
    assert spark.read.json(str(tmp_path / "dropped")).count() == 4
    assert spark.read.parquet(str(tmp_path / "reports/errors")).count() == 2
