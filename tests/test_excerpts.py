"""Rows that cite the same excerpt, whatever their seeds."""

from groundwork.operators import audit


def test_same_excerpts(spark):
    clauses = spark.createDataFrame([("c1", "Fees of “ten” apply; refunds take seven days; no more."), ("c2", "Other text"), ("c3", None)], "clause_id string, verbatim_text string")
    cites = [
        (1, "c1", 'Fees of "ten"'), (2, "c1", "of “ten” apply"), (3, "c1", "apply; refunds"), (4, "c1", "seven days"), (5, "c2", "Other"), (6, "c1", "not there"), (7, None, "x"), (8, "c1", None), (8, "c3", "x"), (9, "c1", ""), (2, "c1", "of “ten” apply"),
    ]
    citations = spark.createDataFrame([(r, 0, i, c, e) for i, (r, c, e) in enumerate(cites)], "row_id long, branch_pos int, cite_pos int, clause_id string, excerpt string")
    places = sorted((r.row_id, r.place) for r in audit.excerpt_places(citations, clauses).collect())
    assert places == [(1, "c1:1"), (2, "c1:1"), (3, "c1:1"), (4, "c1:35"), (5, "c2:1")]
    rows = spark.createDataFrame([(i, i, q) for i, q in [(1, "how large are the fees"), (2, "how large are fees"), (3, "when do refunds come"), (4, "how large are the fees"), (5, "how large are the fees"), (8, "how large are the fees"), (9, None)]], "row_id long, seq long, question string")
    found = [tuple(r) for r in audit.same_excerpt_slots(rows, citations, clauses).collect()]
    assert found == [(1, 2, 0.8)]
    assert audit.same_excerpt_slots(rows.limit(0), citations, clauses).count() == 0
