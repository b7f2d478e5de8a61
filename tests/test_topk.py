"""The registered keyword search against brute force: the queries grow with the table."""

from groundwork.jobs import source_queries
from groundwork.jobs.bindings import Tables


def brute(docs, clauses):
    out = []
    for d, text in docs:
        if d % 20:
            continue
        q = (text or "").lower()
        scored = []
        for c in clauses:
            title = c.title.lower()
            score = 2.0 * sum(t in q for t in c.topics) + (1.0 if title and any(w in q for w in [title, *title.split()]) else 0.0)
            if score > 0:
                scored.append((-score, c.pos, c.clause_id))
        out += [(d, c, -s, i + 1) for i, (s, _, c) in enumerate(sorted(scored)[:5])]
    return sorted(out)


def test_every_twentieth_document_asks(spark, tmp_path):
    words = ["Customer", "refund", "ledger", "of", "Invoice", "x", "harbour", "quartz"]
    docs = [(d, None if d == 40 else "\n".join(" ".join(words[(d * 7 + i * j) % 8] for j in range(1, 6 + i)) for i in range(1, 4))) for d in range(0, 101, 5)]
    spark.createDataFrame([(d, t, "en") for d, t in docs], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    tables = Tables(spark, str(tmp_path))
    got = source_queries.QUERIES["r3_keyword_topk"][0](tables)
    want = brute(docs, tables.clauses.collect())
    assert {d for d, *_ in want} == {0, 20, 60, 80, 100}
    assert sorted(map(tuple, got.collect())) == want
