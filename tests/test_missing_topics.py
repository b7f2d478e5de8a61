from groundwork.jobs import source_queries
from groundwork.jobs.bindings import Tables


def test_topics_anywhere_in_a_text_are_required(spark, tmp_path):
    docs = [(1, "one two three four five Harbour " + "x " * 60 + "quartz"), (2, None), (3, "quartz is a title here\nQUARTZ or a b c d ledger")]
    spark.createDataFrame([(d, t, "en") for d, t in docs], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(1, "<p>one two three Harbour " + "x " * 60 + "quartz, anchor</p><nav>hidden</nav>"), (2, None), (3, "<b>ledger</b> island")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = source_queries.QUERIES["c10_missing_topics"][0](Tables(spark, str(tmp_path)))
    assert sorted(r.topic for r in got.collect()) == ["anchor", "island"]
