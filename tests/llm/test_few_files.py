"""Small tables are written as few files, however many partitions a shuffle has: each file costs an executor on a local store two processes."""

from groundwork.llm import components, ppm


def test_links_are_written_as_few_files(spark, monkeypatch):
    written, real = [], components.staged
    monkeypatch.setattr(components, "staged", lambda df, name: written.append(real(df, name)) or written[-1])
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        links = spark.createDataFrame([(i, i + 1 if i % 10 < 9 else i) for i in range(500)], "a long, b long")
        found = components.components(links)
        assert {r.node: r.root for r in found.collect()} == {i: i // 10 * 10 for i in range(500) if i % 10}
        assert max(len(df.inputFiles()) for df in written[1:]) <= components.FEW
        n = len(written)
        assert components.components(found, "node", "root").count() == 450 and len(written) == n + 2  # settled links take one round
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_parts_are_written_as_a_file_a_task(spark, monkeypatch):
    written, real = {}, ppm.staged
    monkeypatch.setattr(ppm, "staged", lambda df, name, *more: written.setdefault(name, real(df, name, *more)))
    docs = spark.createDataFrame([(i, f"some words {i} and words") for i in range(40)], "doc_id long, text string").repartition(4)
    assert ppm.scores(docs, ppm.held_out()).count() == 40
    assert 0 < len(written["parts"].inputFiles()) <= 4
