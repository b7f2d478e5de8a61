"""The pipeline's stages on null and repeated ids: each row stands for itself."""

import random

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("files", [True, False])
def test_near_dedup_by_row(spark, tmp_path, files):
    rng = random.Random(8)
    new = lambda n: " ".join(f"w{rng.randrange(1 << 40)}" for _ in range(n))
    a, b, c, d = (new(100) for _ in range(4))
    kept = [(1, a), (2, new(50)), (7, b), (None, c), (5, d), (9, "x"), (None, new(30)), (None, None), (None, ""), (3, "")]
    gone = [(2, f"{a} {new(2)}"), (7, f"{b} {new(1)}"), (None, f"{b} {new(3)}"), (None, f"{c} {new(1)}"), (6, f"{d} {new(1)}"), (None, f"{d} {new(2)}")]
    rows = kept[:2] + gone[:1] + kept[2:4] + gone[1:] + kept[4:]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).coalesce(1)
    if files:
        docs.repartitionByRange(3, "text").write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
        kept = [k for k in kept if k[0] is not None]
        gone = [g for g in gone if g[0] is not None]
    got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    if files:  # which of near copies without ids stays is up to the files' order
        assert {r for r in rows_of(got) if r[0] is not None} == set(kept) and got.count() == len(rows) - 6
    else:
        assert rows_of(got) == sorted(kept, key=str)


@pytest.mark.parametrize("files", [True, False])
def test_decontaminate_by_row(spark, tmp_path, files):
    leak = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [(None, "clean"), (None, None), (4, "clean too"), (4, ""), (5, "five")]
    gone = [(None, f"x {leak} y"), (4, leak), (6, leak)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in gone + kept], SCHEMA).repartition(3)
    if files:
        docs.write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert rows_of(got) == sorted(kept, key=str)


def test_stages_of_no_rows_and_of_columns_with_clashing_names(spark, tmp_path):
    names = ["doc_id", "text", "score", "row", "__row", "node", "root", "id", "value", "part", "hash", "n_chars", "text_to_score"]
    schema = ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names)
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(1 << 30)}" for _ in range(30))
    rows = [(i, text(), *range(11)) for i in range(20)] + [(None, None, *range(11)), (None, "", *range(11)), (30, " ", *range(11))]
    spark.createDataFrame([(1, "never said " * 12)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == names
        assert got.count() == (21 if name == "exact_dedup" else 23), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, str(tmp_path)).count() == 23 and last(spark, docs.limit(0), str(tmp_path)).count() == 0
