"""Similar sets as a join of packs, against all pairs; and what their queries write."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from groundwork.operators import alike, audit, greedy, validate


def some_sets(seed, n, blocks, words, longest):
    rng = random.Random(seed)
    found = {}
    while len(found) < n:
        size = rng.randint(1, longest)
        own = {f"w{min(int(rng.expovariate(3.0 / words)), words - 1)}é" for _ in range(size)}
        if found and rng.random() < 0.4:
            block, old = rng.choice(list(found))
            own = set(old) - {w for w in old if rng.random() < 0.15} | set(list(own)[: rng.randint(0, 2)])
        block = rng.choice(blocks) if rng.random() < 0.6 or not found else block
        if own:
            found[block, tuple(sorted(own))] = len(found)
    return [(7 * at + 3, block, " ".join(own)) for (block, own), at in found.items()]


@pytest.mark.parametrize("least", [0.1, 0.5, 0.8, 1.0])
@pytest.mark.parametrize(("pack_words", "pack_sets", "meetings"), [(1_000_000, 1 << 15, 2_000_000), (64, 32, 50)])
def test_all_pairs_and_no_others(spark, monkeypatch, least, pack_words, pack_sets, meetings):
    for name, value in (("PACK_WORDS", pack_words), ("PACK_SETS", pack_sets), ("MEETINGS", meetings), ("WORDS", meetings), ("PARTNERS", 2)):
        monkeypatch.setattr(alike, name, value)
    data = some_sets(5, 150, ["x", "y", "z"], 60, 25)
    got = sorted((min(r.a, r.b), max(r.a, r.b), r.similarity) for r in alike.similar_sets(spark.createDataFrame(data, "at long, block string, words string"), least).collect())
    want = []
    for i, (a, block, words) in enumerate(data):
        for b, other, more in data[i + 1 :]:
            x, y = set(words.split()), set(more.split())
            if block == other and len(x & y) / len(x | y) >= least:
                want.append((min(a, b), max(a, b), len(x & y) / len(x | y)))
    assert got == sorted(want)
    assert want or least == 1.0


def written_bytes(spark, run):
    folder = Path(greedy.shared_folder(spark).removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    before = size()
    rows = run().collect()
    return rows, size() - before


def long_questions(spark):
    rng = random.Random(1)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(1500)) for _ in range(120)]
    texts += [" ".join([*texts[0].split()[:-5], "and", "more"])]
    return texts, spark.createDataFrame([(i, i, "s", "", t) for i, t in enumerate(texts)], "row_id long, seq long, scope string, cite_key string, question string")


def test_dedupe_writes_little_more_than_the_texts(spark):
    texts, rows = long_questions(spark)
    found, size = written_bytes(spark, lambda: validate.dedupe_rows(rows, ["scope"]))
    assert [r.seq for r in found] == [len(texts) - 1]
    assert size < 2.5 * sum(map(len, texts))


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_near_pairs_write_little_more_than_the_texts(spark, least):
    texts, rows = long_questions(spark)
    if least == 0.5:
        found, size = written_bytes(spark, lambda: audit.wasted_slots(rows.withColumn("seed", F.col("scope")).drop("cite_key", "scope")))
    else:
        found, size = written_bytes(spark, lambda: validate.near_duplicate_pairs(rows, ["scope"]))
    assert [(r.earlier, r.later) for r in found] == [(0, len(texts) - 1)]
    assert size < 2.2 * sum(map(len, texts))
