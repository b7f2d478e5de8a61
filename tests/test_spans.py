"""Merged spans, coverage and overlaps against sets of lines."""

import random

import pytest

from groundwork.operators import source

SPANS = "doc_id long, line_start long, line_end long, origin string"


def some(seed, n, docs=4, length=90):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a = rng.randint(1, length)
        out.append((rng.randrange(docs) if rng.random() < 0.5 else 0, a, min(length, a + rng.choice([0, 0, 1, 3, 70]) * rng.choice([0, 1])), "x"))
    return out


def covered(spans):
    return {(d, i) for d, a, b, *_ in spans for i in range(a, b + 1)}


def islands(lines):
    return sorted((d, i) for d, i in lines if (d, i - 1) not in lines)


@pytest.mark.parametrize(("seed", "parts"), [(1, 2), (2, 7)])
def test_spans(spark, seed, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hand, sections = some(seed, 12), some(seed + 50, 30)
        h, s = spark.createDataFrame([*hand, (0, 50, 40, "ends early")], SPANS), spark.createDataFrame(sections, SPANS)
        merged = sorted((r.doc_id, r.line_start, r.line_end) for r in source.merged_spans(h).collect())
        assert covered(merged) == covered(hand) and [(d, a) for d, a, _ in merged] == islands(covered(hand))
        apart = sorted(tuple(r) for r in source.not_overlapping(s, h).select("doc_id", "line_start", "line_end", "origin").collect())
        assert apart == sorted(x for x in sections if covered([x]).isdisjoint(covered(hand)))
        lines = spark.createDataFrame([(d, i, "t") for d in range(5) for i in range(1, 101)], "doc_id long, line_no long, line string")
        bare = {(d, i) for d in range(5) for i in range(1, 101)} - covered(hand)
        gaps = sorted((r.doc_id, r.line_start, r.line_end) for r in source.coverage_gaps(lines, h).collect())
        assert covered(gaps) == bare and [(d, a) for d, a, _ in gaps] == islands(bare)
        told = source.merge_clause_sources(h.where("line_end >= line_start"), s, lines)
        assert {r.doc_id: r.share for r in source.line_coverage(lines, told).collect()} == dict.fromkeys(range(5), 1.0)
        empty = source.merged_spans(h.limit(0))
        assert empty.count() == 0 and source.not_overlapping(s, h.limit(0)).count() == len(sections)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_long_document_lies_in_many_ranges(spark):
    spans = spark.range(20_000).selectExpr("1L as doc_id", "id * 3 as line_start", "id * 3 + id % 2 * 2 as line_end")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        told = source.ranged(spans.repartition(4), "doc_id", ["line_start", "line_end"])
        assert told.groupBy("__part").count().count() > 1
        assert source.merged_spans(spans).count() == 10_001  # those of odd ids touch the next
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
