"""The m least rows without a sort of all."""

import pytest
from pyspark.sql import functions as F

from groundwork.functions.text import seeded
from groundwork.operators import agreement, greedy


@pytest.mark.parametrize(("few", "digits"), [(4096, 3), (5, 1), (1, 2)])
def test_smallest_is_the_beginning_of_the_order(spark, few, digits):
    ids = [*range(300), *[7] * 40, *[None] * 3]
    df = spark.createDataFrame([(i,) for i in ids], "row_id long").repartition(3).withColumn("draw", seeded(5, "row_id"))
    order = [(r.draw, r.row_id) for r in sorted(df.collect(), key=lambda r: (r.draw, r.row_id is not None, r.row_id or 0))]
    for m in (0, 1, 17, 100, 200, 342, 343, 999):
        got = greedy.smallest(df, "draw", ["row_id"], m, digits, few)
        assert sorted((r.draw, str(r.row_id)) for r in got.collect()) == sorted((d, str(i)) for d, i in order[:m])
        assert got.columns == ["row_id", "draw"]


def test_sample_has_its_exact_size_and_no_growing_limit(spark):
    rows = spark.range(1000).withColumnRenamed("id", "row_id")
    sample = agreement.sample_rows(rows, 0.2, 11)
    want = sorted(r.row_id for r in rows.orderBy(seeded(11, "row_id"), "row_id").limit(200).collect())
    assert sorted(r.row_id for r in sample.collect()) == want
    assert "Limit" not in sample._jdf.queryExecution().executedPlan().toString()
    assert agreement.sample_rows(rows.where("row_id < 3"), 0.2, 11).count() == 1
    assert agreement.sample_rows(rows.where(F.lit(False)), 0.2, 11).count() == 0
