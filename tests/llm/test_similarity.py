"""Near-dedup at and just under its threshold, against exact similarities."""

import random

from groundwork.llm import simhash_bk

SHARED_CHANGED = [(4, 0, 1), (8, 1, 1), (40, 5, 5), (400, 50, 50)]


def test_pairs_at_the_threshold_are_all_linked(spark):
    rng, rows, want = random.Random(5), [], set()
    new = lambda n: [f"w{rng.randrange(1 << 40)}" for _ in range(n)]
    for shared, one, other in SHARED_CHANGED:
        assert shared / (shared + one + other) == 0.8
        for _ in range(40):
            words = new(shared + 4)
            rows += [" ".join(words + new(one)), " ".join(words + new(other))]
            want.add(len(rows) - 1)
    for _ in range(40):
        words = new(399 + 4)
        rows += [" ".join(words + new(51)), " ".join(words + new(50))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r.node: r.root for r in simhash_bk.similar_texts(df).collect()}
    assert got == {i: i - 1 for i in want}
