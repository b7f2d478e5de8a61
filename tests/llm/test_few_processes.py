"""Staged tables are few and have no marker files: on a local store each costs the driver processes that show the driver's memory until they start."""

import os

from groundwork.llm import common, reply_trees


def test_staged_tables_have_no_marker(spark):
    df = common.staged(spark.range(10), "numbers")
    assert df.count() == 10
    names = os.listdir(os.path.dirname(df.inputFiles()[0]).removeprefix("file://"))
    assert names and not [n for n in names if "_SUCCESS" in n]


def test_paths_are_walked_two_rounds_at_once(spark, monkeypatch):
    written, real = [], reply_trees.staged
    monkeypatch.setattr(reply_trees, "staged", lambda df, name: written.append(name) or real(df, name))
    sizes = {1: 1, 2: 2, 3: 7, 4: 20}
    rows = [(t, i, i - 1 if i else None, 0.0) for t, n in sizes.items() for i in range(n)] + [(4, 100, 9, 1.0), (4, 101, 100, 9.0)]
    found = reply_trees.chosen_messages(spark.createDataFrame(rows, "tree long, node long, parent long, score double"), best=2).collect()
    want = {(t, n - 1, k, k) for t, n in sizes.items() for k in range(n)} | {(4, 101, k, k) for k in range(10)} | {(4, 101, 10, 100), (4, 101, 11, 101)}
    assert len(found) == len(want) and {(r.tree, r.leaf, r.turn, r.node) for r in found} == want
    assert written.count("jumps") == 6 and written.count("path") <= 4  # one for each round before
