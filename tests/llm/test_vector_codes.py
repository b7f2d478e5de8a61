"""Product codes by exponion search against plain loops over Python's whole numbers."""

import math
import random

import numpy as np
import pytest

from groundwork.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, codes string"


def plain(rows, n_parts, n_entries, rounds, scale=1024):
    """(vec_id, codes, error) of kept rows and the codebooks, every entry looked at for every part."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // n_parts
    books = [[v[p * w : (p + 1) * w] for _, v in kept[:n_entries]] for p in range(n_parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p * w : (p + 1) * w], c, strict=True)), j) for j, c in enumerate(books[p])) for p in range(n_parts)] for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(n_parts):
            for j in range(len(books[p])):
                own = [v[p * w : (p + 1) * w] for (_, v), f in zip(kept, found, strict=True) if f[p][1] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return [(i, [f[1] for f in fs], sum(f[0] for f in fs)) for (i, _), fs in zip(kept, assign(), strict=True)], books


def some_rows(n, width, seed, values=None):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.choice(values) if values else rng.gauss(0, 0.2))) for _ in range(width)], rng.choice([None, 1, 1, 1, 2]), "x") for i in range(n)]
    return rows + [(3, rows[5][1], 1, "y"), (3, rows[6][1], 2, "y"), (None, rows[0][1], None, "z"), (None, rows[1][1], None, "z"), (7, None, 1, ""), (8, [0.0, None] * (width // 2), 1, ""), (9, [float("nan")] * width, 1, ""), (10, [float("inf")] * width, None, "")]


@pytest.mark.parametrize(("width", "n_entries", "values"), [(8, 16, None), (8, 16, [0.0, 0.25, -0.25]), (4, 200, None), (16, 3, [0.5])])
def test_against_every_entry(spark, width, n_entries, values):
    rows = some_rows(90, width, width + n_entries, values)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded, books = vc.vector_codes(df, n_entries=n_entries)
    want, want_books = plain(rows, 4, n_entries, 4)
    assert sorted(map(repr, ((r.vec_id, r.codes, r.errors) for r in coded.collect()))) == sorted(map(repr, want))
    assert books.tolist() == want_books


def test_search_looks_at_enough_entries():
    rng = np.random.default_rng(1)
    for scale in (3, 300, 1 << 24):
        book = rng.integers(-scale, scale, (64, 4))
        book[7] = book[3]  # ties go to the lower index
        x = np.concatenate([rng.integers(-scale, scale, (500, 4)), book])
        n = vc.Neighbours(book)
        apart = ((x[:, None, :] - book[None]) ** 2).sum(2)
        for before in (np.zeros(len(x), np.int64), rng.integers(0, 64, len(x))):
            index, least = n.nearest(x, before, block=50)
            assert (index == apart.argmin(1)).all() and (least == apart.min(1)).all()


def test_labels_and_names(spark, monkeypatch):
    rows = some_rows(40, 8, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    coded, _ = vc.vector_codes(df, n_entries=8, keep=("label", "codes"))
    assert coded.columns == ["vec_id", "label", "codes", "v", "_codes", "errors"]
    totals = {}
    for r in coded.collect():
        totals[r.label] = totals.get(r.label, 0) + r.errors
    for most in (500_000, 0):
        monkeypatch.setattr("groundwork.llm.common.BROADCAST_ROWS", most)
        found = vc.with_label_errors(coded).collect()
        assert len(found) == 44 and all(r.label_error == totals[r.label] for r in found)


def test_codes_as_text(spark):
    df = spark.createDataFrame([([0, 15, 255, 16],)], "codes array<int>")
    assert df.select(vc.code_text(df.codes).alias("c")).first().c == "000fff10"


def test_edges(spark):
    empty, books = vc.vector_codes(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and books.size == 0 and vc.with_label_errors(empty).count() == 0
    none, _ = vc.vector_codes(spark.createDataFrame([(1, None, 1, "")], SCHEMA))
    assert none.count() == 0
    for bad in ([(1, [0.5] * 4, 1, ""), (2, [0.5] * 8, 1, "")], [(1, [0.5] * 6, 1, "")]):
        with pytest.raises(ValueError):
            vc.vector_codes(spark.createDataFrame(bad, SCHEMA))
    with pytest.raises(Exception, match="too large"):
        vc.vector_codes(spark.createDataFrame([(1, [1e30] * 4, 1, "")], SCHEMA))
    bare, books = vc.vector_codes(spark.createDataFrame([(1, [], 1, ""), (2, [], None, "")], SCHEMA))
    assert [(r.codes, r.errors) for r in bare.collect()] == [([0] * 4, 0)] * 2 and books.shape == (4, 2, 0)
