"""Fill-in-the-middle against a version that lists all units."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from groundwork.llm import fill_in_middle as fim


def plain(doc_id, text, seed=1, plain_from=90, spm_below=20):
    text, units = text or "", re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= plain_from:
        return n, "plain", None, None, text
    low, high = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if d % 100 < spm_below else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    texts = [None, "", "a", "word", " ", "\n\n", "a<P>b", "<S>", "x<M>", "<P", "<", "<<S", "S>M>", "é漢🙂 mixed Text\r\n1", "long " * 50_000, "y" * 300_000]
    texts += ["".join(rng.choice("<PSM>ab é\n1") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return [(i, t, "k") for i, t in enumerate(texts)] + [(3, "again, again", "k"), (3, "again, again", "k"), (None, "no id here", None)]


@pytest.mark.parametrize(("plain_from", "spm_below"), [(90, 20), (100, 100), (100, 0)])
def test_rows(spark, rows, plain_from, spm_below):
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)
    made = fim.fill_in_middle(docs, plain_from=plain_from, spm_below=spm_below, slice_bytes=500)
    told = made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [(d, *plain(d, t, 1, plain_from, spm_below), t or "") for d, t, _ in rows]
    assert sorted(map(repr, (tuple(r) for r in told))) == sorted(map(repr, want))
    assert {r.form for r in told} == {(90, 20): {"plain", "psm", "spm"}, (100, 100): {"plain", "spm"}, (100, 0): {"plain", "psm"}}[plain_from, spm_below]


def test_names_and_empty_table(spark, rows):
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string, output string")
    made = fim.fill_in_middle(docs, keep=("doc_id", "output", "text"))
    assert made.columns == ["doc_id", "output", "text", "n", "form", "prefix_chars", "middle_chars", "_output"]
    assert made.where("output = 'k'").count() == 5
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_passes_agree_at_every_rank():
    unit = re.compile(fim.UNIT)
    text = "ab, cd\n\né f"
    n = fim.n_units(unit, text)
    ends = [0, *(m.end() for m in unit.finditer(text))]
    assert n == len(ends) - 1 and ends[-1] == len(text)
    for low in range(n + 1):
        for high in range(low, n + 1):
            assert fim.places(unit, text, low, high) == (ends[low], ends[high])
