"""LM scoring and the classifier: against a plain model, and by held-out accuracy."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundwork.llm import ppm, subword_classifier

ORDER = 5
TEXTS = [None, "", " ", "the cat sat on the mat", "The cat, the CAT; the cat sat.", "É é ñandú\n\tx", "zzz qqq", "a" * 400, "the cat " * 300, "only here"]


def plain_model(rows, order):
    contexts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    words = collections.Counter()
    for text, held in rows:
        if not held:
            b = b"\xff" * order + (text or "").encode().lower() + b"\xff"
            for p in range(order, len(b)):
                for k in range(order + 1):
                    contexts[k][b[p - k : p]][b[p]] += 1
            words.update([*(text or "").encode().lower().split(), b"\xff"])
    return contexts, words


def plain_score(contexts, text, order):
    b, total = b"\xff" * order + (text or "").encode().lower() + b"\xff", 0.0
    for p in range(order, len(b)):
        out: set = set()
        for k in range(order, -1, -1):
            seen = contexts[k].get(b[p - k : p])
            if not seen:
                continue
            t, q = sum(n for s, n in seen.items() if s not in out), sum(s not in out for s in seen)
            if b[p] in seen:
                total += math.log10((2 * seen[b[p]] - 1) / (2 * t))
                break
            if t:
                total += math.log10(q / (2 * t))
            out = set(seen)
        else:
            total -= math.log10(256 - len(contexts[0].get(b"", ())))
    return total


@pytest.mark.parametrize(("train", "shards"), [(True, False), (True, True), (False, False)])
def test_ppm(spark, monkeypatch, train, shards):
    rng = random.Random(3)
    texts = [*TEXTS, *("".join(rng.choice("abc d\nÉ") for _ in range(50)) for _ in range(20))]
    rows = [(i, t, (i % 4 == 1) or not train) for i, t in enumerate(texts)] + [(4, texts[4], not train), (None, "null", not train)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, held boolean, score string").repartition(3)
    if shards:
        monkeypatch.setattr(ppm, "SHARD_STRINGS", 40)
        monkeypatch.setattr(ppm, "CELL_STRINGS", 100)
        monkeypatch.setattr(ppm, "PART_BYTES", 100)
        monkeypatch.setattr(ppm, "BATCH_BYTES", 30)
    contexts, words = plain_model([r[1:] for r in rows], ORDER)
    n, v = sum(words.values()), len(words)
    want = []
    for d, t, held in rows:
        tokens = [*(t or "").encode().lower().split(), b"\xff"]
        want.append((d, held, len(tokens), sum(words[w] > 0 for w in tokens), n, round(sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens), 6), round(plain_score(contexts, t, ORDER), 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in ppm.scores(df, F.col("held")).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_probabilities_add_up(spark):
    contexts, _ = plain_model([("abracadabra", False), ("abrac", False)], 2)
    codes, counts = [], []
    for c, seen in contexts[2].items():
        for s, n in seen.items():
            codes.append(int.from_bytes(c + bytes([s]), "big"))
            counts.append(n)
    trie = ppm.Trie(np.array(codes), np.array(counts), {}, 2)
    for context in (b"ab", b"\xff\xff", b"zz", b"xa"):
        codes = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)])
        assert 10 ** trie.log10(codes) @ np.ones(256) == pytest.approx(1)


def test_ppm_of_no_rows(spark):
    assert ppm.scores(spark.createDataFrame([], "doc_id long, text string"), ppm.held_out()).count() == 0


def corpus(n):
    rng = random.Random(1)
    good, bad = ["river", "stone", "window", "garden", "letter"], ["win$$$", "free***", "click###", "buy%%%"]
    for i in range(n):
        quality = int(rng.random() < 0.7)
        words = [rng.choice(good) + rng.choice("stnm") for _ in range(rng.randint(3, 60))]
        if not quality:
            words = [rng.choice(bad) if rng.random() < 0.5 else w for w in words] if i % 2 else [words[0]] * 30
        yield i, " ".join(words), quality


def test_classifier(spark):
    rows = list(corpus(600))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(600, None, "x"), (601, "", "x"), (None, "garden", "x"), (602, "o" * 100_000, "x")], "doc_id long, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 0), (5, None), (6, 7)], "doc_id long, quality int")
    out = subword_classifier.held_out()
    model = subword_classifier.fit(docs, labels, learn_from=~out)
    got = {r.doc_id: r.score for r in subword_classifier.score(docs, model).collect()}
    assert len(got) == 604 and all(0 <= s <= 1 for s in got.values())
    assert got[600] == got[601]
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= 0.5) == bool(q) for i, q in held) / len(held) > 0.97
    kept = subword_classifier.score(docs, model, ("doc_id", "text"))
    assert kept.columns == ["doc_id", "text", "score"] and {r.doc_id: r.score for r in kept.collect()} == pytest.approx(got)
    again = subword_classifier.fit(docs.repartition(7), labels, learn_from=~out)
    assert np.allclose(again[0], model[0])


def plain_average(text, table, bias):
    """The score by its definition: the average, over all features of all words, of one number a bucket."""
    words, values = (text or "").split(), []
    for i, w in enumerate(words):
        values.append(table[zlib.crc32(w.encode()) % subword_classifier.BUCKETS])
        marked = f"<{w}>"
        for n in subword_classifier.GRAMS:
            for at in range(len(marked) - n + 1):
                h = n
                for c in marked[at : at + n]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c)) % (1 << 64)
                values.append(table[(h >> 17) % subword_classifier.BUCKETS])
        if i and w == words[i - 1]:
            values.append(table[subword_classifier.REPEAT])
    return 1 / (1 + math.exp(-(math.fsum(map(float, values)) / len(values) if values else 0.0) - bias))


def test_scores_are_averages_of_the_embedding(spark):
    rng = np.random.default_rng(4)
    table, bias = rng.normal(0, 40, subword_classifier.BUCKETS + 1).astype(np.float32), 0.3
    texts = [None, "", " ", "a", "a a a", "naïve 日本語 😀😀 x", "the the cat sat sat", "w" * 3000, "tab\tnew\nline", *(t for _, t, _ in corpus(30))]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(None, "a", 0.5)], "doc_id long, text string, score double").repartition(3)
    got = {r.doc_id: r.mine for r in subword_classifier.score(docs, (table, bias), ("doc_id", "score"), name="mine").collect()}
    assert got == pytest.approx({i: plain_average(t, table, bias) for i, t in enumerate(texts)} | {None: plain_average("a", table, bias)})
    assert subword_classifier.score(docs.limit(0), (table, bias)).count() == 0
    many = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "concat('w', id) AS text")
    assert sorted(r.doc_id for r in subword_classifier.score(many, (table, bias)).collect()) == list(range(3000))


def test_training_lowers_the_loss_by_gradients():
    rows = list(corpus(120))
    bags, labels = [subword_classifier.bag(t) for _, t, _ in rows], np.array([q for _, _, q in rows])
    table, bias = subword_classifier.train(bags, labels)
    said = np.array([w @ table[ids] for ids, w in bags]) + bias
    assert ((said >= 0) == (labels == 1)).mean() > 0.97


def test_repeated_ids_and_labels(spark):
    docs = spark.createDataFrame([(1, "good river"), (1, "good river two"), (2, "bad### spam"), (None, "x")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, None), (3, 1), (None, 1)], "doc_id long, quality int")
    model = subword_classifier.fit(docs, labels)
    got = subword_classifier.score(docs, model).collect()
    assert len(got) == 12 and {r.doc_id: r.score >= 0.5 for r in got if r.doc_id} == {1: True, 2: False}


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in subword_classifier.score(docs, subword_classifier.fit(docs, labels)).collect()] == [0.5, 0.5]
