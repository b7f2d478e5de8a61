"""Quality classifier on supervised subword embeddings.

A text is its words; a word is itself and its character n-grams (of the word between < and >), each hashed to one of BUCKETS
learned vectors. A word that repeats the word before it adds one more feature, the same for all words. The vectors are averaged over the text and a softmax layer gives the class. Training is stochastic
gradient descent in numpy, on at most TRAIN_DOCS labelled rows (the bound is that parameter; the rows are those with the
smallest hashes of their ids; of rows that repeat an id, that of the first text), each at most BUCKETS + 1 numbers. As the output is linear in the average, scoring sends one number per bucket to
the executors and adds up numbers per distinct word.

Null texts count as empty; a text without words gets the score of the output layer's bias. Null ids are scored, and
never learned from. Labels other than 0 and 1 are ignored; where an id is labelled twice, the larger label counts. Without
labels of both kinds, the score is 0.5 plus nothing learned: all texts score alike.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import byte_slices, crc_of_id, freed, held, unused

BUCKETS, SIZE, GRAMS = 1 << 18, 16, (3, 4, 5)
#: The feature of a repeated word; the hashed features have the buckets before it.
REPEAT = BUCKETS
TRAIN_DOCS = 6_000
EPOCHS, RATE = 8, 0.5
#: Bytes of text that a task looks at together, and words whose features are made together.
SLICE_BYTES, SLICE_WORDS = 500_000, 10_000


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, bucket) of each feature of the words."""
    wholes = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    places, buckets = [np.arange(len(words))], [wholes]
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    for n in GRAMS:
        if len(codes) < n:
            continue
        inside = owner[: len(codes) - n + 1] == owner[n - 1 :]
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
        places.append(owner[: len(codes) - n + 1][inside])
        buckets.append(h[inside] >> np.uint64(17))
    return np.concatenate(places), (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares of its features."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    distinct: dict[str, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    place, bucket = features(list(distinct))
    weight = np.array(list(distinct.values()), np.float64)[place]
    bucket, weight = np.append(bucket, REPEAT), np.append(weight, sum(map(eq, words, words[1:])))
    kinds, inverse = np.unique(bucket, return_inverse=True)
    return kinds, (np.bincount(inverse, weight) / weight.sum()).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Per bucket the difference of the two classes' outputs, and their bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS + 1, SIZE)).astype(np.float32)
    out, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS + 1, np.float32), 0.0
    scale = [np.float32(1 / max(float(np.sqrt((w * w).sum())), 1e-6)) for _, w in bags]
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)).tolist():
            ids, w = bags[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            mean = w @ vectors[ids] if len(ids) else np.zeros(SIZE, np.float32)
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p) * 4
            bias -= rate * p * np.float32(0.1)
            if len(ids):
                vectors[ids] -= (rate * scale[i] * w)[:, None] * back[None, :]
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS, learn_from=None) -> tuple[np.ndarray, float]:
    """Train on the texts of at most `most` labelled ids; learn_from: a condition on id_col that they must meet."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if learn_from is not None:
        known = known.where(learn_from)
    sample = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(most)

    def run(batches):
        freed()
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                found = [bag(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))], names=["label", "buckets", "shares"])

    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample), id_col).groupBy(id_col, "label").agg(F.min("text").alias("text"))
    rows = texts.select("label", "text").mapInArrow(run, "label int, buckets array<int>, shares array<float>").toArrow()
    bags = [(b.values.to_numpy(), s.values.to_numpy()) for b, s in zip(rows["buckets"], rows["shares"], strict=True)]
    order = sorted(range(len(bags)), key=lambda i: (len(bags[i][0]), bags[i][0][:8].tolist(), bags[i][1][:8].tolist()))
    model = train([bags[i] for i in order], rows["label"].to_numpy()[order])
    del rows, bags
    freed()
    return model


class FeatureCounts(dict):
    """How many features a word of a number of characters has: itself and its n-grams."""

    def __missing__(self, length: int) -> int:
        self[length] = 1 + sum(max(0, length + 3 - n) for n in GRAMS)
        return self[length]


class Scorer:
    """Scores texts, remembering the sums of about `most` words and those of the last texts.

    Half of them are the words wanted last; when that is full it becomes the older half, of which only what is wanted again is taken over.
    """

    def __init__(self, table: np.ndarray, bias: float, most: int = 100_000, longest: int = 100):
        self.table, self.bias, self.most, self.longest = table.astype(np.float64), bias, most, longest
        self.sums: dict[str, float] = {}
        self.older: dict[str, float] = {}
        self.passing: list[str] = []
        self.counts = FeatureCounts()

    def scores(self, texts: list[str]) -> list[float]:
        for w in self.passing:
            del self.sums[w]
        if len(self.sums) > self.most // 2:
            self.older, self.sums = self.sums, {}
        cut = [t.split() for t in texts]
        words: set[str] = set()
        for c in cut:
            words.update(c)
        words.difference_update(self.sums)
        self.sums.update((w, self.older[w]) for w in words.intersection(self.older))
        unseen = list(words.difference(self.older))
        self.passing = [w for w in unseen if len(w) > self.longest]
        for at in range(0, len(unseen), SLICE_WORDS):
            part = unseen[at : at + SLICE_WORDS]
            place, bucket = features(part)
            self.sums.update(zip(part, np.bincount(place, self.table[bucket], len(part)).tolist(), strict=True))
        total, count = self.sums.__getitem__, self.counts.__getitem__
        again = [sum(map(eq, c, c[1:])) for c in cut]
        mark = float(self.table[REPEAT])
        z = np.array([(sum(map(total, c)) + r * mark) / (sum(map(count, map(len, c))) + r) if c else 0.0 for c, r in zip(cut, again, strict=True)]) + self.bias
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).tolist()


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", name: str = "score") -> DataFrame:
    """keep columns of docs and `name` (double, 0 to 1: class 1 likelier; not one of keep) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number a bucket: 1 MB
    mark = hash((model[0].tobytes(), model[1]))
    out = docs.select(*keep).withColumn(name, F.lit(0.0)).schema
    kept = docs.select(*keep) if text_col in keep else docs.select(*keep, F.col(text_col).alias(unused(docs, "text_to_score")))
    at_text = kept.columns.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        scorer = held(("scorer", mark), lambda: Scorer(*shared.value))
        for batch in batches:
            for part in byte_slices(batch, at_text, SLICE_BYTES):
                found = scorer.scores([t or "" for t in part.column(at_text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(found, pa.float64())], names=[*keep, name])

    return kept.mapInArrow(run, out)


def held_out(id_col: str = "doc_id"):
    """Rows never learned from: the id's CRC-32 leaves 1 when divided by 3."""
    return crc_of_id(id_col) % 3 == 1
