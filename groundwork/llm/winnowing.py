"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text is its words: runs of digits, a-z (A-Z lower-cased) and all characters beyond ASCII. An item's window is WINDOW
consecutive words of it; an item of fewer words (but not none) is one window. A document word that lies in any occurrence of a
window is hit.

Winnowing keeps, of the K-word hashes in each window of WINDOW words, the least. Equal windows have equal least hashes, so every
span of WINDOW words that a document shares with an item shares a fingerprint: none is missed. Distinct fingerprints are joined
with those of the items; in the documents hit, each is then extended over all windows that it stands for, and each of these is compared
word by word (as text) with the items' windows, so no hash collision counts. Items shorter than a window are found by the hash of their whole length.

Null texts have no words: such documents have zeros, such items match nothing. Equal ids stay separate rows; equal item
ids count once. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import small_or_shuffled, staged

WINDOW, K = 10, 5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """The words of a text joined by single spaces."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), _BREAKS, " "))


def words_of(plain: Column) -> Column:
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def least_hashes(df: DataFrame, words: str = "words", window: int = WINDOW, k: int = K) -> DataFrame:
    """Adds `least` to the rows of at least window words: for each window, in order, the least of its k-word hashes."""
    hashed = df.where(F.size(words) >= window).withColumn("one", F.transform(words, lambda w: F.xxhash64(w)))
    one, grams = F.col("one"), F.col("grams")
    grammed = hashed.withColumn("grams", F.transform(F.sequence(F.lit(0), F.size("one") - k), lambda i: F.xxhash64(*(F.get(one, i + j) for j in range(k)))))
    return grammed.withColumn("least", F.transform(F.sequence(F.lit(0), F.size("grams") - (window - k + 1)), lambda i: F.least(*(F.get(grams, i + j) for j in range(window - k + 1))))).drop("one", "grams")


def fingerprints(df: DataFrame, key: str, words: str = "words", window: int = WINDOW, k: int = K) -> DataFrame:
    """key and hash: the distinct least hashes of each row's windows."""
    return least_hashes(df.select(key, words), words, window, k).select(key, F.explode(F.array_distinct("least")).alias("hash"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """Every distinct window text of the items, its length in words, its hash for the join and the ids of the items that have it."""
    split = items.select(F.col(id_col).alias("item_id"), plain_words(F.col(text_col)).alias("plain")).where("plain <> ''").select("item_id", F.split("plain", " ").alias("words"))
    n = F.least(F.size("words"), F.lit(window))
    w = F.col("words")
    cut = split.withColumn("n", n).withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1))).select("item_id", "n", F.slice(w, F.col("at"), F.col("n")).alias("words"))
    return cut.groupBy("n", "words").agg(F.collect_set("item_id").alias("items"))


def hits(docs: DataFrame, windows: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """key, n, hash: the fingerprints of docs(key, words) that some window of n words has; n under window for shorter items."""
    long = least_hashes(windows.where(F.col("n") == window).select("words"), "words", window, k).select(F.get("least", F.lit(0)).alias("hash")).distinct()
    long = staged(long, "item-fingerprints")
    found = fingerprints(docs, "key", "words", window, k).join(small_or_shuffled(long, long.count()), "hash", "left_semi").select("key", F.lit(window).alias("n"), "hash")
    for n in short_lengths(windows, window):
        short = staged(windows.where(F.col("n") == n).select(F.xxhash64("words").alias("hash")).distinct(), "short-items")
        grams = gram_hashes(docs, n).select("key", F.explode(F.array_distinct("grams")).alias("hash"))
        found = found.union(grams.join(small_or_shuffled(short, short.count()), "hash", "left_semi").select("key", F.lit(n).alias("n"), "hash"))
    return found


def short_lengths(windows: DataFrame, window: int) -> list[int]:
    """The lengths of items under a window: fewer than `window` numbers."""
    return [r.n for r in windows.where(F.col("n") < window).select("n").distinct().orderBy("n").collect()]


def gram_hashes(df: DataFrame, n: int) -> DataFrame:
    """Adds `grams`, the hashes of each n consecutive words, to the rows of at least n words."""
    w = F.col("words")
    return df.where(F.size("words") >= n).withColumn("grams", F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.xxhash64(F.slice(w, i, n))))


def extended(near: DataFrame, n: int, window: int, k: int) -> DataFrame:
    """key, at, words: every window of n words of near(key, words, found) whose fingerprint is in found (structs of n and hash)."""
    hashed = least_hashes(near, "words", window, k) if n == window else gram_hashes(near, n).withColumnRenamed("grams", "least")
    picked = hashed.withColumn("mine", F.transform(F.filter("found", lambda f: f["n"] == n), lambda f: f["hash"]))
    w, least, mine = F.col("words"), F.col("least"), F.col("mine")
    placed = picked.withColumn("at", F.filter(F.sequence(F.lit(1), F.size("least")), lambda i: F.array_contains(mine, F.get(least, i - 1))))
    spans = F.transform("at", lambda i: F.struct(i.alias("at"), F.slice(w, i, n).alias("words")))
    return placed.select("key", F.explode(spans).alias("span")).select("key", "span.at", "span.words")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit (words in occurrences of windows), items (sorted array of the ids, as strings)."""
    text = staged(docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("doc_id"), plain_words(F.col(text_col)).alias("plain")).withColumn("n_words", F.when(F.col("plain") == "", 0).otherwise(F.length("plain") - F.length(F.replace("plain", F.lit(" "))) + 1).cast("long")), "plain-words")
    windows = staged(item_windows(items, item_id_col, item_text_col, window), "item-windows")
    worded = text.select("key", words_of(F.col("plain")).alias("words"))
    found = staged(hits(worded, windows, window, k), "hits")
    n_found = found.count()
    by_doc = found.groupBy("key").agg(F.collect_set(F.struct("n", "hash")).alias("found"))
    near = text.select("key", "plain").join(small_or_shuffled(by_doc, n_found), "key").select("key", "found", F.split("plain", " ").alias("words"))
    spans = extended(near, window, window, k)
    for n in short_lengths(windows, window):
        spans = spans.union(extended(near, n, window, k))
    size = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.array_join("words", " ")) + 24 * F.size("items")), F.lit(0)).alias("bytes")).first()
    verified = spans.join(small_or_shuffled(windows.select("words", "items", "n"), size.n, size.bytes), "words").select("key", "at", "n", "items")
    found_by_doc = verified.groupBy("key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1))))).cast("long").alias("n_hit"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda i: i.cast("string"))).alias("items"),
    )
    return text.select("key", "doc_id", "n_words").join(found_by_doc, "key", "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
