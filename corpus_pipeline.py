"""A training corpus from raw documents, stage by stage; each stage's rows are written as Parquet and read again by the next.

    quality        documents that the subword classifier scores under 0.5 go (learned from the labelled rows)
    exact_dedup    of equal texts the longest stays
    near_dedup     of texts whose sets of five-word shingles are similar (0.8 or more; BK-trees over SimHash fingerprints find the candidates), one stays: the smallest id
    decontaminate  documents with a passage of the benchmark go
    encode         token ids of what is left, with the text that they decode to

All stages but the last return the columns of documents. The near-dedup and decontamination stages drop rows, not ids: they give every row a
key of its own, so null and repeated ids cost no other row. Of near copies without any id the first written row stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm import golomb, lexicon, simhash_bk, subword_classifier, winnowing
from groundwork.llm.common import new_path, reading, row_keyed, small_or_shuffled, staged, unused

TOKENIZER = "word_bpe_49k.json"
#: What an encoding worker remembers, beside what workers still hold from the stages before.
ENCODER_BYTES = 32_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier scores 0.5 or more. Null texts count as empty, and these get the model's bias; without labels every row stays."""
    model = subword_classifier.fit(docs, reading(spark, sf_dir, "labels", "doc_id", "quality"))
    name = unused(docs, "score")
    return subword_classifier.score(docs, model, tuple(docs.columns), name=name).where(F.col(name) >= 0.5).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space; null texts count as empty, and of all empty texts one stays."""
    return golomb.without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, of rows without ids the first. Texts without words are never near copies."""
    rows, row = row_keyed(docs)
    linked = staged(simhash_bk.similar_texts(rows, id_col=row), "near-copies")
    groups = linked.union(linked.select("root", "root").distinct()).toDF(row, "near_root")
    n_linked = linked.count()
    told = rows.select(row, F.col("doc_id").alias("given_id")).join(small_or_shuffled(groups, 2 * n_linked), row)
    placed = staged(told.select("near_root", F.struct(F.col("given_id").isNull().alias("no_id"), "given_id", F.col(row).alias("at")).alias("seen")), "near-rows")
    first = placed.groupBy("near_root").agg(F.min("seen").alias("stays"))
    gone = placed.join(small_or_shuffled(first, n_linked), "near_root").where("seen.at <> stays.at").select(F.col("seen.at").alias(row))
    return rows.join(small_or_shuffled(gone, n_linked), row, "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without any window of a benchmark item; null texts have no words and stay."""
    rows, row = row_keyed(docs)
    found = winnowing.contamination(rows, reading(spark, sf_dir, "benchmark", "item_id", "text"), id_col=row)
    hit = staged(found.where("n_hit > 0").select(F.col("doc_id").alias(row)), "contaminated")
    return rows.join(small_or_shuffled(hit, hit.count()), row, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded of every row; null texts have no ids."""
    path = public_tokenizers.path(TOKENIZER)
    return lexicon.encode(docs, path, lexicon.build_lexicon(docs, path), most_bytes=ENCODER_BYTES)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; every stage's rows stand in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
