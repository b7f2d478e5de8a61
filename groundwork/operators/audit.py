"""Audits of a dataset: verdicts over rounds (round, id, category, verdict), reconciliations, balance and reuse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundwork.functions.text import fold_quotes, text_or_empty
from groundwork.operators.scans import ranged, running_max
from groundwork.operators.validate import cited, near_duplicate_pairs


def audit_pass_rates(verdicts: DataFrame) -> DataFrame:
    """round, category (null: all), n, passed, failed, rate."""
    ok = F.count_if(F.col("verdict") == "pass")
    told = verdicts.groupingSets([["round", "category"], ["round"]], "round", "category").agg(F.count("*").alias("n"), ok.alias("passed"))
    return told.select("round", "category", "n", "passed", (F.col("n") - F.col("passed")).alias("failed"), (F.col("passed") / F.col("n")).alias("rate"))


def audit_delta(verdicts: DataFrame) -> DataFrame:
    """round, category (null: all), passed and change against the round before."""
    rates = audit_pass_rates(verdicts).select("round", "category", "passed")
    return rates.withColumn("change", F.col("passed") - F.lag("passed").over(Window.partitionBy("category").orderBy("round")))


def verdict_flips(verdicts: DataFrame) -> DataFrame:
    """round, id, flip (fixed, broken or new) of rows whose verdict is not that of their round before; an id's first round is new unless it is the first of all."""
    start = verdicts.agg(F.min("round").alias("start"))
    before = F.lag("verdict").over(Window.partitionBy("id").orderBy("round"))
    told = verdicts.withColumn("before", before).join(F.broadcast(start), F.lit(True))  # one row
    flip = F.when(F.col("before").isNull(), F.when(F.col("round") > F.col("start"), "new")).when(F.col("before") != F.col("verdict"), F.when(F.col("verdict") == "pass", "fixed").otherwise("broken"))
    return told.withColumn("flip", flip).where("flip IS NOT NULL").select("round", "id", "flip")


def id_reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """id, side of the ids that stand on one side only."""
    a, b = left.select("id").distinct().withColumn("l", F.lit(1)), right.select("id").distinct().withColumn("r", F.lit(1))
    return a.join(b, "id", "full_outer").where("l IS NULL OR r IS NULL").select("id", F.when(F.col("l").isNull(), "right").otherwise("left").alias("side"))


def id_contiguity(rows: DataFrame) -> DataFrame:
    """category, n, contiguous: whether the category's ids are exactly 1 to n."""
    number = F.try_to_number(F.regexp_extract("id", r"-(\d+)$", 1), F.lit("999999999999")).cast("long")
    told = rows.select("category", number.alias("k")).groupBy("category").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.count_distinct("k").alias("kinds"))
    ok = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("kinds") == F.col("n"))
    return told.select("category", "n", F.coalesce(ok, F.lit(False)).alias("contiguous"))


def category_balance(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """category, have, want, difference over the categories of either side."""
    have = rows.groupBy("category").agg(F.count("*").alias("have"))
    h, w = F.coalesce("have", F.lit(0)), F.coalesce("want", F.lit(0))
    return have.join(expected, "category", "full_outer").select("category", h.cast("long").alias("have"), w.cast("long").alias("want"), (h - w).cast("long").alias("difference"))


def claims_check(claimed: DataFrame, computed: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """category, claimed, mean where they differ by more than the tolerance."""
    return claimed.join(computed, "category").where(F.abs(F.col("claimed") - F.col("mean")) > tolerance).select("category", "claimed", "mean")


def undisclosed_failures(verdicts: DataFrame, reports: DataFrame, id_pattern: str = r"[ABC]-\d+") -> DataFrame:
    """id of failed rows that no report text names: ids are taken out of the texts, so texts are read once and met by an equal key."""
    named = reports.select(F.explode(F.regexp_extract_all("text", F.lit(id_pattern), F.lit(0))).alias("id")).distinct()
    return verdicts.where("verdict = 'fail'").select("id").distinct().join(named, "id", "left_anti")


def seeds_of(rows: DataFrame) -> DataFrame:
    return rows.select("row_id", "category", F.explode("seed_clause_ids").alias("clause_id"))


def section_buckets(rows: DataFrame, clauses: DataFrame, most: int = 1) -> DataFrame:
    """section, n_rows, gap of every section of clauses(clause_id, section): rows seeded there, gap if there are at most `most`."""
    used = seeds_of(rows).join(clauses.select("clause_id", "section"), "clause_id").groupBy("section").agg(F.count_distinct("row_id").alias("n_rows"))
    n = F.coalesce("n_rows", F.lit(0))
    return clauses.select("section").distinct().join(used, "section", "left").select("section", n.alias("n_rows"), (n <= most).alias("gap"))


def topic_distribution(rows: DataFrame, clauses: DataFrame) -> DataFrame:
    """topic, n over the seed clauses of rows."""
    return seeds_of(rows).join(clauses.select("clause_id", "topics"), "clause_id").select(F.explode("topics").alias("topic")).groupBy("topic").agg(F.count("*").alias("n"))


def seed_reuse(rows: DataFrame) -> DataFrame:
    """seeds, n of the unordered seed sets that two rows or more have."""
    return rows.groupBy(F.array_join(F.array_sort("seed_clause_ids"), "|").alias("seeds")).agg(F.count("*").alias("n")).where("n > 1")


def wasted_slots(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """earlier, later, similarity of rows(row_id, seq, question, seed) with the same seed and similar questions."""
    return near_duplicate_pairs(rows.withColumn("cite_key", F.lit("")), ["seed"], least)


def excerpt_places(citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """row_id, place of the citations whose excerpt stands in its clause once quotes are folded; excerpts that overlap, directly or by way of others, share a place.

    Excerpts are placed where they first occur and merged by a scan over ranges, so that a clause that everyone cites need not lie in one task.
    """
    at = F.instr(fold_quotes(F.col("clause_text")), fold_quotes(F.col("excerpt")))
    told = cited(citations, clauses).where(text_or_empty("excerpt") != "").select("row_id", "clause_id", at.alias("start"), F.char_length("excerpt").alias("n")).where("start > 0")
    order = ["start", "end"]
    spans = ranged(told.select("row_id", "clause_id", "start", (F.col("start") + F.col("n") - 1).alias("end")), "clause_id", order)
    reached = running_max(spans, "clause_id", order, "end", "reached", False)
    opens = reached.withColumn("opens", F.when(F.col("reached").isNull() | (F.col("start") > F.col("reached")), F.col("start")))
    return running_max(opens, "clause_id", order, "opens", "island", True).select("row_id", F.concat_ws(":", "clause_id", "island").alias("place")).distinct()


def same_excerpt_slots(rows: DataFrame, citations: DataFrame, clauses: DataFrame, least: float = 0.5) -> DataFrame:
    """earlier, later, similarity of rows(row_id, seq, question) that cite overlapping excerpts and ask similar questions, whatever their seeds; per place, between the first rows of equal questions."""
    placed = rows.select("row_id", "seq", "question", F.lit("").alias("cite_key")).join(excerpt_places(citations, clauses), "row_id")
    return near_duplicate_pairs(placed, ["place"], least).distinct()


def same_excerpt_branches(citations: DataFrame) -> DataFrame:
    """row_id, excerpt that two branches or more cite."""
    return citations.where("branch_pos > 0").groupBy("row_id", "excerpt").agg(F.count_distinct("branch_pos").alias("n")).where("n > 1").select("row_id", "excerpt")


def seed_provenance(rows: DataFrame, origins: DataFrame) -> DataFrame:
    """category, origin, n and share within the category of the rows' seeds; seeds of unknown origin are left out."""
    told = seeds_of(rows).join(origins.select("clause_id", "origin"), "clause_id").groupBy("category", "origin").agg(F.count("*").alias("n"))
    return told.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("category")))


def label_set_check(labels: DataFrame, errors: DataFrame) -> DataFrame:
    """kind (null: all), n, n_injected, n_invalid of labels(row_id, injected) and errors(row_id, errors)."""
    bad = errors.where(F.size("errors") > 0).select("row_id", F.lit(1).alias("bad"))
    told = labels.join(bad, "row_id", "left").groupingSets([["injected"], []], "injected").agg(F.grouping("injected").alias("g"), F.count("*").alias("n"), F.count("injected").alias("n_injected"), F.count("bad").alias("n_invalid"))
    return told.select(F.when(F.col("g") == 1, "all").otherwise(F.coalesce("injected", F.lit("none"))).alias("kind"), "n", "n_injected", "n_invalid")
