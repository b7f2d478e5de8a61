"""Choice of the clauses that questions are made from, and the prompts for them. Random orders are hashes of a seed and the id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions.text import ANCHOR, DEFERRAL, SILENCE, VAGUE, has_any, seeded, text_or_empty
from groundwork.operators.greedy import capped_pairs
from groundwork.operators.retrieve import pairs_by_shared_topic, silence_candidates


def numeric_anchors(clauses: DataFrame, n: int, seed: int | str, excluded: DataFrame | None = None) -> DataFrame:
    """n clauses with a number of days, hours or percent, in random order; if there are fewer than n, all clauses are in the draw."""
    pool = clauses if excluded is None else clauses.join(excluded.select("clause_id").distinct(), "clause_id", "left_anti")
    numeric = pool.where(text_or_empty("verbatim_text").rlike(ANCHOR))
    draw = numeric if numeric.limit(n).count() >= n else pool
    return draw.withColumn("draw", seeded(seed, "clause_id")).orderBy("draw").limit(n)


def scored_pairs(clauses: DataFrame, seed: int | str, excluded: DataFrame | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Pairs by shared topics in order of the greedy choice: most shared topics first, then at random; excluded(a, b) are unordered."""
    pairs = pairs_by_shared_topic(clauses, scope=scope)
    if excluded is not None:
        known = excluded.select(F.array_sort(F.array("a", "b")).alias("ends")).distinct()
        pairs = pairs.withColumn("ends", F.array_sort(F.array("first_id", "second_id"))).join(known, "ends", "left_anti").drop("ends")
    return pairs.withColumn("draw", seeded(seed, "first_id", "second_id"))


def pair_selection(clauses: DataFrame, n: int, seed: int | str, excluded: DataFrame | None = None, cap: int = 2, scope: Sequence[str] = ()) -> DataFrame:
    """a, b of the first n pairs in order, no clause being used more than cap times."""
    ranked = scored_pairs(clauses, seed, excluded, scope).select(F.col("first_id").alias("a"), F.col("second_id").alias("b"), F.struct((-F.col("n_shared")).alias("s"), "draw").alias("rank"))
    return capped_pairs(ranked, cap, n).select("a", "b")


def ambiguity_hint(text: Column) -> Column:
    low = F.lower(text)
    return F.when(has_any(low, DEFERRAL), "external_deferral").when(has_any(low, VAGUE), "vague_language").otherwise("silent")


def ambiguity_seeds(clauses: DataFrame, n: int, seed: int | str, excluded: DataFrame | None = None, marks: Sequence[str] = SILENCE) -> DataFrame:
    """clause_id, hint of n clauses that leave something open, in random order; others, tagged silent, fill up."""
    pool = clauses if excluded is None else clauses.join(excluded.select("clause_id").distinct(), "clause_id", "left_anti")
    marked = silence_candidates(pool, marks).select("clause_id").distinct().withColumn("open", F.lit(True))
    tagged = pool.join(marked, "clause_id", "left").withColumn("fill", F.col("open").isNull().cast("int"))
    hint = F.when(F.col("fill") == 1, "silent").otherwise(ambiguity_hint(text_or_empty("verbatim_text")))
    return tagged.withColumn("draw", seeded(seed, "clause_id")).orderBy("fill", "draw").limit(n).select("clause_id", hint.alias("hint"))


def seed_exclusions(rows: DataFrame) -> DataFrame:
    """category and key: what kept rows(category, seed_clause_ids) have used: the first seed, for B the unordered first two."""
    s = F.col("seed_clause_ids")
    key = F.when(F.col("category") == "B", F.when(F.size(s) >= 2, F.array_join(F.array_sort(F.slice(s, 1, 2)), "|"))).when(F.size(s) >= 1, F.get(s, F.lit(0)))
    return rows.select("category", key.alias("key")).where("key IS NOT NULL").distinct()


def deficits(rows: DataFrame, categories: DataFrame, target: int, factor: float = 2.5, first_factor: float = 1.5) -> DataFrame:
    """category, have, need, attempts (of a top-up) and first_run (attempts of a first run) for every category, with rows or not."""
    have = rows.groupBy("category").agg(F.count("*").alias("have"))
    need = F.greatest(F.lit(0), F.lit(target) - F.coalesce("have", F.lit(0)))
    return categories.select("category").join(have, "category", "left").select("category", F.coalesce("have", F.lit(0)).alias("have"), need.alias("need"), F.greatest(need * 2, F.floor(need * factor)).alias("attempts"), F.ceil(F.lit(target * first_factor)).alias("first_run"))


def render(template: Column, values: Mapping[str, Column]) -> Column:
    """The template with each {key} replaced in the mapping's order; null is empty, unknown keys stay, and what is put in may hold a later key."""
    out = template
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out
