"""Agreement of two raters. Ratings are row_id, dim, score; pairs are row_id, dim, a, b."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions.text import seeded
from groundwork.operators.greedy import smallest

# The dimensions in which each injected fault must show.
CATCHES: Mapping[str, Sequence[str]] = {
    "wrong_citation": ("citation_accuracy.clause_id_correct_scope",),
    "paraphrase_not_verbatim": ("citation_accuracy.excerpt_is_verbatim",),
    "vague_clarifier": ("clarifier_quality.not_vague", "clarifier_quality.specificity"),
    "confident_in_C": ("ambiguity_framing.avoids_confident_answer",),
    "no_escalation_in_C": ("ambiguity_framing.recommends_escalation",),
}
# End of the fixed values.


def score_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Ratings of both on the same row and dimension; what only one has rated is left out."""
    return first.select("row_id", "dim", F.col("score").alias("a")).join(second.select("row_id", "dim", F.col("score").alias("b")), ["row_id", "dim"])


def kappa(k: int = 5) -> Column:
    """Quadratic-weighted kappa of columns a and b as one aggregate, in closed form; ratings outside 1 to k count in n alone; 0.0 without spread.

    With weights (i - j)^2 the expected disagreement needs only the sums of the ratings and their squares.
    """
    inside = F.col("a").between(1, k) & F.col("b").between(1, k)

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0)).cast("double")

    observed = total((F.col("a") - F.col("b")) * (F.col("a") - F.col("b")), inside)
    n = total(F.lit(1), inside)
    sa, sb = total(F.col("a"), inside), total(F.col("b"), inside)
    qa, qb = total(F.col("a") * F.col("a"), inside), total(F.col("b") * F.col("b"), inside)
    expected = (qa * n + qb * n - 2 * sa * sb) / F.count("*")
    return F.when((F.count("*") == 0) | (expected == 0), F.lit(0.0)).otherwise(1 - observed / expected)


def agreement(pairs: DataFrame) -> DataFrame:
    """dim, exact, within_1 (shares, 3 decimals), kappa (3 decimals), n: one pass with partial sums."""
    near = F.abs(F.col("a") - F.col("b"))
    return pairs.groupBy("dim").agg(F.round(F.avg((near == 0).cast("int")), 3).alias("exact"), F.round(F.avg((near <= 1).cast("int")), 3).alias("within_1"), F.round(kappa(), 3).alias("kappa"), F.count("*").alias("n"))


def quadratic_kappa(pairs: DataFrame, k: int = 5) -> DataFrame:
    return pairs.groupBy("dim").agg(kappa(k).alias("kappa"), F.count("*").alias("n"))


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("dim", "a", "b").agg(F.count("*").alias("n"))


def catch_rate(labels: DataFrame, scores: DataFrame, catches: Mapping[str, Sequence[str]] = CATCHES, low: int = 2) -> DataFrame:
    """n, n_caught, rate over labels(row_id, injected) with a fault; a missing score counts as 5, an unknown kind is never caught; 0.0 if there are none."""
    pairs = [(kind, dim) for kind, dims in catches.items() for dim in dims]
    targets = F.broadcast(labels.sparkSession.createDataFrame(pairs, "injected string, dim string"))  # as many rows as the parameter has
    looked = labels.where("injected IS NOT NULL").join(targets, "injected", "left").join(scores.select("row_id", "dim", "score"), ["row_id", "dim"], "left")
    caught = looked.groupBy("row_id").agg((F.min(F.coalesce("score", F.lit(5))) <= low).alias("caught"))
    return caught.agg(F.count("*").alias("n"), F.count_if("caught").alias("n_caught")).withColumn("rate", F.when(F.col("n") == 0, 0.0).otherwise(F.col("n_caught") / F.col("n")))


def sample_rows(rows: DataFrame, share: float, seed: int | str, id_col: str = "row_id") -> DataFrame:
    """max(1, floor(n * share)) rows at random, the same for the same seed; selected where they are, by narrowing down the last one's draw."""
    return smallest(rows.withColumn("__draw", seeded(seed, id_col)), "__draw", [id_col], max(1, int(rows.count() * share))).drop("__draw")


def disagreements(pairs: DataFrame, least: int = 2) -> DataFrame:
    return pairs.where(F.abs(F.col("a") - F.col("b")) >= least)


def cross_rater(pairs: DataFrame, sample: DataFrame) -> DataFrame:
    """dim, kappa (3 decimals), n and n_apart (pairs that differ by 2 or more) of two raters over the rows of sample(row_id)."""
    told = pairs.join(sample.select("row_id").distinct(), "row_id", "left_semi")
    return told.groupBy("dim").agg(F.round(kappa(), 3).alias("kappa"), F.count("*").alias("n"), F.count_if(F.abs(F.col("a") - F.col("b")) >= 2).alias("n_apart"))
