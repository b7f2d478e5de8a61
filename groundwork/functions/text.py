"""Column functions on texts, and the word lists of the checks. Every list is only a default: the operators take others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which rows pass, so they must be these.
HEDGES = ("might", "unclear", "depends", "possibly", "may be", "not sure", "ambiguous")
PRONOUN_START = r"(?i)^\s*(it|this|that|they)\b"
PRIOR_TURN = ("previous question", "earlier you said", "as you mentioned")
CONFIDENT = ("yes it is", "clearly", "definitely", "the answer is", "without doubt")
ESCALATION = ("escalate", "seek", "inform", "confirm with", "legal")
AMBIGUITY_TYPES = ("silent", "vague_language", "external_deferral", "multi_rule_conflict")
SILENCE = ("as per", "per rbi", "per npci", "as determined", "in accordance with", "may suspend", "may terminate", "from time to time", "reasonable")
DEFERRAL = ("per rbi", "per npci", "as per", "in accordance with")
VAGUE = ("reasonable", "as determined", "from time to time")
CLAIM = r"(?i)\b\d+\s*(?:days?|working days?|%|percent|hours?)\b"
ANCHOR = r"(?i)\b\d+\s*(days?|%|percent|hours?|working\s+days?)\b"
# End of the fixed values.


def escalation_words(provider: str) -> tuple[str, ...]:
    """The words of an answer that sends on: the fixed ones, and to contact the provider, whose name belongs to the source texts."""
    return (*ESCALATION, f"contact {provider.lower()}")


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def has_any(text: Column, marks: Sequence[str]) -> Column:
    """Whether the text holds one of the marks as a plain substring."""
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(text, F.lit(m))
    return found


def word_pattern(words: Sequence[str]) -> str:
    return r"\b(" + "|".join(words) + r")\b"


def fold_quotes(text: Column) -> Column:
    """Curly quotes as straight ones."""
    return F.translate(text, "“”‘’", "\"\"''")


def holds_excerpt(text: Column, excerpt: Column) -> Column:
    """Whether the text holds the excerpt once quotes are folded; an empty or missing excerpt is held by any text."""
    return F.contains(fold_quotes(text), fold_quotes(F.coalesce(excerpt, F.lit(""))))


def question_key(question: Column) -> Column:
    """Letters, digits and underscores of the lower-cased question, one space between runs: equal questions have equal keys."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(question, F.lit(""))), r"[^\p{L}\p{N}_]+", " "))


def token_set(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(key, " "), lambda t: t != ""))


def claims_of(text: Column) -> Column:
    """Numeric claims of a text, as they are written."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CLAIM), F.lit(0))


def seeded(seed: int | str, *cols: str) -> Column:
    """A reproducible random order key."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") for c in cols)), 256)
