"""Checks of question-and-answer rows. Rows are flat: row_id, seq, category, question, answer, ...; their citations are a table
row_id, branch_pos (0 for the row's own), cite_pos, clause_id, excerpt; answer branches are row_id, branch_pos, answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions.text import AMBIGUITY_TYPES, CONFIDENT, HEDGES, PRIOR_TURN, PRONOUN_START, claims_of, escalation_words, has_any, holds_excerpt, question_key, text_or_empty, token_set, word_pattern
from groundwork.operators.alike import similar_sets
from groundwork.operators.greedy import first_fit, written

#: So many rows of a counted join side are broadcast; more are shuffled.
BROADCAST_ROWS = 500_000


def flatten_citations(rows: DataFrame) -> DataFrame:
    """The citations table of nested rows(row_id, clause_citations, answer_branches)."""
    cite = "transform(coalesce({0}, array()), (c, i) -> struct({1} as branch_pos, i as cite_pos, c.clause_id as clause_id, c.verbatim_excerpt as excerpt))"
    own = cite.format("clause_citations", "0")
    branches = "flatten(transform(coalesce(answer_branches, array()), (b, j) -> " + cite.format("b.clause_citations", "j + 1") + "))"
    return rows.select("row_id", F.explode(F.expr(f"concat({own}, {branches})")).alias("c")).select("row_id", "c.branch_pos", "c.cite_pos", "c.clause_id", "c.excerpt")


def cited(citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """Citations with the text of their clause; null where the id is unknown. Spark broadcasts the clauses if they are small, else splits hot ones."""
    return citations.join(clauses.select("clause_id", F.col("verbatim_text").alias("clause_text")), "clause_id", "left")


def citation_facts(citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """row_id, n_own, bad (the first failing citation, the row's own before those of branches) and cited_text (lower-case texts of the row's own
    known citations): one join and one aggregation for all checks. What a row cites is gathered, as that row is one value."""
    shown = F.coalesce("clause_id", F.lit("null"))
    bad = F.when(F.col("clause_text").isNull(), F.concat(F.lit("unknown clause "), shown)).when(~holds_excerpt(F.col("clause_text"), F.col("excerpt")), F.concat(F.lit("excerpt not in "), shown))
    own = F.col("branch_pos") == 0
    known = F.when(own & F.col("clause_text").isNotNull(), F.struct("cite_pos", F.lower("clause_text").alias("t")))
    told = cited(citations, clauses).withColumn("bad", bad).groupBy("row_id")
    facts = told.agg(F.count_if(own).alias("n_own"), F.min_by("bad", F.when(F.col("bad").isNotNull(), F.struct("branch_pos", "cite_pos"))).alias("bad"), F.array_sort(F.collect_list(known)).alias("texts"))
    return facts.select("row_id", "n_own", "bad", F.array_join(F.transform("texts", lambda c: c["t"]), " ").alias("cited_text"))


def branch_facts(branches: DataFrame) -> DataFrame:
    """row_id, n_branches and branch_answers of branches(row_id, answer)."""
    return branches.groupBy("row_id").agg(F.count("*").alias("n_branches"), F.collect_list("answer").alias("branch_answers"))


def citations_reason() -> Column:
    """Of rows with citation_facts; null if all citations are right."""
    return F.when((F.col("category") == "A") & (F.coalesce("n_own", F.lit(0)) == 0), "no citation").otherwise(F.col("bad"))


def grounding_reason() -> Column:
    """Of rows with citation_facts and branch_facts: numeric claims of the answer and its branches that no cited text holds, or null."""
    said = F.concat(F.array("answer"), F.coalesce("branch_answers", F.array().cast("array<string>")))
    claims = F.array_distinct(F.flatten(F.transform(said, lambda t: F.transform(claims_of(t), F.lower))))
    loose = F.sort_array(F.filter(claims, lambda c: ~F.contains(F.coalesce("cited_text", F.lit("")), c)))
    return F.when(F.size(loose) > 0, F.concat(F.lit("not in cited text: "), F.array_join(loose, ", ")))


def check_citations(rows: DataFrame, citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """row_id, citations_reason: the first failing citation, the row's own before those of branches; null if all are right. A null clause id is unknown."""
    return rows.select("row_id", "category").join(citation_facts(citations, clauses), "row_id", "left").select("row_id", citations_reason().alias("citations_reason"))


def check_grounding(rows: DataFrame, branches: DataFrame, citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """row_id, grounding_reason: numeric claims of the answer and its branches that no cited text holds (the row's own citations only), or null."""
    told = rows.select("row_id", "answer").join(citation_facts(citations, clauses), "row_id", "left").join(branch_facts(branches), "row_id", "left")
    return told.select("row_id", grounding_reason().alias("grounding_reason"))


def self_containment_reason(question: Column, phrases: Sequence[str] = PRIOR_TURN) -> Column:
    q = F.coalesce(question, F.lit(""))
    return F.when(q.rlike(PRONOUN_START), "starts with a pronoun").when(has_any(F.lower(q), phrases), "refers to an earlier turn")


def struct_a_reason(n_own: Column, answer: Column, hedges: Sequence[str] = HEDGES) -> Column:
    low = F.lower(F.coalesce(answer, F.lit("")))
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(low, F.lit(word_pattern(hedges)), F.lit(1))))
    return F.when(F.coalesce(n_own, F.lit(0)) < 1, "no citation").when(F.size(found) > 0, F.concat(F.lit("hedges: "), F.array_join(found, ", ")))


def struct_b_reason(clarifier: Column, axis: Column, n_branches: Column) -> Column:
    c, a = F.lower(F.coalesce(clarifier, F.lit(""))), F.lower(F.coalesce(axis, F.lit("")))
    named = F.contains(c, F.replace(a, F.lit("_"), F.lit(" "))) | F.exists(F.split(a, "_"), lambda t: F.contains(c, t))
    return F.when(F.trim(c) == "", "no clarifying question").when(F.trim(a) == "", "no axis").when(~named, "axis not named").when(F.coalesce(n_branches, F.lit(0)) < 2, "fewer than 2 branches")


def struct_c_reason(ambiguity_type: Column, answer: Column, escalate: Column, provider: str, confident: Sequence[str] = CONFIDENT, types: Sequence[str] = AMBIGUITY_TYPES) -> Column:
    low = F.lower(F.coalesce(answer, F.lit("")))
    return (
        F.when(ambiguity_type.isNull(), "no ambiguity")
        .when(~ambiguity_type.isin(*types), "unknown ambiguity type")
        .when(has_any(low, confident), "confident answer")
        .when(~F.coalesce(escalate, F.lit(False)), "no escalation flag")
        .when(~has_any(low, escalation_words(provider)), "no escalation words")
    )


def exact_duplicates(rows: DataFrame, scope: Sequence[str]) -> DataFrame:
    """row_id, first_id of rows whose question key an earlier row of the same scope has."""
    keyed = rows.select(*scope, "row_id", "seq", question_key(F.col("question")).alias("key"))
    firsts = keyed.groupBy(*scope, "key").agg(F.min(F.struct("seq", "row_id")).alias("first"))
    return keyed.join(firsts, [*scope, "key"]).where("seq > first.seq").select("row_id", F.col("first.row_id").alias("first_id"))


def question_sets(rows: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, cite_key, row_id, seq, key (a hash of the scope and the question's key), block (of scope and cite_key), words (distinct, sorted, joined) and set: equal where block and words are; null without words."""
    scoped = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in scope]
    digest = lambda *parts: F.left(F.sha2(F.concat_ws("\x1f", *parts), 256), F.lit(32))
    key = question_key(F.col("question"))
    told = rows.select(*scope, "cite_key", "row_id", "seq", key.alias("key"), F.array_join(F.array_sort(token_set(key)), " ").alias("words"))
    told = told.withColumns({"key": digest(*scoped, F.lit(":"), F.col("key")), "block": digest(*scoped, F.coalesce("cite_key", F.lit("")))})
    return told.withColumn("set", F.when(F.col("words") != "", digest(F.col("block"), F.col("words"))))


def numbered_sets(sets: DataFrame) -> DataFrame:
    """set, first (seq, row_id, at) and number (text) of the first row of each set of question_sets that are written with at, the rows' numbers."""
    firsts = sets.where("set IS NOT NULL").groupBy("set").agg(F.min(F.struct("seq", "row_id", "at")).alias("first"))
    return written(firsts.withColumn("number", F.col("first.at").cast("string")), "first-rows")


def near_sets(sets: DataFrame, firsts: DataFrame, least: float = 0.8) -> DataFrame:
    """a, b (at of their first rows) and similarity of different sets of one block with that Jaccard or more; firsts: numbered_sets(sets).

    Only rows that are no set's first are told apart by a join, as there are fewer of them.
    """
    held = sets.where("set IS NOT NULL")
    copies = written(held.select("at").join(firsts.select("first.at"), "at", "left_anti"), "set-copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    return written(similar_sets(held.join(copies, "at", "left_anti").select("at", "block", "words"), least), "similar-sets")


def _written_sets(rows: DataFrame) -> DataFrame:
    return written(rows.withColumn("at", F.monotonically_increasing_id()), "question-sets")


def near_duplicate_pairs(rows: DataFrame, scope: Sequence[str], least: float = 0.8) -> DataFrame:
    """earlier, later (row ids) and similarity of near-duplicate questions, between the first rows of each distinct set; copies of a set are not expanded."""
    sets = _written_sets(question_sets(rows, scope))
    firsts = numbered_sets(sets)
    f1, f2 = (firsts.select(F.col("first.at").alias(at), F.struct("first.seq", "first.row_id").alias(f)) for at, f in (("a", "f1"), ("b", "f2")))
    pairs = near_sets(sets, firsts, least).join(f1, "a").join(f2, "b")
    return pairs.select(F.least("f1", "f2")["row_id"].alias("earlier"), F.greatest("f1", "f2")["row_id"].alias("later"), "similarity")


def dedupe_rows(rows: DataFrame, scope: Sequence[str], least: float = 0.8) -> DataFrame:
    """seq of the rows that an earlier registered row of their scope makes a duplicate (same key, or same citations and near key).

    A duplicate is not registered, so it knocks out nothing. Copies in both key and citations are all dropped but the first, which stands for them. Rows may have
    needs, the seq of an earlier row without needs: they come in only if that one is a duplicate.
    """
    same = [*scope, "key", "cite_key"]
    conditional = "needs" in rows.columns
    sets = question_sets(rows, scope)
    sets = _written_sets(sets.join(rows.where("needs IS NOT NULL").select("seq", "needs"), "seq", "left") if conditional else sets)
    firsts = numbered_sets(sets)
    told = sets.join(firsts.select("set", "number"), "set", "left").drop("words", "set").withColumnRenamed("number", "set")
    sure = told.where("needs IS NULL") if conditional else told
    nodes = sure.groupBy(*same).agg(F.min("seq").alias("seq"), F.first("set").alias("set"))
    if conditional:
        nodes = written(nodes, "first-copies")
    copies = sure.select("seq").join(nodes.select("seq"), "seq", "left_anti")
    if conditional:
        copies = written(copies, "copies")
        if_dropped = told.where("needs IS NOT NULL").join(copies.select(F.col("seq").alias("needs"), F.lit(True).alias("copy")), "needs", "left")
        needs = F.when(F.col("copy").isNull(), F.col("needs")).alias("needs")
        nodes = nodes.withColumn("needs", F.lit(None).cast("long")).unionByName(if_dropped.select(*same, "seq", "set", needs))
    near = near_sets(sets, firsts, least).select(F.col("a").cast("string").alias("s1"), F.col("b").cast("string").alias("s2"))
    out = first_fit(nodes.select("seq", "key", "set", *(["needs"] if conditional else [])), near.union(near.select("s2", "s1")))
    return out.union(copies)


def validate_rows(rows: DataFrame, branches: DataFrame, citations: DataFrame, clauses: DataFrame, duplicates: DataFrame, provider: str) -> DataFrame:
    """row_id, category, checks (map of check to ok or fail, in check order), reasons (of failed checks, same order) and passed.

    duplicates(row_id) are the rows that fail the duplicate check; an unknown category has no check of its own; provider: see escalation_words.
    """
    told = rows.drop("n_own", "n_branches").join(citation_facts(citations, clauses), "row_id", "left").join(branch_facts(branches), "row_id", "left")
    told = told.join(duplicates.select("row_id", F.lit("duplicate question").alias("duplicate_reason")).distinct(), "row_id", "left")
    c = F.col("category")
    by_category = F.when(c == "A", struct_a_reason(F.col("n_own"), F.col("answer"))).when(c == "B", struct_b_reason(F.col("clarifying_question"), F.col("clarification_axis"), F.col("n_branches"))).when(c == "C", struct_c_reason(F.col("ambiguity_type"), F.col("answer"), F.col("should_escalate"), provider))
    checks = [("citations", citations_reason()), ("grounding", grounding_reason()), ("self_containment", self_containment_reason(F.col("question"))), ("duplicate", F.col("duplicate_reason"))]
    told = told.withColumn("found", F.array(*(r for _, r in checks), by_category))
    checks = [(n, F.get("found", F.lit(i))) for i, (n, _) in enumerate(checks)]
    by_category = F.get("found", F.lit(len(checks)))
    entries = [F.struct(F.lit(n).alias("k"), F.when(r.isNull(), "ok").otherwise("fail").alias("v")) for n, r in checks]
    last = F.when(c.isin("A", "B", "C"), F.struct(F.concat(F.lit("structure_"), F.lower(c)).alias("k"), F.when(by_category.isNull(), "ok").otherwise("fail").alias("v")))
    reasons = F.array_compact("found")
    out = told.select("row_id", "category", F.map_from_entries(F.array_compact(F.array(*entries, last))).alias("checks"), reasons.alias("reasons"))
    return out.withColumn("passed", F.forall(F.map_values("checks"), lambda v: v == "ok"))


def strict_citation_audit(citations: DataFrame, clauses: DataFrame) -> DataFrame:
    """row_id, branch_pos, cite_pos, code of every citation that fails; quotes are not folded here."""
    unknown, held = F.col("clause_text").isNull(), F.contains(F.col("clause_text"), text_or_empty("excerpt"))
    inside = F.col("branch_pos") > 0
    code = F.when(unknown & inside, "unknown_clause_in_branch").when(unknown, "unknown_clause").when(~held & inside, "branch_excerpt_not_substring").when(~held, "excerpt_not_substring")
    return cited(citations, clauses).select("row_id", "branch_pos", "cite_pos", code.alias("code")).where("code IS NOT NULL")


def retry_merge(attempts: DataFrame) -> DataFrame:
    """row_id, passed, regen_count, feedback of attempts(row_id, attempt, passed, reasons): attempt 2 counts only where attempt 1 failed."""
    first = attempts.where("attempt = 1").select("row_id", F.col("passed").alias("p1"), F.array_join("reasons", "; ").alias("feedback"))
    again = attempts.where("attempt = 2").select("row_id", F.col("passed").alias("p2"))
    both = first.join(again, "row_id", "left")
    used = ~F.col("p1") & F.col("p2").isNotNull()
    return both.select("row_id", F.when(used, F.col("p2")).otherwise(F.col("p1")).alias("passed"), used.cast("int").alias("regen_count"), F.when(~F.col("p1"), F.col("feedback")).otherwise("").alias("feedback"))


def validate_with_retries(first: Sequence[DataFrame], again: Sequence[DataFrame], clauses: DataFrame, scope: Sequence[str], provider: str) -> DataFrame:
    """row_id, passed, regen_count, feedback (reasons of the original that failed) and reasons (of what counts) of rows with at most one retry each.

    first and again are rows, branches and citations of the originals and of the retries, which have their original's row_id and seq. All stand in one order, a retry right after its original, and carry
    one state: an original that fails only in other checks has registered its question, so a retry that asks it again is a duplicate; a retry of an original that passes is never asked.
    """
    none = first[0].sparkSession.createDataFrame([], "row_id long")
    alone = validate_rows(*first, clauses, none, provider).select("row_id", F.col("passed").alias("good"))

    def keyed(tables: Sequence[DataFrame]) -> DataFrame:
        return tables[0].join(cite_keys(tables[2]), "row_id", "left").select(*scope, "row_id", "seq", "question", F.coalesce("cite_key", F.lit("")).alias("cite_key"))

    originals = keyed(first).withColumn("seq", F.col("seq") * 2).withColumn("needs", F.lit(None).cast("long"))
    asked = keyed(again).join(alone, "row_id").withColumn("needs", F.when(F.col("good"), F.col("seq") * 2)).withColumn("seq", F.col("seq") * 2 + 1).drop("good")
    stream = written(originals.unionByName(asked), "attempts")
    twice = written(stream.join(dedupe_rows(stream, scope), "seq", "left_semi").select("row_id", (F.col("seq") % 2 + 1).alias("attempt")), "duplicates")
    checked = [validate_rows(*tables, clauses, twice.where(F.col("attempt") == i), provider).select("row_id", F.lit(i).alias("attempt"), "passed", "reasons") for i, tables in ((1, first), (2, again))]
    told = written(checked[0].unionByName(checked[1]), "checked")
    merged = retry_merge(told)
    used = merged.select("row_id", (F.col("regen_count") + 1).alias("attempt")).join(told.select("row_id", "attempt", "reasons"), ["row_id", "attempt"])
    return merged.join(used.drop("attempt"), "row_id")


def kept_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    return rows.join(report.where("passed").select("row_id"), "row_id", "left_semi")


def dropped_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The rows that fail, with their reasons."""
    return rows.join(report.where("NOT passed").select("row_id", "reasons"), "row_id")


def cite_keys(citations: DataFrame) -> DataFrame:
    """row_id, cite_key: the sorted distinct ids of a row's own citations; a missing id is one of its own."""
    return citations.where("branch_pos = 0").groupBy("row_id").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("clause_id", F.lit("")))), "|").alias("cite_key"))


