"""Queries over question-and-answer rows: validation, schema, duplicates, quotas. Each entry is (query, comparison SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundwork.functions.text import AMBIGUITY_TYPES, CONFIDENT, HEDGES, escalation_words, question_key
from groundwork.jobs.bindings import PROVIDER, Tables, with_tables
from groundwork.operators import quota, schema_gate, validate

_FOLD = "translate({0}, '“”‘’', '\"\"''''')"
_HELD = f"contains({_FOLD.format('c.verbatim_text')}, {_FOLD.format('t.excerpt')})"
#: The given excerpts, with quotes put in by id: in the clauses every e is a curly quote; in the excerpts it is a straight one, the same one, or none that a clause has.
_QUOTED = "replace({0}, 'e', CASE row_id % 3 WHEN 0 THEN chr(39) WHEN 1 THEN '’' ELSE '`' END)"
_CURLED = "replace(c.verbatim_text, 'e', '’')"
_CITED = "citations t LEFT JOIN clauses c ON c.clause_id = t.clause_id"
_REASONS = (
    "v1",
    f"""SELECT q.row_id, CASE WHEN q.category = 'A' AND NOT EXISTS (SELECT 1 FROM citations t WHERE t.row_id = q.row_id AND t.branch_pos = 0) THEN 'no citation' ELSE f.bad END AS citations_reason
    FROM qa q LEFT JOIN (SELECT row_id, arg_min(bad, branch_pos * 1000 + cite_pos) AS bad FROM (SELECT t.row_id, t.branch_pos, t.cite_pos, CASE WHEN c.clause_id IS NULL THEN 'unknown clause ' || coalesce(t.clause_id, 'null') WHEN NOT {_HELD} THEN 'excerpt not in ' || t.clause_id END AS bad FROM {_CITED}) x WHERE bad IS NOT NULL GROUP BY row_id) f USING (row_id)""",
)
_CLAIM = r"(?i)\b\d+\s*(?:days?|working days?|%|percent|hours?)\b"
_GROUNDING = (
    "v3",
    f"""SELECT q.row_id, CASE WHEN l.loose IS NOT NULL THEN 'not in cited text: ' || l.loose END AS grounding_reason FROM qa q LEFT JOIN (
    SELECT c.row_id, string_agg(DISTINCT c.claim, ', ' ORDER BY c.claim) AS loose FROM (SELECT DISTINCT row_id, lower(unnest(regexp_extract_all(answer, '{_CLAIM}'))) AS claim FROM (SELECT row_id, answer FROM qa UNION ALL SELECT row_id, answer FROM branches) s) c
    LEFT JOIN (SELECT t.row_id, string_agg(lower(c.verbatim_text), ' ' ORDER BY t.cite_pos) AS txt FROM citations t JOIN clauses c USING (clause_id) WHERE t.branch_pos = 0 GROUP BY t.row_id) x ON x.row_id = c.row_id
    WHERE NOT contains(coalesce(x.txt, ''), c.claim) GROUP BY c.row_id) l USING (row_id)""",
)
_V4 = r"CASE WHEN regexp_matches(question, '(?i)^\s*(it|this|that|they)\b') THEN 'starts with a pronoun' WHEN contains(lower(question), 'previous question') OR contains(lower(question), 'earlier you said') OR contains(lower(question), 'as you mentioned') THEN 'refers to an earlier turn' END"
_N_OWN = "(SELECT count(*) FROM citations t WHERE t.row_id = q.row_id AND t.branch_pos = 0)"
_HEDGED = f"list_sort(list_distinct(regexp_extract_all(lower(q.answer), '\\b({'|'.join(HEDGES)})\\b', 1)))"
_V9 = f"CASE WHEN {_N_OWN} < 1 THEN 'no citation' WHEN len({_HEDGED}) > 0 THEN 'hedges: ' || array_to_string({_HEDGED}, ', ') END"
_C, _A = "lower(coalesce(q.clarifying_question, ''))", "lower(coalesce(q.clarification_axis, ''))"
_V10 = f"CASE WHEN trim({_C}) = '' THEN 'no clarifying question' WHEN trim({_A}) = '' THEN 'no axis' WHEN NOT (contains({_C}, replace({_A}, '_', ' ')) OR len(list_filter(string_split({_A}, '_'), lambda x: contains({_C}, x))) > 0) THEN 'axis not named' WHEN q.n_branches < 2 THEN 'fewer than 2 branches' END"


def _any(col: str, marks) -> str:
    return "(" + " OR ".join(f"contains(lower({col}), '{m}')" for m in marks) + ")"


_TYPES = ", ".join(f"'{x}'" for x in AMBIGUITY_TYPES)
_V11 = f"CASE WHEN q.ambiguity_type IS NULL THEN 'no ambiguity' WHEN q.ambiguity_type NOT IN ({_TYPES}) THEN 'unknown ambiguity type' WHEN {_any('q.answer', CONFIDENT)} THEN 'confident answer' WHEN NOT q.should_escalate THEN 'no escalation flag' WHEN NOT {_any('q.answer', escalation_words(PROVIDER))} THEN 'no escalation words' END"
KEY = r"trim(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
#: Questions for the duplicate checks are whole documents, which hold exact and near copies.
_ASKED = ("asked", f"SELECT doc_id AS row_id, doc_id AS seq, lang, '' AS cite_key, text AS question, {KEY.format('text')} AS key FROM documents")
_SETS = ("sets", "SELECT row_id, lang, key, list_sort(list_distinct(list_filter(string_split(key, ' '), lambda x: x <> ''))) AS tokens FROM asked")
_REPS = ("reps", "SELECT lang, tokens, min(row_id) AS row_id FROM sets WHERE len(tokens) > 0 GROUP BY lang, tokens")


def near_tables(least: float) -> tuple[tuple[str, str], ...]:
    """Tables whose last, near, are the pairs of documents of one language whose token sets are that similar, between the first documents of distinct sets.

    Candidates are found by the bound in its plainest form: similar sets share a token among each one's first n - ceil(least * n) + 1.
    """
    prefix = f"SELECT row_id, lang, len(tokens) AS n, unnest(list_sort(tokens)[1 : CAST(len(tokens) - ceil(len(tokens) * {least} - 1e-9) + 1 AS INT)]) AS token FROM reps"
    pairs = f"SELECT DISTINCT p.row_id AS a, r.row_id AS b FROM prefix p JOIN prefix r ON p.lang = r.lang AND p.token = r.token AND p.row_id < r.row_id AND p.n >= {least} * r.n - 1e-9 AND r.n >= {least} * p.n - 1e-9"
    shared = "len(list_intersect(x.tokens, y.tokens))"
    near = f"SELECT earlier, later, similarity FROM (SELECT c.a AS earlier, c.b AS later, {shared} / (len(x.tokens) + len(y.tokens) - {shared}) AS similarity FROM ({pairs}) c JOIN reps x ON x.row_id = c.a JOIN reps y ON y.row_id = c.b) z WHERE similarity >= {least}"
    return _ASKED, _SETS, _REPS, ("prefix", prefix), ("near", near)


def _asked(t: Tables):
    return t.documents.select(F.col("doc_id").alias("row_id"), F.col("doc_id").alias("seq"), "lang", F.lit("").alias("cite_key"), F.col("text").alias("question"))


def reports(t: Tables):
    """Every row's report; duplicates are those of a pass in order, in which a duplicate registers nothing."""
    t.write("clauses", "qa", "citations")
    keyed = t.qa.join(validate.cite_keys(t.citations), "row_id", "left").withColumn("cite_key", F.coalesce("cite_key", F.lit("")))
    twice = t.qa.select("row_id", "seq").join(validate.dedupe_rows(keyed, ["category"]), "seq", "left_semi")
    return validate.validate_rows(t.qa, t.branches, t.citations, t.clauses, twice, PROVIDER)


def _own(t: Tables):
    own = t.citations.where("branch_pos = 0").groupBy("row_id").agg(F.count("*").alias("n_own"))
    return t.qa.join(own, "row_id", "left")


def _flat_report(report):
    checks = F.array_join(F.transform(F.array_sort(F.map_entries("checks")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return report.select("row_id", "category", checks.alias("checks"), F.array_join("reasons", "; ").alias("reasons"), "passed")


def _ok(reason: str) -> str:
    return f"CASE WHEN {reason} IS NULL THEN 'ok' ELSE 'fail' END"


def _first_fit(rows: str, scope: str, p: str = "") -> list[tuple[str, str]]:
    """Tables whose last, {p}gone(row_id), are the rows of `rows` (SQL: row_id, scope, cite_key, key) that a pass in row_id order drops, by recursion over the
    rows that have an earlier row of the same key or of the same cite_key and a similar key."""
    return [
        (f"{p}rows", rows),
        (f"{p}sets!", f"SELECT row_id, {scope}, cite_key, key, list_sort(list_distinct(list_filter(string_split(key, ' '), lambda x: x <> ''))) AS tokens FROM {p}rows"),
        (f"{p}reps!", f"SELECT {scope}, cite_key, tokens, min(row_id) AS rep FROM {p}sets WHERE len(tokens) > 0 GROUP BY {scope}, cite_key, tokens"),
        (f"{p}prefix", f"SELECT rep, {scope}, cite_key, len(tokens) AS n, unnest(list_sort(tokens)[1 : CAST(len(tokens) - ceil(len(tokens) * 0.8 - 1e-9) + 1 AS INT)]) AS token FROM {p}reps"),
        (f"{p}close", f"SELECT DISTINCT a.rep AS r1, b.rep AS r2 FROM {p}prefix a JOIN {p}prefix b ON a.{scope} = b.{scope} AND a.cite_key = b.cite_key AND a.token = b.token AND a.rep < b.rep"),
        (f"{p}alike", f"SELECT r1, r2 FROM (SELECT r1, r2, len(list_intersect(x.tokens, y.tokens)) AS n_both, len(x.tokens) + len(y.tokens) AS total FROM {p}close JOIN {p}reps x ON x.rep = r1 JOIN {p}reps y ON y.rep = r2) z WHERE n_both / (total - n_both) >= 0.8 UNION ALL SELECT rep, rep FROM {p}reps"),
        (f"{p}members", f"SELECT s.row_id, r.rep FROM {p}sets s JOIN {p}reps r ON s.{scope} = r.{scope} AND s.cite_key = r.cite_key AND s.tokens = r.tokens"),
        (
            f"{p}before!",
            f"SELECT b, row_number() OVER (ORDER BY b) AS n, list(a) AS earlier FROM (SELECT DISTINCT least(x.row_id, y.row_id) AS a, greatest(x.row_id, y.row_id) AS b FROM {p}alike JOIN {p}members x ON x.rep = r1 JOIN {p}members y ON y.rep = r2 WHERE x.row_id <> y.row_id UNION SELECT x.row_id, y.row_id FROM {p}sets x JOIN {p}sets y ON x.{scope} = y.{scope} AND x.key = y.key AND x.row_id < y.row_id) e GROUP BY b",
        ),
        (f"{p}fit", f"SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS gone UNION ALL SELECT b.n, CASE WHEN len(list_filter(b.earlier, lambda x: NOT list_contains(f.gone, x))) > 0 THEN list_append(f.gone, b.b) ELSE f.gone END FROM {p}fit f JOIN {p}before b ON b.n = f.n + 1"),
        (f"{p}gone", f"SELECT unnest(gone) AS row_id FROM (SELECT gone FROM {p}fit ORDER BY n DESC LIMIT 1) x"),
    ]


_CITE_KEYS = "(SELECT row_id, string_agg(DISTINCT coalesce(clause_id, ''), '|' ORDER BY coalesce(clause_id, '')) AS cite_key FROM citations WHERE branch_pos = 0 GROUP BY row_id)"
_DUP = _first_fit(f"SELECT q.row_id, q.category, coalesce(k.cite_key, '') AS cite_key, {KEY.format('q.question')} AS key FROM qa q LEFT JOIN {_CITE_KEYS} k ON k.row_id = q.row_id", "category", "dup_")
_REPORT = (
    "report",
    f"""SELECT row_id, category, seq, 'citations=' || {_ok('r1')} || ',duplicate=' || {_ok('r4')} || ',grounding=' || {_ok('r2')} || ',self_containment=' || {_ok('r3')} || ',structure_' || lower(category) || '=' || {_ok('r5')} AS checks,
    concat_ws('; ', r1, r2, r3, r4, r5) AS reasons, coalesce(r1, r2, r3, r4, r5) IS NULL AS passed FROM (SELECT q.row_id, q.category, q.seq, v1.citations_reason AS r1, v3.grounding_reason AS r2, {_V4} AS r3, CASE WHEN d.row_id IS NOT NULL THEN 'duplicate question' END AS r4, CASE q.category WHEN 'A' THEN {_V9} WHEN 'B' THEN {_V10} ELSE {_V11} END AS r5
    FROM qa q JOIN v1 USING (row_id) JOIN v3 USING (row_id) LEFT JOIN dup_gone d USING (row_id)) z""",
)
FULL = (_REASONS, _GROUNDING, *_DUP, _REPORT)


def _with_retries(t: Tables):
    t.write("clauses", "qa", "citations", "retries", "retry_citations")
    found = validate.validate_with_retries((t.qa, t.branches, t.citations), (t.retries.withColumn("n_branches", F.lit(0)), t.retry_branches, t.retry_citations), t.clauses, ["category"], PROVIDER)
    return found.select("row_id", "passed", "regen_count", "feedback", F.array_join("reasons", "; ").alias("reasons"))


def _checked(p: str, qa: str, branches: str, citations: str, n_branches: str) -> list[tuple[str, str]]:
    """Tables whose last, {p}alone, has the reasons r1, r2, r3 and r5 (all but that of the duplicate check) of one attempt of each row."""
    named = {"qa q": f"{qa} q", "FROM qa ": f"FROM {qa} ", "FROM branches": f"FROM {branches}", "citations t": f"{citations} t"}

    def of(sql: str) -> str:
        for k, v in named.items():
            sql = sql.replace(k, v)
        return sql.replace("q.n_branches", n_branches)

    return [
        (f"{p}v1", of(_REASONS[1])),
        (f"{p}v3", of(_GROUNDING[1])),
        (f"{p}alone!", of(f"SELECT q.row_id, v1.citations_reason AS r1, v3.grounding_reason AS r2, {_V4} AS r3, CASE q.category WHEN 'A' THEN {_V9} WHEN 'B' THEN {_V10} ELSE {_V11} END AS r5 FROM qa q JOIN {p}v1 v1 USING (row_id) JOIN {p}v3 v3 USING (row_id)")),
    ]


def _keyed(attempt: int, rows: str, citations: str) -> str:
    cited = f"(SELECT row_id, string_agg(DISTINCT coalesce(clause_id, ''), '|' ORDER BY coalesce(clause_id, '')) AS cite_key FROM {citations} WHERE branch_pos = 0 GROUP BY row_id)"
    return f"SELECT q.row_id * 2 + {attempt} AS row_id, q.category, coalesce(k.cite_key, '') AS cite_key, {KEY.format('q.question')} AS key FROM {rows} q LEFT JOIN {cited} k ON k.row_id = q.row_id"


_GOOD = "coalesce(r1, r2, r3, r5) IS NULL"
#: Originals (even) and retries (odd) in one order; a pass by recursion over all of them, in which a retry is there only if its original failed.
_RETRIED = (
    *_checked("f_", "qa", "branches", "citations", "q.n_branches"),
    *_checked("g_", "retries", "retry_branches", "retry_citations", "(SELECT count(*) FROM retry_branches b WHERE b.row_id = q.row_id)"),
    *_first_fit(_keyed(0, "qa", "citations") + " UNION ALL " + _keyed(1, "retries", "retry_citations"), "category", "s_")[:-2],
    ("events!", f"SELECT r.row_id AS id, row_number() OVER (ORDER BY r.row_id) AS n, coalesce(b.earlier, CAST([] AS BIGINT[])) AS earlier, {_GOOD} AS original_good FROM s_rows r LEFT JOIN s_before b ON b.b = r.row_id JOIN f_alone f ON f.row_id = r.row_id // 2"),
    (
        "told",
        "SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept, CAST([] AS BIGINT[]) AS twice UNION ALL SELECT n, CASE WHEN there AND NOT hit THEN list_append(kept, id) ELSE kept END, CASE WHEN there AND hit THEN list_append(twice, id) ELSE twice END FROM "
        "(SELECT e.n, e.id, t.kept, t.twice, e.id % 2 = 0 OR NOT e.original_good OR list_contains(t.twice, e.id - 1) AS there, len(list_filter(e.earlier, lambda x: list_contains(t.kept, x))) > 0 AS hit FROM told t JOIN events e ON e.n = t.n + 1) z",
    ),
    ("again", "SELECT DISTINCT unnest(twice) AS id FROM (SELECT twice FROM told ORDER BY n DESC LIMIT 1) x"),
    (
        "attempts",
        "SELECT row_id, attempt, concat_ws('; ', r1, r2, r3, CASE WHEN id IS NOT NULL THEN 'duplicate question' END, r5) AS reasons FROM (SELECT f.*, 1 AS attempt, a.id FROM f_alone f LEFT JOIN again a ON a.id = f.row_id * 2 UNION ALL SELECT g.*, 2, a.id FROM g_alone g LEFT JOIN again a ON a.id = g.row_id * 2 + 1) x",
    ),
)


_ERRORS = [
    ("NOT regexp_matches(q.id, '^[ABC]-\\d{3}$')", "id: pattern"),
    ("length(q.question) < 10", "question: too short"),
    ("q.persona IS NULL", "persona: required"),
    ("q.confidence NOT IN ('high', 'medium', 'low')", "confidence: not one of high, medium, low"),
    ("q.regen_count < 0", "regen_count: below 0"),
    ("q.category = 'A' AND length(q.answer) < 10", "answer: too short"),
    ("q.category = 'A' AND q.clarifying_question IS NOT NULL", "clarifying_question: must be null"),
    ("q.category = 'A' AND q.n_branches > 0", "answer_branches: must be null"),
    ("q.category <> 'C' AND q.ambiguity_type IS NOT NULL", "ambiguity: must be null"),
    ("q.category = 'B' AND length(coalesce(q.clarifying_question, '')) < 10", "clarifying_question: too short"),
    ("q.category = 'B' AND length(coalesce(q.clarification_axis, '')) < 3", "clarification_axis: too short"),
    ("q.category = 'B' AND q.n_branches < 2", "answer_branches: fewer than 2"),
    ("q.category = 'C' AND q.ambiguity_type IS NULL", "ambiguity: required"),
    (f"q.category = 'C' AND q.ambiguity_type NOT IN ({_TYPES})", "ambiguity.type: unknown"),
    ("q.category = 'C' AND NOT q.should_escalate", "should_escalate: must be true"),
    ("q.category = 'C' AND q.clarifying_question IS NOT NULL", "clarifying_question: must be null"),
    ("EXISTS (SELECT 1 FROM citations t WHERE t.row_id = q.row_id AND t.branch_pos = 0 AND (t.clause_id IS NULL OR t.excerpt IS NULL))", "clause_citations: incomplete"),
]
ERROR_SQL = ("errs", "SELECT row_id, id, category, concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in _ERRORS) + ") AS errors FROM qa q")
_DROP = "q.conv_id % 6 = 1"


def _errors(t: Tables):
    return schema_gate.schema_errors(t.qa, t.citations)


def _gone(t: Tables):
    return t.qa.where("conv_id % 6 = 1").select("id")


QUERIES = {
    "v1_check_citations": (lambda t: validate.check_citations(t.qa, t.citations, t.clauses), with_tables("SELECT * FROM v1", _REASONS)),
    "v2_excerpt_match": (
        lambda t: validate.cited(t.citations, t.clauses).where("clause_text IS NOT NULL").select("row_id", "cite_pos", validate.holds_excerpt(F.replace("clause_text", F.lit("e"), F.lit("’")), F.expr(_QUOTED.format("excerpt"))).alias("held")),
        with_tables(f"SELECT t.row_id, t.cite_pos, contains({_FOLD.format(_CURLED)}, {_FOLD.format(_QUOTED.format('t.excerpt'))}) AS held FROM citations t JOIN clauses c USING (clause_id)"),
    ),
    "v3_check_grounding": (lambda t: validate.check_grounding(t.qa, t.branches, t.citations, t.clauses), with_tables("SELECT * FROM v3", _GROUNDING)),
    "v4_check_self_containment": (lambda t: t.qa.select("row_id", validate.self_containment_reason(F.col("question")).alias("reason")), with_tables(f"SELECT row_id, {_V4} AS reason FROM qa")),
    "v5_normalise_question": (lambda t: t.documents.select("doc_id", question_key(F.col("text")).alias("key")), f"SELECT doc_id, {KEY.format('text')} AS key FROM documents"),
    "v6_exact_duplicates": (lambda t: validate.exact_duplicates(_asked(t), ["lang"]), with_tables("SELECT row_id, first_id FROM (SELECT row_id, min(row_id) OVER (PARTITION BY lang, key) AS first_id FROM asked) x WHERE row_id <> first_id", _ASKED)),
    "v7_near_duplicate_pairs": (lambda t: validate.near_duplicate_pairs(_asked(t), ["lang"]), with_tables("SELECT * FROM near", *near_tables(0.8))),
    "v8_dedupe_rows": (lambda t: validate.dedupe_rows(_asked(t), ["lang"]), with_tables("SELECT row_id AS seq FROM v8_gone", _ASKED, *_first_fit("SELECT row_id, lang, cite_key, key FROM asked", "lang", "v8_"))),
    "v9_check_struct_a": (lambda t: _own(t).where("category = 'A'").select("row_id", validate.struct_a_reason(F.col("n_own"), F.col("answer")).alias("reason")), with_tables(f"SELECT row_id, {_V9} AS reason FROM qa q WHERE category = 'A'")),
    "v10_check_struct_b": (lambda t: t.qa.where("category = 'B'").select("row_id", validate.struct_b_reason(F.col("clarifying_question"), F.col("clarification_axis"), F.col("n_branches")).alias("reason")), with_tables(f"SELECT row_id, {_V10} AS reason FROM qa q WHERE category = 'B'")),
    "v11_check_struct_c": (lambda t: t.qa.where("category = 'C'").select("row_id", validate.struct_c_reason(F.col("ambiguity_type"), F.col("answer"), F.col("should_escalate"), PROVIDER).alias("reason")), with_tables(f"SELECT row_id, {_V11} AS reason FROM qa q WHERE category = 'C'")),
    "v12_validate_rows": (lambda t: _flat_report(reports(t)), with_tables("SELECT row_id, category, checks, reasons, passed FROM report", *FULL)),
    "v12_pass_rate": (lambda t: reports(t).groupBy("category").agg(F.count("*").alias("n"), F.count_if("passed").alias("n_passed")), with_tables("SELECT category, count(*) AS n, count(*) FILTER (passed) AS n_passed FROM report GROUP BY category", *FULL)),
    "v13_strict_citation_audit": (
        lambda t: validate.strict_citation_audit(t.citations, t.clauses),
        with_tables(f"SELECT * FROM (SELECT t.row_id, t.branch_pos, t.cite_pos, CASE WHEN c.clause_id IS NULL AND t.branch_pos > 0 THEN 'unknown_clause_in_branch' WHEN c.clause_id IS NULL THEN 'unknown_clause' WHEN NOT contains(c.verbatim_text, t.excerpt) AND t.branch_pos > 0 THEN 'branch_excerpt_not_substring' WHEN NOT contains(c.verbatim_text, t.excerpt) THEN 'excerpt_not_substring' END AS code FROM {_CITED}) x WHERE code IS NOT NULL"),
    ),
    "v14_retry_merge": (
        _with_retries,
        with_tables(
            "SELECT o.row_id, CASE WHEN o.reasons <> '' AND r.row_id IS NOT NULL THEN r.reasons = '' ELSE o.reasons = '' END AS passed, CASE WHEN o.reasons <> '' AND r.row_id IS NOT NULL THEN 1 ELSE 0 END AS regen_count, o.reasons AS feedback, CASE WHEN o.reasons <> '' AND r.row_id IS NOT NULL THEN r.reasons ELSE o.reasons END AS reasons FROM (SELECT * FROM attempts WHERE attempt = 1) o LEFT JOIN (SELECT * FROM attempts WHERE attempt = 2) r ON r.row_id = o.row_id",
            *_RETRIED,
        ),
    ),
    "v15_split_kept": (lambda t: validate.kept_rows(t.qa, reports(t)).select("row_id"), with_tables("SELECT row_id FROM report WHERE passed", *FULL)),
    "v15_split_dropped": (lambda t: validate.dropped_rows(t.qa, reports(t)).select("row_id", F.array_join("reasons", "; ").alias("reasons")), with_tables("SELECT row_id, reasons FROM report WHERE NOT passed", *FULL)),
    "sc1_schema_errors": (lambda t: _errors(t).select("row_id", "id", F.array_join("errors", "; ").alias("errors")), with_tables("SELECT row_id, id, errors FROM errs", ERROR_SQL)),
    "sc2_conditional_schema": (
        lambda t: _errors(t).select("row_id", F.explode("errors").alias("error")).where(F.col("error").contains("must be null") | F.col("error").contains("must be true")).groupBy("error").agg(F.count("*").alias("n")),
        with_tables("SELECT error, count(*) AS n FROM (SELECT unnest(string_split(errors, '; ')) AS error FROM errs) x WHERE contains(error, 'must be null') OR contains(error, 'must be true') GROUP BY error", ERROR_SQL),
    ),
    "sc3_valid_share": (lambda t: schema_gate.valid_share(_errors(t)), with_tables("SELECT category, count(*) AS n, count(*) FILTER (errors = '') AS n_valid, count(*) FILTER (errors = '') / count(*) AS share FROM errs GROUP BY category", ERROR_SQL)),
    "q1_quota_per_category": (lambda t: quota.quota_per_category(validate.kept_rows(t.qa, reports(t)), 15).select("row_id", "category"), with_tables("SELECT row_id, category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY seq) AS n FROM report WHERE passed) x WHERE n <= 15", *FULL)),
    "q2_drop_ids": (
        lambda t: quota.without_ids(t.qa, _gone(t)).select("row_id", F.lit("kept").alias("state")).unionByName(quota.removed(t.qa, _gone(t), "flagged").select("row_id", F.col("reason").alias("state"))),
        with_tables("SELECT row_id, CASE WHEN id IN (SELECT id FROM qa WHERE conv_id % 6 = 1) THEN 'flagged' ELSE 'kept' END AS state FROM qa"),
    ),
    "q3_merge_rounds": (
        lambda t: quota.merge_rounds(quota.without_ids(t.qa, _gone(t)).select("row_id", "category", "answer"), t.qa.join(_gone(t).distinct(), "id", "left_semi").select((F.col("row_id") + 1_000_000_000).alias("row_id"), "category", F.concat(F.lit("New: "), "answer").alias("answer"))),
        with_tables("SELECT row_id, category, answer FROM qa WHERE id NOT IN (SELECT id FROM qa WHERE conv_id % 6 = 1) UNION ALL SELECT row_id + 1000000000, category, 'New: ' || answer FROM qa WHERE id IN (SELECT id FROM qa WHERE conv_id % 6 = 1)"),
    ),
    "q4_renumber": (
        lambda t: quota.renumber(t.qa.withColumn("id", F.concat_ws("-", "category", "seq"))).select("row_id", "old_id", "id"),
        with_tables("SELECT row_id, old_id, category || '-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS id FROM (SELECT row_id, category, category || '-' || seq AS old_id, row_number() OVER (PARTITION BY category ORDER BY category || '-' || seq) AS n FROM qa) x"),
    ),
}
