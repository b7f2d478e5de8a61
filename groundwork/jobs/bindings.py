"""Logical tables of the library, derived from the given tables by the same expressions in Spark and in the comparison SQL.

The given prose has none of the words that the checks look for, so phrases, wrong citations and gaps are put in by id, so that both
outcomes of every check occur. SHARED tables are SQL that both engines read; {table} stands for a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.operators import source
from groundwork.operators.greedy import written

SHARED = {
    "qa": """SELECT *, category || '-' || lpad(CAST(seq % 1500 AS VARCHAR(9)), 3, '0') AS id FROM (
        SELECT u.conv_id * 1000 + u.turn AS row_id, u.conv_id * 1000 + u.turn AS seq, u.conv_id AS conv_id, CASE u.conv_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS category,
        CASE (u.conv_id + u.turn) % 9 WHEN 0 THEN 'It is: ' WHEN 4 THEN 'As you mentioned, ' ELSE '' END || u.text AS question,
        CASE (u.conv_id + u.turn) % 5 WHEN 0 THEN 'It might depend. ' WHEN 1 THEN 'Please escalate this. ' WHEN 2 THEN 'Clearly so. ' WHEN 3 THEN 'Settled within 7 days. ' ELSE '' END || a.text AS answer,
        CASE WHEN u.conv_id % 3 = 1 THEN CASE WHEN u.conv_id % 7 = 0 THEN '' ELSE 'Which payment method do you mean?' END WHEN u.conv_id % 19 = 0 THEN 'Which one?' END AS clarifying_question,
        CASE u.conv_id % 4 WHEN 0 THEN 'payment_method' WHEN 1 THEN 'account_type' WHEN 2 THEN '' ELSE 'method' END AS clarification_axis,
        CASE u.conv_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'silent' WHEN 2 THEN 'vague_language' WHEN 3 THEN 'other' ELSE 'external_deferral' END AS ambiguity_type,
        CASE u.conv_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'none' ELSE 'medium' END AS confidence, u.conv_id % 7 <> 0 AS should_escalate,
        CASE WHEN u.conv_id % 23 = 0 THEN NULL ELSE 'merchant' END AS persona, CASE WHEN u.conv_id % 3 = 1 THEN 1 + u.conv_id % 3 ELSE 0 END + CASE WHEN u.conv_id % 2 = 0 THEN 1 ELSE 0 END AS n_branches,
        CAST(u.turn % 3 AS INT) - 1 AS regen_count, u.conv_id || '#1' AS seed1, u.conv_id || '#' || (1 + u.turn % 3) AS seed2
        FROM {conversations} u JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant') x""",
    "branches": """SELECT q.row_id, b.branch_pos, CASE WHEN b.branch_pos = 1 THEN 'Within 12 hours. ' ELSE 'Later. ' END AS answer
        FROM {qa} q JOIN (SELECT 1 AS branch_pos UNION ALL SELECT 2 UNION ALL SELECT 3) b ON b.branch_pos <= q.n_branches""",
    "citations": """SELECT q.row_id, CASE WHEN c.line_no <= 2 THEN 0 ELSE CAST(c.line_no AS INT) - 2 END AS branch_pos, CAST(c.line_no AS INT) AS cite_pos,
        CASE WHEN (q.seq + c.line_no) % 13 = 5 THEN NULL ELSE c.clause_id || CASE WHEN (q.seq + c.line_no) % 11 = 0 THEN '-x' ELSE '' END END AS clause_id,
        CASE WHEN q.seq % 4 = 0 AND c.line_no > 2 THEN '' ELSE substr(c.verbatim_text, 2, 25) END || CASE WHEN (q.seq + c.line_no) % 7 = 0 THEN 'zz' ELSE '' END AS excerpt
        FROM {qa} q JOIN {clauses} c ON c.doc_id = q.conv_id AND c.line_no <= CASE WHEN q.seq % 6 = 0 THEN 0 WHEN q.category = 'B' THEN 4 ELSE 2 END""",
    "retries": r"""SELECT row_id, seq, category, CASE WHEN row_id % 4 = 0 THEN question ELSE regexp_replace(question, '^(It is: |As you mentioned, )', '') END AS question,
        regexp_replace(answer, '^(It might depend[.] |Clearly so[.] |Settled within 7 days[.] )', 'Please escalate this. ') AS answer, CASE WHEN category = 'B' THEN 'Which payment method do you mean?' END AS clarifying_question, 'payment_method' AS clarification_axis,
        'silent' AS ambiguity_type, TRUE AS should_escalate FROM {qa} WHERE conv_id % 5 <> 4""",
    "retry_branches": "SELECT r.row_id, b.branch_pos, 'Later. ' AS answer FROM {retries} r JOIN (SELECT 1 AS branch_pos UNION ALL SELECT 2) b ON r.category = 'B'",
    "retry_citations": "SELECT t.row_id, t.branch_pos, t.cite_pos, regexp_replace(t.clause_id, '-x$', '') AS clause_id, regexp_replace(t.excerpt, 'zz$', '') AS excerpt FROM {citations} t JOIN {retries} r ON r.row_id = t.row_id WHERE t.clause_id IS NOT NULL",
    "spans": "SELECT doc_id, line_no AS line_start, line_no + CASE WHEN line_no % 7 = 1 THEN 2 ELSE 0 END AS line_end FROM {lines} WHERE line_no % 4 <> 3",
    "sections": "SELECT doc_id, line_no AS line_start, line_no + 1 AS line_end FROM {lines} WHERE line_no % 4 = 3",
    "rated": """SELECT event_id AS row_id, event_type AS dim, CAST(1 + floor(value) % 5 AS INT) AS a, CAST(CASE WHEN event_id % 9 = 0 THEN NULL ELSE 1 + (event_id + user_id) % 5 END AS INT) AS b FROM {events}
        UNION ALL SELECT event_id, 'constant', 3, 3 FROM {events} WHERE event_type = 'click'""",
    "scores": """SELECT user_id AS row_id, CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS category, CASE WHEN event_type < 'm' THEN 'first' ELSE 'second' END AS judge, event_type AS dim,
        min(event_id) AS dim_pos, CAST(1 + sum(event_id + user_id) % 5 AS INT) AS score FROM {events} GROUP BY user_id, event_type""",
    "people": "SELECT user_id AS row_id, user_id AS seq, CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS category, 'question ' || user_id AS question, 'answer ' || user_id AS answer, CASE WHEN user_id % 3 = 1 THEN 'Which ' || user_id || '?' END AS clarifying_question, CASE WHEN user_id % 3 = 1 THEN 'axis' END AS clarification_axis, user_id % 4 <> 0 AS passed, user_id % 2 AS regen_count, 's' || user_id AS seed1, 't' || user_id AS seed2 FROM {events} GROUP BY user_id",
    "verdicts": """SELECT CAST(event_id % 4 AS INT) AS round, CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END || '-' || user_id AS id, CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS category,
        CASE WHEN max(value) >= 150 THEN 'pass' ELSE 'fail' END AS verdict FROM {events} GROUP BY event_id % 4, user_id""",
    "calls": """SELECT event_type AS stage, CASE user_id % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'large' WHEN 2 THEN 'other' ELSE 'unpriced' END AS model, CAST(floor(value * 10) AS BIGINT) AS input_tokens, CAST(floor(value) AS BIGINT) AS output_tokens,
        user_id AS latency_ms, event_id % 3 AS count, event_id AS started, event_id + user_id AS ended, CASE WHEN event_id % 10 < 8 THEN 'first' ELSE 'topup' END AS run FROM {events}""",
    "prices": "SELECT 'small' AS model, 1.0 AS input_per_mtok, 5.0 AS output_per_mtok UNION ALL SELECT 'large', 3.0, 15.0 UNION ALL SELECT 'other', 0.5, 2.5",
    "edges": """SELECT 'r' || r_regionkey AS node_id, NULL AS parent_id, r_regionkey AS sibling_pos, r_name AS title, 1 AS line_num FROM {region}
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey, n_name, 2 FROM {nation} UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey, c_name, 3 FROM {customer}""",
    "categories": "SELECT 'A' AS category UNION ALL SELECT 'B' UNION ALL SELECT 'C' UNION ALL SELECT 'D'",
    "responses": """SELECT seq AS cand_id, category, seq, CASE seq % 6 WHEN 0 THEN '```json' || chr(10) || j || chr(10) || '```' WHEN 1 THEN 'Here it is: ' || j WHEN 2 THEN substr(j, 1, length(j) - 1) || ' , }' WHEN 3 THEN CASE WHEN seq % 12 = 3 THEN 'broken { "question": ' ELSE '{"question": oops }' END WHEN 4 THEN '{"reject": true, "reason": "' || repeat('too thin ', 20) || '"}' ELSE j END AS content
        FROM (SELECT seq, category, '{"question": "' || replace(replace(question, chr(10), ' '), '"', '') || '", "answer": "yes", "confidence": null}' AS j FROM {qa}) x""",
}

_LINES = "SELECT doc_id, CAST(i AS BIGINT) AS line_no, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, CASE WHEN l[len(l)] = '' THEN l[1 : len(l) - 1] ELSE l END AS l FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]') AS l FROM documents) x) y) z"
_PARENT = "CASE WHEN line_no = 1 THEN NULL WHEN line_no % 13 = 0 THEN 'gone#' || doc_id ELSE doc_id || '#1' END"
_CLAUSE = "doc_id, line_no, doc_id * 1000 + line_no AS pos, doc_id || '#' || line_no AS clause_id, line || CASE WHEN doc_id % 17 = 0 AND line_no % 5 = 0 THEN '~' ELSE '' END AS verbatim_text, line_no AS line_start, line_no + CASE WHEN line_no % 3 = 0 THEN 1 ELSE 0 END AS line_end"
_CLAUSES = f"SELECT {_CLAUSE}, {_PARENT} AS parent, title, list_distinct(list_filter(string_split_regex(lower(line), '[^\\p{{L}}]+'), lambda x: length(x) >= 5)) AS topics FROM (SELECT *, array_to_string(string_split(trim(line), ' ')[1:5], ' ') AS title FROM lines WHERE trim(line) <> '') x"

#: What the answers call the provider of the source texts.
PROVIDER = "the provider"

#: Names of the given tables that SHARED tables read.
GIVEN = ("documents", "conversations", "events", "region", "nation", "customer", "labels", "pages")


class Tables:
    """The logical tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def write(self, *names: str) -> None:
        """From now on these logical tables are read from the shared folder, where they are written now."""
        for name in names:
            self._made[name] = written(getattr(self, name), name)

    def _make(self, name: str) -> DataFrame:
        if name == "lines":
            return source.lines(self.documents)
        if name == "clauses":
            titled = self.lines.where(F.trim("line") != "").withColumn("title", F.array_join(F.slice(F.split(F.trim("line"), " "), 1, 5), " "))
            return titled.withColumn("topics", source.topics_of(F.col("line"))).selectExpr(*_columns(_CLAUSE), f"{_PARENT} AS parent", "title", "topics")
        if name == "branches":
            told = self.qa.where("n_branches > 0").select("row_id", F.explode(F.sequence(F.lit(1), F.least(F.lit(3), F.col("n_branches").cast("int")))).alias("branch_pos"))
            return told.withColumn("answer", F.when(F.col("branch_pos") == 1, "Within 12 hours. ").otherwise("Later. "))
        if name in SHARED:
            sql = SHARED[name]
            return self.spark.sql(sql, **{t: getattr(self, t) for t in (*GIVEN, "lines", "clauses", "qa", "citations", "retries") if "{" + t + "}" in sql}) if name != "responses" else self.spark.sql(sql.replace("'{\"", "'@\"").replace("{ \"", "@ \"").replace("}'", "#'"), qa=self.qa).withColumn("content", F.translate("content", "@#", "{}"))
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _columns(sql: str) -> list[str]:
    """The columns of a select list whose functions have no commas."""
    return [c.strip() for c in sql.split(", ")]


def with_tables(select: str, *more: tuple[str, str]) -> str:
    """Comparison SQL: select over the logical tables, and more (name, SQL) tables; one whose name ends in ! is made once."""
    plain = {name: sql for name, sql in SHARED.items()}
    for name in (*GIVEN, "lines", "clauses", "qa", "citations", "retries"):
        plain = {k: v.replace("{" + name + "}", name) for k, v in plain.items()}
    tables = [("lines", _LINES), ("clauses", _CLAUSES), *plain.items(), *more]
    return "WITH RECURSIVE " + ",\n".join(f"{name.rstrip('!')} AS {'MATERIALIZED ' if name.endswith('!') else ''}({sql})" for name, sql in tables) + "\n" + select
