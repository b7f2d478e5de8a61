"""Queries over scores, agreement, the catalogue, costs and audits. Each entry is (query, comparison SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundwork.jobs.bindings import Tables, with_tables
from groundwork.jobs.row_queries import KEY, near_tables
from groundwork.operators import agreement, audit, catalogue, costs, scores

_COMPOSITE = ("comp", "SELECT row_id, category, seq, coalesce(floor((total * 200 + n) / (n * 2)) / 100, 0.0) AS composite FROM people LEFT JOIN (SELECT row_id, CAST(sum(score) AS BIGINT) AS total, count(*) AS n FROM scores GROUP BY row_id) s USING (row_id)")
_PAIRS = ("pairs", "SELECT * FROM rated WHERE b IS NOT NULL")
_KAPPA = "CASE WHEN CAST(sum(a * a) * count(*) + sum(b * b) * count(*) - 2 * sum(a) * sum(b) AS DOUBLE) / count(*) = 0 THEN 0.0 ELSE 1 - CAST(sum((a - b) * (a - b)) AS DOUBLE) / (CAST(sum(a * a) * count(*) + sum(b * b) * count(*) - 2 * sum(a) * sum(b) AS DOUBLE) / count(*)) END"
_KINDS = "CASE doc_id % 6 WHEN 0 THEN 'wrong_citation' WHEN 1 THEN 'vague_clarifier' WHEN 2 THEN 'confident_in_C' WHEN 3 THEN 'other_fault' END"
_DIMS = "CASE doc_id % 6 WHEN 0 THEN 'citation_accuracy.clause_id_correct_scope' WHEN 1 THEN CASE WHEN doc_id % 4 < 2 THEN 'clarifier_quality.not_vague' ELSE 'clarifier_quality.specificity' END ELSE 'ambiguity_framing.avoids_confident_answer' END"
_LOW = ("low", "SELECT row_id, dim, score, CAST(row_number() OVER (PARTITION BY row_id ORDER BY score, dim_pos) AS INT) AS dim_rank FROM scores")
_WORST = ("worst", "SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY composite, seq) AS INT) AS worst_rank FROM comp")
_ADVICE = {"click": "shorten the answer", "error": "cite the clause", "view": "name the axis"}
_ADVISED = "CASE dim " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _ADVICE.items()) + " END"
_MITIGATED = ("mitigated", f"SELECT row_id, coalesce(arg_min({_ADVISED}, dim_rank) FILTER ({_ADVISED} IS NOT NULL), 'review by hand') AS mitigation FROM low WHERE dim_rank <= 3 GROUP BY row_id")
_COSTED = ("costed", "SELECT c.*, coalesce(input_tokens / 1e6 * input_per_mtok + output_tokens / 1e6 * output_per_mtok, 0.0) AS cost_usd FROM calls c LEFT JOIN prices USING (model)")
_SEEDED = ("seeded", "SELECT row_id, category, unnest([seed1, seed2]) AS clause_id FROM qa")
_FLAGS = ("flagged", "SELECT user_id AS row_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS flags FROM events WHERE value < 5 GROUP BY user_id")


def _composites(t: Tables):
    return scores.composite(t.people, t.scores).join(t.people.select("row_id", "seq"), "row_id")


def rated_pairs(t: Tables):
    return agreement.score_pairs(t.rated.select("row_id", "dim", F.col("a").alias("score")), t.rated.where("b IS NOT NULL").select("row_id", "dim", F.col("b").alias("score")))


def _labels(t: Tables):
    return t.labels.selectExpr("doc_id AS row_id", f"{_KINDS} AS injected")


def _label_scores(t: Tables):
    return t.labels.selectExpr("doc_id AS row_id", f"{_DIMS} AS dim", "1 + 3 * quality + toxic AS score")


def _flags(t: Tables):
    return scores.failure_flags(t.events.where("value < 5").select(F.col("user_id").alias("row_id"), F.array("event_type").alias("flags")))


def _costed(t: Tables):
    return costs.call_cost(t.calls, t.prices)


def _rounded(df):
    return df.withColumn("cost_usd", F.round("cost_usd", 6))


def _seeded(t: Tables):
    return t.qa.select("row_id", "seq", "category", "question", F.array("seed1", "seed2").alias("seed_clause_ids"))


def _nested(t: Tables):
    return t.scores.groupBy("row_id", "judge").agg(F.map_from_entries(F.collect_list(F.struct("dim", "score"))).alias("scores"))


def _tasks(t: Tables):
    return scores.judge_tasks(t.qa)


#: First rows of each distinct token set at each place of overlapping excerpts.
_PLACES = (
    ("spans_cited", "SELECT row_id, clause_id, strpos(verbatim_text, excerpt) AS a, strpos(verbatim_text, excerpt) + length(excerpt) - 1 AS b FROM citations t JOIN clauses c USING (clause_id) WHERE excerpt <> '' AND contains(verbatim_text, excerpt)"),
    ("opened", "SELECT *, CASE WHEN a > coalesce(max(b) OVER (PARTITION BY clause_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN a END AS o FROM spans_cited"),
    ("places", "SELECT DISTINCT row_id, clause_id || ':' || max(o) OVER (PARTITION BY clause_id ORDER BY a, b) AS place FROM opened"),
    ("asked_there", f"SELECT place, row_id, list_sort(list_distinct(list_filter(string_split({KEY.format('question')}, ' '), lambda x: x <> ''))) AS tokens FROM qa JOIN places USING (row_id)"),
    ("firsts!", "SELECT place, tokens, min(row_id) AS row_id FROM asked_there WHERE len(tokens) > 0 GROUP BY place, tokens"),
)
_ORIGIN = "CASE WHEN doc_id % 5 = 0 THEN 'hand' WHEN doc_id % 5 < 3 THEN 'pageindex_tree' ELSE 'gap_fill_content' END"
_TASKS = "SELECT row_id, unnest(['grounding', 'category_fit', 'clarity', 'citation_accuracy'] || CASE category WHEN 'B' THEN ['clarifier_quality'] WHEN 'C' THEN ['ambiguity_framing'] ELSE [] END) AS judge FROM qa"
_RATES = "SELECT round, category, count(*) AS n, count(*) FILTER (verdict = 'pass') AS passed FROM verdicts GROUP BY GROUPING SETS ((round, category), (round))"
_FLIP = "CASE WHEN before IS NULL THEN CASE WHEN round > (SELECT min(round) FROM verdicts) THEN 'new' END WHEN before <> verdict THEN CASE WHEN verdict = 'pass' THEN 'fixed' ELSE 'broken' END END"
_EXPECTED = "SELECT 'grounding' AS judge, 'small' AS model, 1200 AS input_tokens, 90 AS output_tokens UNION ALL SELECT 'clarity', 'large', 800, 60 UNION ALL SELECT 'clarifier_quality', 'unpriced', 900, 70"

QUERIES = {
    "j1_judge_tasks": (_tasks, with_tables(_TASKS)),
    "j2_cited_text": (
        lambda t: scores.cited_text(t.qa, t.citations, t.clauses),
        with_tables("SELECT row_id, coalesce(cited, '(none)') AS cited FROM qa LEFT JOIN (SELECT row_id, string_agg('### ' || clause_id || chr(10) || verbatim_text, chr(10) || chr(10) ORDER BY place) AS cited FROM (SELECT row_id, clause_id, min(branch_pos * 1000 + cite_pos) AS place FROM citations GROUP BY row_id, clause_id) x JOIN clauses USING (clause_id) GROUP BY row_id) y USING (row_id)"),
    ),
    "j3_flatten_scores": (lambda t: scores.flatten_scores(_nested(t)), with_tables("SELECT row_id, judge || '.' || dim AS key, score FROM scores")),
    "j4_unflatten_scores": (
        lambda t: scores.unflatten_scores(t.scores.select("row_id", F.when(F.col("row_id") % 2 == 0, F.concat_ws(".", "judge", "dim", F.lit("x"))).otherwise(F.col("dim")).alias("key"), "score")),
        with_tables("SELECT row_id, CASE WHEN row_id % 2 = 0 THEN judge ELSE dim END AS judge, CASE WHEN row_id % 2 = 0 THEN dim || '.x' ELSE dim END AS dim, score FROM scores"),
    ),
    "j5_composite": (lambda t: scores.composite(t.people, t.scores), with_tables("SELECT row_id, category, composite FROM comp", _COMPOSITE)),
    "j6_failure_flags": (lambda t: _flags(t).select("row_id", F.array_join("flags", ",").alias("flags")), with_tables("SELECT * FROM flagged", _FLAGS)),
    "j7_composite_by_category": (
        lambda t: scores.composite_by_category(_composites(t), t.categories).withColumn("mean", F.round("mean", 6)),
        with_tables("SELECT category, count(row_id) AS n, round(coalesce(avg(composite), 0), 6) AS mean, coalesce(min(composite), 0) AS low, coalesce(max(composite), 0) AS high FROM categories LEFT JOIN comp USING (category) GROUP BY category", _COMPOSITE),
    ),
    "j8_dim_distribution": (lambda t: scores.dim_distribution(t.scores), with_tables("SELECT dim, " + ", ".join(f"count(*) FILTER (score = {s}) AS s{s}" for s in range(1, 6)) + " FROM scores GROUP BY dim")),
    "j8_low_rows": (lambda t: scores.low_rows(t.scores), with_tables("SELECT row_id FROM scores GROUP BY row_id HAVING min(score) <= 2")),
    "k1_score_pairs": (rated_pairs, with_tables("SELECT * FROM pairs", _PAIRS)),
    "k2_agreement": (
        lambda t: agreement.agreement(rated_pairs(t)).select("dim", "exact", "within_1", "n"),
        with_tables("SELECT dim, round(avg(CASE WHEN a = b THEN 1 ELSE 0 END), 3) AS exact, round(avg(CASE WHEN abs(a - b) <= 1 THEN 1 ELSE 0 END), 3) AS within_1, count(*) AS n FROM pairs GROUP BY dim", _PAIRS),
    ),
    "k3_quadratic_kappa": (lambda t: agreement.quadratic_kappa(rated_pairs(t)), with_tables(f"SELECT dim, {_KAPPA} AS kappa, count(*) AS n FROM pairs GROUP BY dim", _PAIRS)),
    "k4_confusion": (lambda t: agreement.confusion(rated_pairs(t)), with_tables("SELECT dim, a, b, count(*) AS n FROM pairs GROUP BY dim, a, b", _PAIRS)),
    "k5_injected_catch_rate": (
        lambda t: agreement.catch_rate(_labels(t), _label_scores(t)),
        with_tables(f"SELECT count(*) AS n, count(*) FILTER (caught) AS n_caught, count(*) FILTER (caught) / count(*) AS rate FROM (SELECT {_KINDS} AS injected, CASE doc_id % 6 WHEN 3 THEN FALSE ELSE 1 + 3 * quality + toxic <= 2 END AS caught FROM labels) x WHERE injected IS NOT NULL"),
    ),
    "k6_sample_rows": (lambda t: agreement.sample_rows(t.labels.select("doc_id"), 0.2, 11, "doc_id"), "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256('11:' || doc_id), doc_id) AS n, count(*) OVER () AS total FROM labels) x WHERE n <= greatest(1, CAST(floor(total * 0.2) AS BIGINT))"),
    "k7_disagreements": (lambda t: agreement.disagreements(rated_pairs(t)), with_tables("SELECT * FROM pairs WHERE abs(a - b) >= 2", _PAIRS)),
    "k7_cross_rater": (
        lambda t: agreement.cross_rater(rated_pairs(t), agreement.sample_rows(t.events.select(F.col("event_id").alias("row_id")), 0.2, 42)),
        with_tables(f"SELECT dim, round({_KAPPA}, 3) AS kappa, count(*) AS n, count(*) FILTER (abs(a - b) >= 2) AS n_apart FROM pairs WHERE row_id IN (SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY sha256('42:' || event_id), event_id) AS k, count(*) OVER () AS total FROM events) x WHERE k <= greatest(1, CAST(floor(total * 0.2) AS BIGINT))) GROUP BY dim", _PAIRS),
    ),
    "f1_worst_k": (lambda t: catalogue.worst_k(_composites(t)).select("row_id", "category", "worst_rank", "composite"), with_tables("SELECT row_id, category, worst_rank, composite FROM worst WHERE worst_rank <= 3", _COMPOSITE, _WORST)),
    "f2_lowest_dims": (lambda t: catalogue.lowest_dims(t.scores), with_tables("SELECT * FROM low WHERE dim_rank <= 3", _LOW)),
    "f3_mitigation": (lambda t: catalogue.mitigation(catalogue.lowest_dims(t.scores), _ADVICE), with_tables("SELECT * FROM mitigated", _LOW, _MITIGATED)),
    "f4_catalogue": (
        lambda t: catalogue.catalogue(t.people.withColumn("seed_clause_ids", F.array("seed1", "seed2")), _composites(t), t.scores, _flags(t), _ADVICE),
        with_tables(
            "SELECT w.row_id, w.category, worst_rank, composite, question, answer, CASE WHEN clarifying_question IS NULL THEN '' ELSE clarifying_question || ' (axis: ' || clarification_axis || ')' END AS clarifier, passed, regen_count, seed1 || ',' || seed2 AS seeds, coalesce(l.low_dims, '') AS low_dims, coalesce(f.flags, '') AS flags, coalesce(m.mitigation, 'review by hand') AS mitigation FROM worst w JOIN people p ON p.row_id = w.row_id LEFT JOIN (SELECT row_id, string_agg(dim || '=' || score, ', ' ORDER BY dim_rank) AS low_dims FROM low WHERE dim_rank <= 3 GROUP BY row_id) l ON l.row_id = w.row_id LEFT JOIN flagged f ON f.row_id = w.row_id LEFT JOIN mitigated m ON m.row_id = w.row_id WHERE worst_rank <= 3",
            _COMPOSITE, _WORST, _LOW, _FLAGS, _MITIGATED,
        ),
    ),
    "m1_call_cost": (lambda t: _costed(t).select("started", "model", "cost_usd"), with_tables("SELECT started, model, cost_usd FROM costed", _COSTED)),
    "m2_stage_rollup": (lambda t: _rounded(costs.stage_rollup(_costed(t))), with_tables("SELECT stage, model, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(latency_ms) AS BIGINT) AS latency_ms, round(sum(cost_usd), 6) AS cost_usd, CAST(sum(greatest(count, 1)) AS BIGINT) AS count FROM costed GROUP BY stage, model", _COSTED)),
    "m3_run_totals": (lambda t: _rounded(costs.run_totals(_costed(t))), with_tables("SELECT CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, round(sum(cost_usd), 6) AS cost_usd, CAST(sum(greatest(count, 1)) AS BIGINT) AS calls, max(ended) - min(started) AS wall_ms FROM costed", _COSTED)),
    "m4_combine_runs": (
        lambda t: _rounded(costs.combine_runs(_costed(t))),
        with_tables("SELECT run, CAST(sum(greatest(count, 1)) AS BIGINT) AS calls, round(sum(cost_usd), 6) AS cost_usd, CASE WHEN run IS NOT NULL THEN max(ended) - min(started) END AS wall_ms FROM costed GROUP BY ROLLUP (run)", _COSTED),
    ),
    "m5_cost_estimate": (
        lambda t: _rounded(costs.cost_estimate(_tasks(t), t.spark.sql(_EXPECTED), t.prices)),
        with_tables("SELECT judge, count(*) AS n, round(count(*) * coalesce(any_value(input_tokens / 1e6 * input_per_mtok + output_tokens / 1e6 * output_per_mtok), 0.0), 6) AS cost_usd FROM tasks JOIN expected USING (judge) LEFT JOIN prices USING (model) GROUP BY judge", ("tasks", _TASKS), ("expected", _EXPECTED)),
    ),
    "a1_audit_pass_rates": (lambda t: audit.audit_pass_rates(t.verdicts), with_tables("SELECT *, n - passed AS failed, passed / n AS rate FROM r", ("r", _RATES))),
    "a2_audit_delta": (lambda t: audit.audit_delta(t.verdicts), with_tables("SELECT round, category, passed, passed - lag(passed) OVER (PARTITION BY category ORDER BY round) AS change FROM r", ("r", _RATES))),
    "a3_verdict_flips": (lambda t: audit.verdict_flips(t.verdicts), with_tables(f"SELECT round, id, flip FROM (SELECT round, id, {_FLIP} AS flip FROM (SELECT *, lag(verdict) OVER (PARTITION BY id ORDER BY round) AS before FROM verdicts) x) y WHERE flip IS NOT NULL")),
    "a4_id_reconcile": (
        lambda t: audit.id_reconcile(t.labels.select(F.col("doc_id").alias("id")), t.qa.select(F.col("conv_id").alias("id"))),
        with_tables("SELECT doc_id AS id, 'left' AS side FROM labels WHERE doc_id NOT IN (SELECT conv_id FROM qa) UNION SELECT conv_id, 'right' FROM qa WHERE conv_id NOT IN (SELECT doc_id FROM labels)"),
    ),
    "a5_id_contiguity": (
        lambda t: audit.id_contiguity(t.qa.selectExpr("category", "CASE WHEN category = 'A' THEN id ELSE category || '-' || row_number() OVER (PARTITION BY category ORDER BY seq) END AS id")),
        with_tables("SELECT category, count(*) AS n, category <> 'A' OR (min(k) = 1 AND max(k) = count(*) AND count(DISTINCT k) = count(*)) AS contiguous FROM (SELECT category, CAST(regexp_extract(id, '-(\\d+)$', 1) AS BIGINT) AS k FROM qa) x GROUP BY category"),
    ),
    "a6_category_balance": (lambda t: audit.category_balance(t.qa, t.categories.select("category", F.lit(80).cast("long").alias("want"))), with_tables("SELECT category, count(row_id) AS have, CAST(80 AS BIGINT) AS want, count(row_id) - 80 AS difference FROM categories LEFT JOIN qa USING (category) GROUP BY category")),
    "a7_claims_check": (
        lambda t: audit.claims_check(t.categories.select("category", F.lit(3.0).alias("claimed")), scores.composite_by_category(_composites(t), t.categories)).withColumn("mean", F.round("mean", 6)),
        with_tables("SELECT category, CAST(3.0 AS DOUBLE) AS claimed, round(mean, 6) AS mean FROM (SELECT category, coalesce(avg(composite), 0) AS mean FROM categories LEFT JOIN comp USING (category) GROUP BY category) x WHERE abs(3.0 - mean) > 0.02", _COMPOSITE),
    ),
    "a8_undisclosed_failures": (
        lambda t: audit.undisclosed_failures(t.verdicts, t.people.select(F.concat_ws(" ", F.lit("known:"), F.concat_ws("-", "category", (F.col("row_id") * 2).cast("string")), F.lit(".")).alias("text"))),
        with_tables("SELECT DISTINCT id FROM verdicts WHERE verdict = 'fail' AND id NOT IN (SELECT category || '-' || (row_id * 2) FROM people)"),
    ),
    "a9_section_buckets": (
        lambda t: audit.section_buckets(_seeded(t), t.clauses.select("clause_id", (F.col("doc_id") % 60).alias("section"))),
        with_tables("SELECT section, coalesce(n, 0) AS n_rows, coalesce(n, 0) <= 1 AS gap FROM (SELECT DISTINCT doc_id % 60 AS section FROM clauses) s LEFT JOIN (SELECT doc_id % 60 AS section, count(DISTINCT row_id) AS n FROM seeded JOIN clauses USING (clause_id) GROUP BY 1) u USING (section)", _SEEDED),
    ),
    "a10_topic_distribution": (lambda t: audit.topic_distribution(_seeded(t), t.clauses), with_tables("SELECT topic, count(*) AS n FROM (SELECT unnest(topics) AS topic FROM seeded JOIN clauses USING (clause_id)) x GROUP BY topic", _SEEDED)),
    "a11_seed_reuse": (lambda t: audit.seed_reuse(_seeded(t)), with_tables("SELECT least(seed1, seed2) || '|' || greatest(seed1, seed2) AS seeds, count(*) AS n FROM qa GROUP BY 1 HAVING count(*) > 1")),
    "a12_wasted_slots": (
        lambda t: audit.wasted_slots(t.documents.selectExpr("doc_id AS row_id", "doc_id AS seq", "lang AS seed", "text AS question")),
        with_tables("SELECT * FROM near", *near_tables(0.5)),
    ),
    "a12_same_excerpt": (
        lambda t: audit.same_excerpt_slots(t.qa, t.citations, t.clauses, 0.1),
        with_tables("SELECT DISTINCT earlier, later, similarity FROM (SELECT x.row_id AS earlier, y.row_id AS later, len(list_intersect(x.tokens, y.tokens)) / (len(x.tokens) + len(y.tokens) - len(list_intersect(x.tokens, y.tokens))) AS similarity FROM firsts x JOIN firsts y ON x.place = y.place AND x.row_id < y.row_id) z WHERE similarity >= 0.1", *_PLACES),
    ),
    "a13_same_excerpt_branches": (lambda t: audit.same_excerpt_branches(t.citations), with_tables("SELECT row_id, excerpt FROM citations WHERE branch_pos > 0 GROUP BY row_id, excerpt HAVING count(DISTINCT branch_pos) > 1")),
    "a14_seed_provenance": (
        lambda t: audit.seed_provenance(_seeded(t), t.clauses.selectExpr("clause_id", f"{_ORIGIN} AS origin")),
        with_tables(f"SELECT *, n / sum(n) OVER (PARTITION BY category) AS share FROM (SELECT category, {_ORIGIN} AS origin, count(*) AS n FROM seeded JOIN clauses USING (clause_id) GROUP BY 1, 2) x", _SEEDED),
    ),
    "a15_label_set_check": (
        lambda t: audit.label_set_check(_labels(t), t.labels.select(F.col("doc_id").alias("row_id"), F.when(F.col("toxic") == 1, F.array(F.lit("bad"))).otherwise(F.array().cast("array<string>")).alias("errors"))),
        f"SELECT CASE WHEN g = 1 THEN 'all' ELSE coalesce(injected, 'none') END AS kind, n, n_injected, n_invalid FROM (SELECT injected, grouping(injected) AS g, count(*) AS n, count(injected) AS n_injected, count(*) FILTER (toxic = 1) AS n_invalid FROM (SELECT {_KINDS} AS injected, toxic FROM labels) x GROUP BY ROLLUP (injected)) y",
    ),
}
