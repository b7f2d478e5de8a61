"""Queries over source texts, clauses, the section tree, seeds and responses. Each entry is (query, comparison SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundwork.functions.text import SILENCE
from groundwork.jobs.bindings import Tables, with_tables
from groundwork.operators import parse, retrieve, seeds, source

_SHA = "sha256(coalesce(text, ''))"
_LEN = "length(coalesce(text, ''))"
_PINNED = f"SELECT doc_id, {_SHA} AS sha256, {_LEN} AS n_chars, {_LEN} - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS n_lines FROM documents"
_COVERED = "SELECT DISTINCT doc_id, unnest(range(line_start, line_end + 1)) AS line_no FROM {0}"
_GAPS = "SELECT doc_id, min(line_no) AS line_start, max(line_no) AS line_end FROM (SELECT doc_id, line_no, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM (SELECT doc_id, line_no FROM lines EXCEPT {0}) a) b GROUP BY doc_id, run"
_PAIRS = "SELECT a.clause_id AS first_id, b.clause_id AS second_id, count(*) AS n_shared, string_agg(a.topic, ',' ORDER BY a.topic) AS shared FROM ct a JOIN ct b ON a.doc_id = b.doc_id AND a.topic = b.topic AND a.pos < b.pos AND a.parent IS DISTINCT FROM b.clause_id GROUP BY ALL"
_CT = ("ct", "SELECT doc_id, clause_id, pos, parent, unnest(topics) AS topic FROM clauses")
#: A pass over the pairs in order that ends with the 40th accepted one; an end may be used twice.
_CAPPED = (
    ("ranked!", "SELECT first_id AS a, second_id AS b, row_number() OVER (ORDER BY n_shared DESC, sha256('7:' || first_id || ':' || second_id)) AS n FROM pairs"),
    (
        "pass",
        "SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS used, CAST([] AS BIGINT[]) AS taken UNION ALL SELECT r.n, CASE WHEN ok THEN p.used || [r.a, r.b] ELSE p.used END, CASE WHEN ok THEN list_append(p.taken, r.n) ELSE p.taken END "
        "FROM (SELECT p.*, r.n AS next, r.a, r.b, len(list_filter(p.used, lambda x: x = r.a)) < 2 AND len(list_filter(p.used, lambda x: x = r.b)) < 2 AS ok FROM pass p JOIN ranked r ON r.n = p.n + 1 WHERE len(p.taken) < 40) p, LATERAL (SELECT p.next AS n, p.a AS a, p.b AS b) r",
    ),
)
_MARKED = " OR ".join(f"contains(lower(verbatim_text), '{m}')" for m in SILENCE)
#: The prose holds none of the marks, so every fifth clause gets one.
_MARK = "CASE pos % 10 WHEN 0 THEN ' as per rule' WHEN 3 THEN ' reasonable' WHEN 5 THEN ' may suspend' WHEN 7 THEN ' in 12 days' ELSE '' END"
_MARKED_CLAUSES = ("marked", f"SELECT doc_id, clause_id, pos, verbatim_text || {_MARK} AS verbatim_text FROM clauses")
_SEED = "sha256('7:' || clause_id)"
_PREORDER = "tree AS (SELECT node_id, title, line_num, 0 AS depth, lpad(CAST(sibling_pos AS VARCHAR), 19, '0') AS path, title AS titles FROM edges WHERE parent_id IS NULL UNION ALL SELECT e.node_id, e.title, e.line_num, t.depth + 1, t.path || '/' || lpad(CAST(e.sibling_pos AS VARCHAR), 19, '0'), t.titles || ' > ' || e.title FROM edges e JOIN tree t ON e.parent_id = t.node_id)"
_HTML = "coalesce(html, '')"
for _pattern, _flags in [(r"<!--.*?-->", "gs")] + [(rf"<{t}(\s[^>]*)?>.*?</{t}>", "gsi") for t in ("script", "style", "nav", "footer", "head")] + [(r"<[^>]*>", "g")]:
    _HTML = f"regexp_replace({_HTML}, '{_pattern}', ' ', '{_flags}')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_entity}', '{_char}')"
_HTML = f"trim(regexp_replace({_HTML}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"


def _marked(t: Tables):
    return t.clauses.withColumn("verbatim_text", F.concat("verbatim_text", F.expr(_MARK)))


def _recorded(t: Tables, k: int):
    return source.pin_source(t.documents).withColumn("sha256", F.when(F.col("doc_id") % k == 0, F.lit("old")).otherwise(F.col("sha256")))


def _nodes(t: Tables):
    return t.clauses.select("doc_id", F.col("line_no").alias("preorder"), F.when(F.col("line_no") % 10 == 9, "nowhere").otherwise(F.col("title")).alias("title"), F.when(F.col("line_no") % 8 == 5, F.col("line_no") - 2).otherwise(F.col("line_no")).alias("line_num"), F.col("verbatim_text").alias("text"))


_NODES = ("nodes", "SELECT doc_id, line_no AS preorder, CASE WHEN line_no % 10 = 9 THEN 'nowhere' ELSE title END AS title, CASE WHEN line_no % 8 = 5 THEN line_no - 2 ELSE line_no END AS line_num, verbatim_text AS text FROM clauses")
_PARSED = (
    ("bare", "SELECT cand_id, content, CASE WHEN starts_with(trim(content), '```') THEN regexp_replace(trim(content), '```(json)?', '', 'g') ELSE trim(content) END AS b FROM responses"),
    ("sliced", "SELECT cand_id, content, CASE WHEN strpos(b, '{') > 0 AND strpos(b, '}') > 0 AND length(b) - strpos(reverse(b), '}') + 1 > strpos(b, '{') THEN substr(b, strpos(b, '{'), length(b) - strpos(reverse(b), '}') + 2 - strpos(b, '{')) END AS t FROM bare"),
    ("read", r"SELECT cand_id, content, t, CASE WHEN json_valid(t) THEN t WHEN json_valid(regexp_replace(t, ',(\s*[}\]])', '\1', 'g')) THEN regexp_replace(t, ',(\s*[}\]])', '\1', 'g') WHEN json_valid(regexp_replace(regexp_replace(t, ',(\s*[}\]])', '\1', 'g'), '[\x00-\x1F]', ' ', 'g')) THEN regexp_replace(regexp_replace(t, ',(\s*[}\]])', '\1', 'g'), '[\x00-\x1F]', ' ', 'g') END AS good FROM sliced"),
)
_TEMPLATE = "Q about {title} at {line} and {other}: {text} ({missing})"


def _rendered(t: Tables):
    values = {"title": F.col("title"), "text": F.col("verbatim_text"), "line": F.col("line_start"), "missing": F.lit(None).cast("string")}
    return t.clauses.select("clause_id", seeds.render(F.lit(_TEMPLATE), values).alias("prompt"))


def _excluded(t: Tables):
    return t.clauses.select("clause_id").where("endswith(clause_id, '#1')")


def _responses(t: Tables):
    return parse.parse_responses(t.responses)


def _used(t: Tables):
    return t.qa.select("row_id", "seq", "category", F.array("seed1", "seed2").alias("seed_clause_ids"))


def _topk(t: Tables):
    """Every document whose id is divisible by 20 is a query against all clauses."""
    asked = t.documents.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    return retrieve.keyword_topk(asked, t.clauses).select("query_id", "clause_id", "score", "rank")


QUERIES = {
    "s3_read_lines": (lambda t: t.lines, with_tables("SELECT * FROM lines")),
    "c1_html_to_text": (lambda t: t.pages.select("page_id", source.html_to_text(F.col("html")).alias("text")), f"SELECT page_id, {_HTML} AS text FROM pages"),
    "c1_empty_pages": (
        lambda t: source.empty_pages(t.pages.withColumn("html", F.when(F.col("page_id") % 9 == 0, F.concat(F.lit("<nav>"), F.substring_index("html", "<", 1), F.lit("menu</nav><p> </p>"))).otherwise(F.col("html")))),
        f"SELECT page_id FROM (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN '<nav>' || split_part(html, '<', 1) || 'menu</nav><p> </p>' ELSE html END AS html FROM pages) p WHERE {_HTML} = ''",
    ),
    "c2_pin_source": (lambda t: source.pin_source(t.documents), _PINNED),
    "c3_source_drift": (
        lambda t: source.source_drift(_recorded(t, 50), t.documents, _recorded(t, 70)),
        f"WITH p AS ({_PINNED}) SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 'old' ELSE sha256 END AS recorded, sha256 AS now, CASE WHEN doc_id % 70 = 0 THEN 'old' ELSE sha256 END AS curated FROM p WHERE doc_id % 50 = 0 OR doc_id % 70 = 0",
    ),
    "c4_verbatim_check": (lambda t: source.not_verbatim(t.clauses, t.documents), with_tables("SELECT clause_id FROM clauses c JOIN documents d USING (doc_id) WHERE NOT contains(coalesce(d.text, ''), verbatim_text)")),
    "c5_duplicate_ids": (lambda t: source.duplicate_ids(t.documents, "text").select(F.sha2("id", 256).alias("id"), "n"), "SELECT sha256(text) AS id, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1"),
    "c6_invalid_spans": (lambda t: source.invalid_spans(t.clauses, t.documents), with_tables(f"SELECT clause_id, line_start, line_end FROM clauses JOIN p USING (doc_id) WHERE NOT (line_start >= 1 AND line_start <= line_end AND line_end <= n_lines)", ("p", _PINNED))),
    "c7_line_coverage": (
        lambda t: source.line_coverage(t.lines, t.spans),
        with_tables("SELECT doc_id, count(*) AS n_lines, count(c.line_no) AS n_covered, count(c.line_no) / count(*) AS share FROM lines l LEFT JOIN c USING (doc_id, line_no) WHERE trim(line) <> '' GROUP BY doc_id", ("c", _COVERED.format("spans"))),
    ),
    "c8_coverage_gaps": (lambda t: source.coverage_gaps(t.lines, t.spans), with_tables("SELECT *, 'SECTION: lines ' || line_start || '-' || line_end AS title FROM g", ("g", _GAPS.format(_COVERED.format("spans"))))),
    "c9_orphan_parents": (lambda t: source.orphan_parents(t.clauses), with_tables("SELECT clause_id, parent FROM clauses WHERE parent IS NOT NULL AND parent NOT IN (SELECT clause_id FROM clauses)")),
    "c9_repaired_parents": (lambda t: source.without_orphans(t.clauses), with_tables("SELECT c.clause_id, p.clause_id AS parent FROM clauses c LEFT JOIN clauses p ON c.parent = p.clause_id")),
    "c10_missing_topics": (
        lambda t: source.missing_topics(t.clauses, t.pages.select(F.explode(source.topics_of(source.html_to_text(F.col("html")))).alias("topic"))),
        with_tables(rf"SELECT DISTINCT topic FROM (SELECT unnest(list_filter(string_split_regex(lower({_HTML}), '[^\p{{L}}]+'), lambda x: length(x) >= 5)) AS topic FROM pages) r WHERE topic NOT IN (SELECT topic FROM ct)", _CT),
    ),
    "c11_tree_integrity": (
        lambda t: source.tree_integrity(_nodes(t), t.lines, t.documents),
        with_tables(
            f"SELECT doc_id, count(*) AS n_nodes, CAST(sum(miss) AS BIGINT) AS title_misses, CAST(sum(breaks) AS BIGINT) AS order_breaks, CAST(sum(again) AS BIGINT) AS duplicate_texts, CAST(sum(length(text)) AS BIGINT) AS covered_chars, any_value(n_chars) AS n_chars FROM f JOIN p USING (doc_id) GROUP BY doc_id",
            _NODES,
            ("p", _PINNED),
            ("f", "SELECT n.doc_id, n.text, CASE WHEN contains(l.line, n.title) THEN 0 ELSE 1 END AS miss, CASE WHEN n.line_num <= lag(n.line_num) OVER (PARTITION BY n.doc_id ORDER BY preorder) THEN 1 ELSE 0 END AS breaks, CASE WHEN row_number() OVER (PARTITION BY n.doc_id, n.text ORDER BY preorder) > 1 THEN 1 ELSE 0 END AS again FROM nodes n LEFT JOIN lines l ON l.doc_id = n.doc_id AND l.line_no = n.line_num"),
        ),
    ),
    "c12_merge_clause_sources": (
        lambda t: source.merge_clause_sources(t.spans, t.sections, t.lines),
        with_tables(
            "SELECT doc_id, line_start, line_end, origin FROM k UNION ALL SELECT doc_id, line_start, line_end, 'gap_fill_content' FROM g",
            ("k", "SELECT doc_id, line_start, line_end, 'hand' AS origin FROM spans UNION ALL SELECT doc_id, line_start, line_end, 'pageindex_tree' FROM sections s WHERE NOT EXISTS (SELECT 1 FROM spans p WHERE p.doc_id = s.doc_id AND p.line_end >= s.line_start AND p.line_start <= s.line_end)"),
            ("g", _GAPS.format(_COVERED.format("k"))),
        ),
    ),
    "r1_clause_lookup": (lambda t: retrieve.clause_lookup(t.citations, t.clauses).select("clause_id", "title"), with_tables("SELECT clause_id, title FROM clauses WHERE clause_id IN (SELECT clause_id FROM citations)")),
    "r2_clauses_by_topic": (lambda t: retrieve.clauses_by_topic(t.clauses, "thing").select("clause_id"), with_tables("SELECT clause_id FROM clauses WHERE list_contains(topics, 'thing')")),
    "r3_keyword_topk": (
        _topk,
        with_tables(
            "SELECT query_id, clause_id, score, rank FROM s QUALIFY rank <= 5",
            ("q", "SELECT doc_id AS query_id, lower(text) AS q FROM documents WHERE doc_id % 20 = 0"),
            ("s0", "SELECT query_id, clause_id, pos, 2.0 * len(list_filter(topics, lambda x: contains(q, x))) + CASE WHEN contains(q, lower(title)) OR len(list_filter(string_split_regex(lower(title), '\\s+'), lambda w: w <> '' AND contains(q, w))) > 0 THEN 1.0 ELSE 0.0 END AS score FROM q, clauses"),
            ("s", "SELECT query_id, clause_id, CAST(score AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos) AS INT) AS rank FROM s0 WHERE score > 0"),
        ).replace(" QUALIFY", " WHERE"),
    ),
    "r4_pairs_by_shared_topic": (lambda t: retrieve.pairs_by_shared_topic(t.clauses, scope=["doc_id"]), with_tables(_PAIRS, _CT)),
    "r5_tree_sections": (
        lambda t: retrieve.tree_sections(t.edges).select("node_id", "title", "line_num", "depth", "has_children", "path"),
        with_tables("SELECT node_id, title, line_num, depth, node_id IN (SELECT parent_id FROM edges WHERE parent_id IS NOT NULL) AS has_children, path FROM tree").replace("edges AS (", "edges AS (", 1).replace("\nSELECT node_id, title, line_num, depth", ",\n" + _PREORDER + "\nSELECT node_id, title, line_num, depth"),
    ),
    "r5_tree_order": (
        lambda t: retrieve.tree_order(t.edges),
        with_tables("SELECT node_id, depth, row_number() OVER (ORDER BY path) - 1 AS preorder, node_id IN (SELECT parent_id FROM edges WHERE parent_id IS NOT NULL) AS has_children FROM tree").replace("\nSELECT node_id, depth, row", ",\n" + _PREORDER + "\nSELECT node_id, depth, row"),
    ),
    "r6_tree_navigate": (
        lambda t: retrieve.tree_navigate(retrieve.tree_sections(t.edges), t.edges.select("node_id", F.repeat("title", 30).alias("text")), "customer 1"),
        with_tables("SELECT node_id, titles AS title_path, substr(repeat(title, 30), 1, 200) AS preview FROM tree WHERE contains(lower(title), 'customer') AND contains(lower(title), '1')").replace("\nSELECT node_id, titles", ",\n" + _PREORDER + "\nSELECT node_id, titles"),
    ),
    "r7_clauses_in_line_range": (
        lambda t: retrieve.clauses_in_line_range(t.clauses, t.sections.select("doc_id", F.concat_ws(":", "doc_id", "line_start").alias("range_id"), F.col("line_start").alias("range_start"), F.col("line_end").alias("range_end"))),
        with_tables("SELECT s.doc_id || ':' || s.line_start AS range_id, clause_id FROM clauses c JOIN sections s ON c.doc_id = s.doc_id AND c.line_end >= s.line_start AND c.line_start <= s.line_end"),
    ),
    "r8_silence_candidates": (lambda t: retrieve.silence_candidates(_marked(t)).select("clause_id"), with_tables(f"SELECT clause_id FROM marked WHERE {_MARKED}", _MARKED_CLAUSES)),
    "r9_flat_tree": (lambda t: retrieve.flat_tree(t.clauses, ["doc_id"]), with_tables("SELECT doc_id, 'hc-' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS VARCHAR), 4, '0') AS node_id, title, line_start AS line_num, verbatim_text AS text FROM clauses")),
    "g1_numeric_anchors": (
        lambda t: seeds.numeric_anchors(_marked(t), 50, 7, _excluded(t)).select("clause_id"),
        with_tables(rf"SELECT clause_id FROM marked WHERE clause_id NOT LIKE '%#1' AND regexp_matches(verbatim_text, '(?i)\b\d+\s*(days?|%|percent|hours?|working\s+days?)\b') ORDER BY {_SEED} LIMIT 50", _MARKED_CLAUSES),
    ),
    "g2_scored_pairs": (lambda t: seeds.scored_pairs(t.clauses, 7, scope=["doc_id"]).select("first_id", "second_id", "n_shared", "draw"), with_tables("SELECT first_id, second_id, n_shared, sha256('7:' || first_id || ':' || second_id) AS draw FROM pairs", _CT, ("pairs", _PAIRS))),
    "g2_pair_selection": (lambda t: seeds.pair_selection(t.clauses, 40, 7, scope=["doc_id"]), with_tables("SELECT a, b FROM ranked WHERE list_contains((SELECT taken FROM pass ORDER BY n DESC LIMIT 1), n)", _CT, ("pairs", _PAIRS), *_CAPPED)),
    "g3_ambiguity_seeds": (
        lambda t: seeds.ambiguity_seeds(_marked(t), 60, 7, _excluded(t)),
        with_tables(
            f"SELECT clause_id, CASE WHEN NOT open THEN 'silent' WHEN contains(v, 'per rbi') OR contains(v, 'per npci') OR contains(v, 'as per') OR contains(v, 'in accordance with') THEN 'external_deferral' WHEN contains(v, 'reasonable') OR contains(v, 'as determined') OR contains(v, 'from time to time') THEN 'vague_language' ELSE 'silent' END AS hint FROM (SELECT clause_id, lower(verbatim_text) AS v, {_MARKED} AS open FROM marked WHERE clause_id NOT LIKE '%#1') x ORDER BY open DESC, {_SEED} LIMIT 60",
            _MARKED_CLAUSES,
        ),
    ),
    "g4_seed_exclusions": (lambda t: seeds.seed_exclusions(_used(t)), with_tables("SELECT DISTINCT category, CASE WHEN category = 'B' THEN least(seed1, seed2) || '|' || greatest(seed1, seed2) ELSE seed1 END AS key FROM qa")),
    "g5_deficits": (
        lambda t: seeds.deficits(t.qa, t.categories, 90),
        with_tables("SELECT category, have, need, greatest(need * 2, CAST(floor(need * 2.5) AS BIGINT)) AS attempts, CAST(ceil(90 * 1.5) AS BIGINT) AS first_run FROM (SELECT category, count(row_id) AS have, greatest(0, 90 - count(row_id)) AS need FROM categories LEFT JOIN qa USING (category) GROUP BY category) x"),
    ),
    "g6_render_prompts": (_rendered, with_tables(f"SELECT clause_id, replace(replace(replace(replace('{_TEMPLATE}', '{{title}}', title), '{{text}}', verbatim_text), '{{line}}', CAST(line_start AS VARCHAR)), '{{missing}}', '') AS prompt FROM clauses")),
    "p1_parse_responses": (
        lambda t: _responses(t).select("cand_id", F.col("error").isNull().alias("parses"), F.coalesce("parsed.question", F.lit("")).alias("question")),
        with_tables("SELECT cand_id, good IS NOT NULL AS parses, coalesce(json_extract_string(good, '$.question'), '') AS question FROM read", *_PARSED),
    ),
    "p1_repair_responses": (
        lambda t: parse.repair_responses(_responses(t)).select("cand_id", "repaired", F.col("error").isNull().alias("parses"), F.coalesce("parsed.question", F.lit("")).alias("question")),
        with_tables("SELECT cand_id, good IS NULL AND content = '{\"question\": oops }' AS repaired, good IS NOT NULL OR content = '{\"question\": oops }' AS parses, coalesce(CASE WHEN good IS NOT NULL THEN json_extract_string(good, '$.question') WHEN content = '{\"question\": oops }' THEN 'oops' END, '') AS question FROM read", *_PARSED),
    ),
    "p2_parse_rejects": (lambda t: parse.parse_rejects(_responses(t)), with_tables("SELECT cand_id, CASE WHEN t IS NULL THEN 'no JSON object' ELSE 'JSON does not parse' END AS error, content FROM read WHERE good IS NULL", *_PARSED)),
    "p3_self_rejects": (lambda t: parse.self_rejects(_responses(t)), with_tables("SELECT cand_id, substr(coalesce(json_extract_string(good, '$.reason'), ''), 1, 120) AS reason FROM read WHERE json_extract_string(good, '$.reject') = 'true'", *_PARSED)),
    "p4_normalise_rows": (
        lambda t: parse.normalise_rows(t.qa.withColumn("confidence", F.when(F.col("confidence") != "none", F.col("confidence")))).select("row_id", "answer", "clarifying_question", "clarification_axis", "ambiguity_type", "confidence", "should_escalate"),
        with_tables("SELECT row_id, CASE WHEN category <> 'B' THEN answer END AS answer, CASE WHEN category = 'B' THEN clarifying_question END AS clarifying_question, CASE WHEN category = 'B' THEN clarification_axis END AS clarification_axis, CASE WHEN category = 'C' THEN ambiguity_type END AS ambiguity_type, CASE WHEN category = 'C' THEN 'low' WHEN confidence <> 'none' THEN confidence WHEN category = 'A' THEN 'high' ELSE 'medium' END AS confidence, category = 'C' OR should_escalate AS should_escalate FROM qa"),
    ),
    "p5_assign_ids": (lambda t: parse.assign_ids(t.qa.drop("id")).select("row_id", "id"), with_tables("SELECT row_id, category || '-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS id FROM (SELECT row_id, category, row_number() OVER (PARTITION BY category ORDER BY seq) AS n FROM qa) x")),
}
