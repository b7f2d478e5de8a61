"""Queries over files: readers and writers in the shared folder, the schema of nested rows, and a whole round. Each entry is (query, comparison SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundwork.jobs.bindings import PROVIDER, Tables, with_tables
from groundwork.jobs.rounds import flat_branches, folder_for, run_round, stored_rows
from groundwork.jobs.row_queries import ERROR_SQL, FULL, reports
from groundwork.jobs.score_queries import rated_pairs
from groundwork.operators import agreement, schema_gate, validate
from groundwork.sources import io

_BRANCHES = "(SELECT row_id, count(*) AS n FROM branches GROUP BY row_id)"
_OWN = "(SELECT row_id, count(*) AS n, string_agg(coalesce(clause_id, '-') || '=' || excerpt, '|' ORDER BY cite_pos) AS cites FROM citations WHERE branch_pos = 0 GROUP BY row_id)"
_INSIDE = [
    ("EXISTS (SELECT 1 FROM citations t WHERE t.row_id = q.row_id AND t.branch_pos = 0 AND t.cite_pos = 2 AND q.row_id % 5 = 0)", "clause_citations.relevance: unknown"),
    ("EXISTS (SELECT 1 FROM branches b WHERE b.row_id = q.row_id AND b.branch_pos = 2 AND q.row_id % 10 = 1)", "answer_branches: incomplete"),
    ("q.ambiguity_type IS NOT NULL AND q.conv_id % 8 = 1", "ambiguity: incomplete"),
    ("q.conv_id % 21 = 2", "generation_meta: incomplete"),
]
_NESTED = ("nested", "SELECT row_id, id, category, concat_ws('; ', CASE WHEN errors <> '' THEN errors END, " + ", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in _INSIDE) + ") AS errors FROM (SELECT e.*, q.conv_id, q.ambiguity_type FROM errs e JOIN qa q USING (row_id)) q")
_PRICES = "SELECT s_suppkey % 25 AS bucket, 'm' || s_suppkey AS model, s_acctbal / 100 AS input_per_mtok, s_acctbal / 20 AS output_per_mtok FROM {supplier}"
_CURATED = "SELECT doc_id, sha256(coalesce(text, '')) AS source_sha256 FROM documents"


def _clause_files(t: Tables):
    """The clauses of each document as one line {meta, clauses}, read again; a document's clauses are one value there."""
    one = F.struct("clause_id", "title", "verbatim_text", F.col("line_start").cast("int").alias("line_start"), F.col("line_end").cast("int").alias("line_end"), "parent", "topics")
    listed = t.clauses.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", one.alias("c")))), lambda x: x["c"]).alias("clauses"))
    hashed = listed.join(t.documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("source_md_sha256")), "doc_id")
    path = folder_for(t, "clauses")
    hashed.select(F.to_json(F.struct(F.struct("source_md_sha256", F.lit("2026-01-01").alias("curated_at")).alias("meta"), "clauses"))).write.text(path)
    return io.read_clauses(t.spark, path, by_line=True)


def _labels(t: Tables):
    path = folder_for(t, "labels")
    row = F.struct(F.concat(F.lit("A-"), "doc_id").alias("id"), F.lit("A").alias("category"))
    t.labels.select(row.alias("row"), F.struct("quality", "toxic").alias("human_scores"), F.lit("by hand").alias("notes"), F.when(F.col("toxic") == 1, "wrong_citation").alias("injected_failure")).write.json(path)
    return io.read_labels(t.spark, path)


def _pricing(t: Tables):
    path = folder_for(t, "pricing")
    told = t.spark.sql(_PRICES, supplier=t.supplier)
    table = F.map_from_entries(F.collect_list(F.struct("model", F.struct("input_per_mtok", "output_per_mtok"))))
    told.groupBy("bucket").agg(F.to_json(table).alias("value")).repartition("bucket").write.partitionBy("bucket").text(path)
    return io.read_pricing(t.spark, f"{path}/*")


def _written_dataset(t: Tables):
    rows, path = stored_rows(t), folder_for(t, "dataset")
    io.write_dataset(rows, schema_gate.nested_schema_errors(rows), path, "row_id")
    return io.read_rows(t.spark, path, rows.schema)


def _dropped(t: Tables):
    path, report = folder_for(t, "dropped"), reports(t)
    gone = validate.dropped_rows(t.qa.select("row_id", "category"), report)
    for half in (0, 1):  # two rounds append to one folder
        io.write_dropped(gone.where(F.col("row_id") % 2 == half), path)
    return t.spark.read.schema("row_id long, category string, reasons array<string>").json(path).select("row_id", "category", F.array_join("reasons", "; ").alias("reasons"))


def _schema_failures(t: Tables):
    path = folder_for(t, "schema-failures")
    io.write_schema_failures(schema_gate.schema_errors(t.qa, t.citations), path)
    return t.spark.read.schema("id string, errors array<string>").json(path).select("id", F.array_join("errors", "; ").alias("errors"))


def _report_tables(t: Tables):
    folder, pairs = folder_for(t, "report"), rated_pairs(t)
    io.write_reports({"agreement": agreement.agreement(pairs).select("dim", "exact", "within_1", "n"), "confusion": agreement.confusion(pairs)}, folder)
    read = {name: t.spark.read.parquet(f"{folder}/{name}") for name in ("agreement", "confusion")}
    return read["agreement"].select("dim", "n").join(read["confusion"].groupBy("dim").agg(F.sum("n").alias("n_confusion"), F.count("*").alias("cells")), "dim")


def _round(t: Tables):
    rows = stored_rows(t)
    return run_round(rows, t.clauses, folder_for(t, "round"), PROVIDER)


_STATES = """SELECT r.row_id, CASE WHEN NOT r.passed THEN 'dropped' WHEN r.place > 15 THEN 'over_quota' WHEN n.errors <> '' THEN 'schema_failure' ELSE 'written' END AS state
FROM (SELECT *, row_number() OVER (PARTITION BY category, passed ORDER BY seq) AS place FROM report) r JOIN nested n USING (row_id)"""

QUERIES = {
    "s1_read_rows": (
        lambda t: stored_rows(t).select("row_id", "id", "category", "question", "answer", F.size(F.coalesce("answer_branches", F.array().cast("array<struct<axis_value: string, answer: string, clause_citations: array<" + io.CITATION + ">>>"))).alias("n_branches"), F.array_join(F.transform("clause_citations", lambda c: F.concat(F.coalesce(c["clause_id"], F.lit("-")), F.lit("="), c["verbatim_excerpt"])), "|").alias("cites"), "ambiguity.what_is_missing", F.array_join("generation_meta.seed_clause_ids", ",").alias("seeds"), F.col("generation_meta.tokens.input").alias("tokens_in")),
        with_tables(f"SELECT q.row_id, q.id, q.category, q.question, q.answer, CAST(coalesce(b.n, 0) AS INT) AS n_branches, coalesce(o.cites, '') AS cites, CASE WHEN ambiguity_type IS NOT NULL AND conv_id % 8 <> 1 THEN 'what is missing' END AS what_is_missing, seed1 || ',' || seed2 AS seeds, 10 AS tokens_in FROM qa q LEFT JOIN {_BRANCHES} b ON b.row_id = q.row_id LEFT JOIN {_OWN} o ON o.row_id = q.row_id"),
    ),
    "s2_read_clauses": (lambda t: _clause_files(t).select("source_sha256", "pos", "clause_id", "title", "verbatim_text", "line_start", "line_end", "parent", F.array_join(F.array_sort("topics"), ",").alias("topics")), with_tables(f"SELECT source_sha256, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INT) AS pos, clause_id, title, verbatim_text, CAST(line_start AS INT) AS line_start, CAST(line_end AS INT) AS line_end, parent, array_to_string(list_sort(topics), ',') AS topics FROM clauses JOIN ({_CURATED}) h USING (doc_id)")),
    "s4_read_labels": (lambda t: _labels(t).select("row_id", "category", "injected", F.col("human_scores")["quality"].alias("quality"), F.col("human_scores")["toxic"].alias("toxic"), "notes"), "SELECT 'A-' || doc_id AS row_id, 'A' AS category, CASE WHEN toxic = 1 THEN 'wrong_citation' END AS injected, quality, toxic, 'by hand' AS notes FROM labels"),
    "s5_read_pricing": (_pricing, "SELECT model, input_per_mtok, output_per_mtok FROM (" + _PRICES.format(supplier="supplier") + ") p"),
    "s6_write_dataset": (lambda t: _written_dataset(t).select("row_id", "id", "question"), with_tables("SELECT q.row_id, q.id, q.question FROM qa q JOIN nested n ON n.row_id = q.row_id WHERE n.errors = ''", ERROR_SQL, _NESTED)),
    "s7_write_dropped": (_dropped, with_tables("SELECT row_id, category, reasons FROM report WHERE NOT passed", *FULL)),
    "s8_write_schema_failures": (_schema_failures, with_tables("SELECT id, errors FROM errs WHERE errors <> ''", ERROR_SQL)),
    "s9_write_reports": (_report_tables, with_tables("SELECT dim, count(*) AS n, CAST(count(*) AS BIGINT) AS n_confusion, count(DISTINCT a * 10 + b) AS cells FROM rated WHERE b IS NOT NULL GROUP BY dim")),
    "sc1_nested_errors": (lambda t: schema_gate.nested_schema_errors(stored_rows(t)).select("row_id", "id", F.array_join("errors", "; ").alias("errors")), with_tables("SELECT row_id, id, errors FROM nested", ERROR_SQL, _NESTED)),
    "w1_branches": (lambda t: flat_branches(stored_rows(t)), with_tables("SELECT row_id, branch_pos, answer FROM branches")),
    "w1_citations": (lambda t: validate.flatten_citations(stored_rows(t)), with_tables("SELECT row_id, branch_pos, CAST(row_number() OVER (PARTITION BY row_id, branch_pos ORDER BY cite_pos) - 1 AS INT) AS cite_pos, clause_id, excerpt FROM citations WHERE branch_pos = 0 OR EXISTS (SELECT 1 FROM branches b WHERE b.row_id = citations.row_id AND b.branch_pos = citations.branch_pos)")),
    "w1_round": (_round, with_tables(_STATES, *FULL, ERROR_SQL, _NESTED)),
}
