"""Source texts, their lines, and the integrity of clauses cut from them. Documents are doc_id, text; clauses are
doc_id, clause_id, pos, title, verbatim_text, line_start, line_end, parent, topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundwork.functions.text import text_or_empty
from groundwork.operators.greedy import numbered
from groundwork.operators.scans import ranged, running_max

LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
#: Lines of a block, by which spans and lines of a document meet.
BLOCK = 64
_DROPPED = ("script", "style", "nav", "footer", "head")
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_to_text(html: Column) -> Column:
    """Main text of a page: whole script, style, nav, footer and head elements, comments and all tags go, entities are resolved."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", " ")
    for tag in _DROPPED:
        out = F.regexp_replace(out, rf"(?is)<{tag}(\s[^>]*)?>.*?</{tag}>", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    for entity, char in _ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"[ \t\r\n\f]+", " "))


def empty_pages(pages: DataFrame) -> DataFrame:
    """page_id of the pages without any main text, which a fetch must report as an error."""
    return pages.where(html_to_text(F.col("html")) == "").select("page_id")


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 1) and line; a text that ends in a line end has no empty last line, an empty text no line.

    Line ends are those of Unicode: CR LF, LF, CR, VT, FF, the separators 1C to 1E, NEL, LS and PS.
    """
    cut = F.split(text_or_empty("text"), LINE_END)
    kept = F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)
    return docs.select("doc_id", F.posexplode(kept).alias("at", "line")).select("doc_id", (F.col("at") + 1).cast("long").alias("line_no"), "line")


def pin_source(docs: DataFrame) -> DataFrame:
    """doc_id, sha256, n_chars, n_lines (line ends + 1)."""
    t = text_or_empty("text")
    return docs.select("doc_id", F.sha2(t, 256).alias("sha256"), F.char_length(t).cast("long").alias("n_chars"), (F.char_length(t) - F.char_length(F.replace(t, F.lit("\n"))) + 1).cast("long").alias("n_lines"))


def source_drift(pinned: DataFrame, docs: DataFrame, clause_sets: DataFrame) -> DataFrame:
    """doc_id, recorded, now, curated: documents whose recorded hash, present hash and clause set's hash are not all equal."""
    now = pin_source(docs).select("doc_id", F.col("sha256").alias("now"))
    joined = pinned.select("doc_id", F.col("sha256").alias("recorded")).join(now, "doc_id").join(clause_sets.select("doc_id", F.col("sha256").alias("curated")), "doc_id")
    return joined.where("recorded <> now OR recorded <> curated").select("doc_id", "recorded", "now", "curated")


def not_verbatim(clauses: DataFrame, docs: DataFrame) -> DataFrame:
    """clause_id of the clauses whose text is not a substring of their source."""
    return clauses.select("doc_id", "clause_id", "verbatim_text").join(docs.select("doc_id", "text"), "doc_id").where(~F.contains(text_or_empty("text"), text_or_empty("verbatim_text"))).select("clause_id")


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    """id and n of the ids that occur more than once."""
    return df.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n")).where("n > 1")


def invalid_spans(clauses: DataFrame, docs: DataFrame) -> DataFrame:
    """clause_id, line_start, line_end where not 1 <= line_start <= line_end <= lines of the source."""
    counts = pin_source(docs).select("doc_id", "n_lines")
    ok = (F.col("line_start") >= 1) & (F.col("line_start") <= F.col("line_end")) & (F.col("line_end") <= F.col("n_lines"))
    return clauses.join(counts, "doc_id").where(~ok).select("clause_id", "line_start", "line_end")


def merged_spans(spans: DataFrame) -> DataFrame:
    """doc_id, line_start, line_end of the fewest spans that cover the same lines: overlapping and touching spans become one.

    A scan over ranges of (document, line), so that one document's spans need not lie in one task. A span that ends before it starts covers nothing.
    """
    order = ["line_start", "line_end"]
    told = running_max(ranged(spans.select("doc_id", *order).where("line_end >= line_start"), "doc_id", order), "doc_id", order, "line_end", "reached", False)
    opens = told.withColumn("opens", F.when(F.col("reached").isNull() | (F.col("line_start") > F.col("reached") + 1), F.col("line_start")))
    islands = running_max(opens, "doc_id", order, "opens", "island", True)
    return islands.groupBy("doc_id", "island").agg(F.min("line_start").alias("line_start"), F.max("line_end").alias("line_end")).drop("island")


def uncovered_lines(text_lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Lines in no span. Spans are merged first and met by document and block of 64 lines, so no long span is expanded line by line."""
    block = BLOCK
    islands = merged_spans(spans).withColumn("block", F.explode(F.sequence(F.floor(F.col("line_start") / block), F.floor(F.col("line_end") / block))))
    l, s = text_lines.withColumn("block", F.floor(F.col("line_no") / block)).alias("l"), islands.alias("s")
    same = (F.col("l.doc_id") == F.col("s.doc_id")) & (F.col("l.block") == F.col("s.block"))
    return l.join(s, same & F.col("l.line_no").between(F.col("s.line_start"), F.col("s.line_end")), "left_anti").drop("block")


def line_coverage(text_lines: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_lines (not blank), n_covered and share of them inside a span; a document without such lines has share 0.0."""
    full = text_lines.where(F.trim("line") != "")
    bare = uncovered_lines(full, spans).groupBy("doc_id").agg(F.count("*").alias("n_bare"))
    counted = full.groupBy("doc_id").agg(F.count("*").alias("n_lines")).join(bare, "doc_id", "left")
    covered = F.col("n_lines") - F.coalesce("n_bare", F.lit(0))
    return counted.select("doc_id", "n_lines", covered.alias("n_covered"), (covered / F.col("n_lines")).alias("share"))


def coverage_gaps(text_lines: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, line_start, line_end, title of the maximal runs of uncovered lines."""
    bare = uncovered_lines(text_lines, spans).select("doc_id", "line_no")
    runs = numbered(bare, "doc_id", ["line_no"], "n").withColumn("run", F.col("line_no") - F.col("n"))
    gaps = runs.groupBy("doc_id", "run").agg(F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"))
    return gaps.select("doc_id", "line_start", "line_end", F.format_string("SECTION: lines %d-%d", "line_start", "line_end").alias("title"))


def orphan_parents(clauses: DataFrame) -> DataFrame:
    """clause_id, parent of the clauses whose parent does not exist."""
    ids = clauses.select(F.col("clause_id").alias("parent")).distinct()
    return clauses.where("parent IS NOT NULL").join(ids, "parent", "left_anti").select("clause_id", "parent")


def without_orphans(clauses: DataFrame) -> DataFrame:
    """clause_id and parent, a parent that does not exist being null."""
    ids = clauses.select(F.col("clause_id").alias("parent"), F.lit(True).alias("there")).distinct()
    return clauses.join(ids, "parent", "left").select("clause_id", F.when(F.col("there"), F.col("parent")).alias("parent"))


def missing_topics(clauses: DataFrame, required: DataFrame) -> DataFrame:
    """topic of the required topics that no clause has."""
    return required.select("topic").distinct().join(clauses.select(F.explode("topics").alias("topic")).distinct(), "topic", "left_anti")


def tree_integrity(nodes: DataFrame, text_lines: DataFrame, docs: DataFrame) -> DataFrame:
    """Per document of nodes(doc_id, preorder, title, line_num, text): n_nodes, title_misses, order_breaks, duplicate_texts, covered_chars."""
    before = F.lag("line_num").over(Window.partitionBy("doc_id").orderBy("preorder"))
    again = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("preorder")) > 1
    placed = nodes.join(text_lines.select("doc_id", F.col("line_no").alias("line_num"), "line"), ["doc_id", "line_num"], "left")
    miss = ~F.coalesce(F.contains(F.col("line"), F.col("title")), F.lit(False))
    flagged = placed.withColumns({"miss": miss.cast("int"), "breaks": F.coalesce((F.col("line_num") <= before).cast("int"), F.lit(0)), "again": again.cast("int")})
    return flagged.groupBy("doc_id").agg(F.count("*").alias("n_nodes"), F.sum("miss").alias("title_misses"), F.sum("breaks").alias("order_breaks"), F.sum("again").alias("duplicate_texts"), F.sum(F.char_length("text")).alias("covered_chars")).join(pin_source(docs).select("doc_id", "n_chars"), "doc_id")


def overlapping(clauses: DataFrame, ranges: DataFrame) -> DataFrame:
    """Clauses with each line range of the same document that they overlap (both ends count); blocks of BLOCK lines bound what is compared."""
    left = clauses.withColumn("__block", F.explode(F.sequence(F.floor(F.col("line_start") / BLOCK), F.floor(F.col("line_end") / BLOCK))))
    right = ranges.withColumn("__other", F.explode(F.sequence(F.floor(F.col("range_start") / BLOCK), F.floor(F.col("range_end") / BLOCK)))).withColumnRenamed("doc_id", "__doc")
    first = F.greatest(F.floor(F.col("line_start") / BLOCK), F.floor(F.col("range_start") / BLOCK))
    met = (F.col("doc_id") == F.col("__doc")) & (F.col("__block") == F.col("__other")) & (F.col("line_end") >= F.col("range_start")) & (F.col("line_start") <= F.col("range_end"))
    return left.join(right, met & (F.col("__block") == first)).drop("__block", "__other", "__doc")


def not_overlapping(clauses: DataFrame, spans: DataFrame) -> DataFrame:
    """Clauses(doc_id, line_start, line_end, ...) without a line in common with any span of their document; spans are merged first, so that a block of BLOCK lines has few."""
    islands = merged_spans(spans).select(F.col("doc_id"), F.col("line_start").alias("range_start"), F.col("line_end").alias("range_end"))
    places = clauses.select("doc_id", "line_start", "line_end").distinct()
    hit = overlapping(places, islands).select("doc_id", "line_start", "line_end").distinct()
    return clauses.join(hit, ["doc_id", "line_start", "line_end"], "left_anti")


def merge_clause_sources(hand: DataFrame, sections: DataFrame, text_lines: DataFrame) -> DataFrame:
    """doc_id, line_start, line_end, origin: hand-made clauses, sections that overlap none of them, and gap-fill ranges for the rest."""
    cols = ["doc_id", "line_start", "line_end"]
    tree = not_overlapping(sections.select(*cols), hand.select(*cols)).withColumn("origin", F.lit("pageindex_tree"))
    kept = hand.select(*cols).withColumn("origin", F.lit("hand")).unionByName(tree)
    gaps = coverage_gaps(text_lines, kept).select(*cols).withColumn("origin", F.lit("gap_fill_content"))
    return kept.unionByName(gaps)


def topics_of(title: Column, least: int = 5) -> Column:
    """Distinct lower-case words of a title with at least `least` characters."""
    return F.array_distinct(F.filter(F.split(F.lower(title), r"[^\p{L}]+"), lambda w: F.char_length(w) >= least))
