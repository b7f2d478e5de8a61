"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm import bit_planes, fill_in_middle, golomb, hashed_bpe, lexicon, ppm, reply_trees, simhash_bk, subword_classifier, token_counts, vector_codes, warc_chunks, winnowing
from groundwork.llm.common import reading, staged

WORD_BPE, BYTE_BPE, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(reading(spark, sf_dir, "documents", "doc_id", "text"), ppm.held_out())


def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reading(spark, sf_dir, "documents", "doc_id", "text")
    labels = reading(spark, sf_dir, "labels", "doc_id", "quality")
    out = subword_classifier.held_out()
    scored = subword_classifier.score(docs, subword_classifier.fit(docs, labels, learn_from=~out))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reading(spark, sf_dir, "documents", "doc_id", "text")
    folder, manifest = bit_planes.write_token_files(docs, public_tokenizers.path(WORD_BPE), end_id=2)
    return bit_planes.read_token_files(spark, folder, manifest, digest_only=True)


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = reading(spark, sf_dir, "pages", "page_id", "url", "html")
    folder, manifest = warc_chunks.write_archives(warc_chunks.chunk_table(pages))
    return warc_chunks.read_archives(spark, folder, manifest)


_BITS = "array_to_string(list_transform(string_split(x, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', c) - 3, 4)), '')"
_FIVE = " + ".join(f"{1 << (4 - j)} * CAST(substr(b, 5 * i + {j + 1}, 1) AS INT)" for j in range(5))
OP4_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
q AS (SELECT page_id, h, {_BITS} AS b, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM q
"""


def op5_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reading(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path(WORD_BPE)
    encoded = lexicon.encode(docs, path, lexicon.build_lexicon(docs, path))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_golomb_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golomb.exact_duplicates(reading(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, length(t) AS n_chars, sha256(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM d),
g AS (SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
      first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = reading(spark, sf_dir, "documents", "doc_id", "text"), reading(spark, sf_dir, "benchmark", "item_id", "text")
    found = winnowing.contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
m AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM m)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS t FROM (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT dw.k, dw.n, dw.i, iw.item_id FROM dw JOIN iw ON dw.t = iw.t AND dw.n = iw.n),
p AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS q FROM (SELECT DISTINCT k, n, i FROM h)) GROUP BY k),
s AS (SELECT k, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (k) LEFT JOIN s USING (k)
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reading(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path(BYTE_BPE)).withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    messages = staged(reply_trees.conversations_as_trees(reading(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(added)), "messages")
    chosen = reply_trees.chosen_messages(messages)
    turns = chosen.join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    formatted = staged(reply_trees.format_paths(turns, ("tree", "leaf")), "formatted")
    return reply_trees.read_back(formatted, ("tree",)).select("tree.conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _escapes(col: str) -> str:
    """SQL for the number of backslashes that the template puts into a text."""
    return " + ".join(f"(length({col}) - length(replace({col}, '{c}', ''))) // {len(c)}" for c in ("\\", "]", "<s>", "</s>", "[INST", "[/INST"))


OP9_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
      sum(11 + length(role) + {_escapes('role')} + length(text) + {_escapes('text')}) AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""


def op10_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bk.near_duplicates(reading(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_hashed_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reading(spark, sf_dir, "documents", "doc_id", "text")
    table = hashed_bpe.share_table(spark, public_tokenizers.path(BYTE_RANKS))
    coded = hashed_bpe.encode(docs, table, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.vector_codes(reading(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    told = vector_codes.with_label_errors(coded)
    return told.select("vec_id", vector_codes.code_text(F.col("codes")).alias("code"), F.col("errors").alias("error"), "label_error", F.lit(vector_codes.codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def _codes_sql(rounds: int) -> str:
    """The rounds one after the other; c: codebooks, a: assignments (distance and index in one number)."""
    tables = [
        "k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "p AS MATERIALIZED (SELECT k, q AS part, x, list_inner_product(x, x) AS xx FROM (SELECT k, q, v[q * (len(v) // 4) + 1 : (q + 1) * (len(v) // 4)] AS x FROM k, (SELECT unnest(range(4)) AS q) z) y)",
        "c0 AS MATERIALIZED (SELECT part, k - 1 AS e, x FROM p WHERE k <= 256)",
    ]
    for r in range(rounds + 1):
        tables.append(f"a{r} AS MATERIALIZED (SELECT p.k, p.part, min(CAST(p.xx - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT) * 256 + c.e) AS best FROM p JOIN c{r} c ON p.part = c.part GROUP BY p.k, p.part)")
        if r < rounds:
            tables.append(f"s{r} AS (SELECT part, e, i, floor(sum(x[i]) / count(*)) AS m FROM (SELECT a.part, a.best % 256 AS e, p.x, unnest(range(1, len(p.x) + 1)) AS i FROM a{r} a JOIN p ON p.k = a.k AND p.part = a.part) z GROUP BY part, e, i)")
            tables.append(f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.e, coalesce(n.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT part, e, list(m ORDER BY i) AS x FROM s{r} GROUP BY part, e) n ON n.part = c.part AND n.e = c.e)")
    last = f"f AS (SELECT k, string_agg(lpad(lower(to_hex(best % 256)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY k), b AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, e)) AS h FROM c{rounds})"
    return f"WITH {', '.join(tables)}, {last} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM k JOIN f USING (k), b"


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(reading(spark, sf_dir, "documents", "doc_id", "text"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))


_DRAWS = ", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST(len(u) AS BIGINT) AS n, {_DRAWS} FROM d),
c AS (SELECT *, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 AS plain, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM x),
s AS (SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 : n], '') AS z FROM c)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, CASE WHEN NOT plain THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN NOT plain THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN h4 % 100 < 20 THEN '<S>' || z || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || z || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM s
"""


QUERIES = {
    "op1_ppm": op1_ppm,
    "op2_subword_quality": op2_subword_quality,
    "op3_bit_planes": op3_bit_planes,
    "op4_warc_chunks": op4_warc_chunks,
    "op5_lexicon_bpe": op5_lexicon_bpe,
    "op6_golomb_dedup": op6_golomb_dedup,
    "op7_winnowing": op7_winnowing,
    "op8_token_counts": op8_token_counts,
    "op9_reply_trees": op9_reply_trees,
    "op10_simhash_bk": op10_simhash_bk,
    "op11_hashed_bpe": op11_hashed_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL = {
    "op4_warc_chunks": OP4_SQL,
    "op6_golomb_dedup": OP6_SQL,
    "op7_winnowing": OP7_SQL,
    "op9_reply_trees": OP9_SQL,
    "op12_vector_codes": _codes_sql(4),
    "op13_fill_in_middle": OP13_SQL,
}
