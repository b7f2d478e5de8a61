"""WARC archives, chat formatting and the corpus pipeline."""

import base64
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from groundwork.llm import reply_trees, warc_chunks


@pytest.mark.parametrize(("min_bytes", "chunk"), [(0, 65_536), (3, 2)])
def test_archives(spark, min_bytes, chunk):
    pages = [(1, "u", "<p>é</p>"), (2, None, ""), (3, "u 2\n", None), (9, "ü", "<p>é</p>"), (7, "u", "<p>é</p>"), (4, "u" * 9000, "ab"), (5, "u", "ab"), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (8, "u", "x" * 300_001), (8, "u", "x" * 300_001), (None, "u", "n")]
    df = spark.createDataFrame([(*p, "k", b"d") for p in pages], "page_id long, url string, html string, digest string, data binary").repartition(3)
    folder, manifest = warc_chunks.write_archives(warc_chunks.chunk_table(df, min_bytes=min_bytes, chunk=chunk), archive_bytes=1000)
    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        same = [j for j, _, h in pages if (h or "").encode() == body and j is not None]
        first = min(same) if same and len(body) >= min_bytes else i
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if first == i else "revisit", None if first == i else first))
    got = warc_chunks.read_archives(spark, folder, manifest)
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_a_broken_archive():
    import io

    with pytest.raises(ValueError, match="no record"):
        list(warc_chunks.records_of(io.BytesIO(b"junk\r\n\r\n")))
    head = b"WARC/1.1\r\nContent-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"
    with pytest.raises(ValueError, match="ends inside"):
        list(warc_chunks.records_of(io.BytesIO(head + b"short")))


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_chunks.read_archives(spark, *warc_chunks.write_archives(warc_chunks.chunk_table(df))).count() == 0


PIECES = st.lists(st.sampled_from(["</s>", "<s>", "[INST", "[/INST]", "[INST:user]", "\\", "]", "<", "a", "\n", "é", "/s>", "[", ""]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), PIECES), PIECES), max_size=6))
def test_template_is_reversible(turns):
    formatted, spans = reply_trees.format_turns(turns)
    assert reply_trees.read_turns(formatted) == turns
    assert [reply_trees.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_a_very_long_turn():
    text = ("a]" * 300_000) + "\\" * 300_001 + "</s>" * 100_000
    turns = [("user", text), ("assistant", "ok"), ("]", "")]
    assert reply_trees.read_turns(reply_trees.format_turns(turns)[0]) == turns
    with pytest.raises(ValueError, match="no turn"):
        reply_trees.read_turns("x")
    with pytest.raises(ValueError, match="no </s>"):
        reply_trees.read_turns("[INST:user]never closed")


def test_no_conversations(spark):
    messages = reply_trees.conversations_as_trees(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    turns = reply_trees.chosen_messages(messages).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    assert reply_trees.read_back(reply_trees.format_paths(turns, ("tree", "leaf")), ("tree",)).count() == 0


def test_paths_and_ranks(spark):
    rng = random.Random(2)
    rows, parent = [], {}
    for tree in range(4):
        for node in range(40):
            up = None if node == 0 else rng.randrange(max(0, node - 3), node)
            parent[tree, node] = up
            rows.append((tree, node, up, rng.choice([None, 0.5, 1.0, 2.0])))
    rows += [(9, 1, 99, 1.0), (9, 2, 1, 1.0), (8, 1, 2, 1.0), (8, 2, 1, 1.0)]  # a missing parent; a cycle
    score = {(t, n): s or 0.0 for t, n, _, s in rows}
    parent |= {(9, 1): None, (9, 2): 1}
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    leaves = [k for k in parent if k not in {(t, u) for (t, _), u in parent.items() if u is not None}]
    want = {}
    for tree, leaf in leaves:
        path, at = [], leaf
        while at is not None:
            path.append(at)
            at = parent[tree, at]
        want.setdefault(tree, []).append((-sum(score[tree, n] for n in path) / len(path), leaf, path[::-1]))
    got = {}
    for r in reply_trees.chosen_messages(df, best=2).collect():
        got.setdefault((r.tree, r.branch_rank, r.leaf), {})[r.turn] = r.node
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {(t, i + 1, leaf): path for t, ps in want.items() for i, (_, leaf, path) in enumerate(sorted(ps)[:2])}
    assert {(r.tree, r.leaf): r.depth for r in reply_trees.paths(df).collect()} == {(t, leaf): len(path) for t, ps in want.items() for _, leaf, path in ps}


def test_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (2, 5, None, "[INST]"), (None, 0, "user", "x"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "system", "first")]
    df = spark.createDataFrame([(*r, 0.1, "k") for r in rows], "conv_id long, turn long, role string, text string, score double, leaf string")
    messages = reply_trees.conversations_as_trees(df).cache()
    turns = reply_trees.chosen_messages(messages).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    told = {r.tree.conv_id: r for r in reply_trees.format_paths(turns, ("tree", "leaf")).collect()}
    read = {c: reply_trees.read_turns(r.formatted) for c, r in told.items()}
    assert read == {1: [("user", "a"), ("assistant", ""), ("assistant", "b")], 2: [("", "[INST]")], None: [("user", "x")], 3: [("system", "first"), ("user", "a"), ("user", "a")]}
    back = {r.tree.conv_id: r for r in reply_trees.read_back(reply_trees.format_paths(turns, ("tree", "leaf")), ("tree",)).collect()}
    assert back[1].n_turns == 3 and back[1].loss_chars == 1 and back[1].loss_sha256 == hashlib.sha256(b"b").hexdigest()
    assert back[2].turns_sha256 == hashlib.sha256(b"\n[INST]\n").hexdigest()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(7)
    word = lambda: rng.choice(["river", "stone", "window", "garden", "letter", "candle", "forest"]) + rng.choice("abcdefgh") + rng.choice("stnm")
    texts = [" ".join(word() for _ in range(80)) for _ in range(120)]
    rows = list(enumerate(texts))
    rows += [(200 + i, " ".join([*texts[i].split()[:-1], "changed"])) for i in range(10)]  # near copies
    rows += [(300 + i, texts[20 + i].replace(" ", "\n")) for i in range(10)]  # equal but for white space
    passage = " ".join(word() for _ in range(30))
    rows += [(400 + i, texts[40 + i][:100] + " " + passage + " " + " ".join(word() for _ in range(60))) for i in range(5)]
    rows += [(500 + i, " ".join(["buy%%% win$$$ ###"] * rng.randint(3, 30))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 500)) for i, _ in rows], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == list(range(120))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    kept = corpus_pipeline.exact_dedup(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
