"""Token counts, token-id files and BPE encoding against the tokenizers library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from groundwork.llm import bit_planes, lexicon, token_counts
from groundwork.llm.common import byte_batches

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "A  b", "it's ITS 's 're x'll", "tab\tand\nline\r\n\r\nend \n", "naïve Ünïcode É é ß ñ 12x½ªº²", "x́e  wide nbsp 　日本語 ΑΣ Σ İ",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>", "a\x1cb \x85 \x00 \x7f", "...!!! ,,. a.b,c ||| ### $$$%%%", "word " * 3000, "nospace" * 700, "🙂🙂 👩‍👩‍👧 é́", "end.", "  lead", "Don't  DON'T don't",
]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    more = ["".join(rng.choice(" \n\tabcDEÉñ.,'|1 ") for _ in range(60)) for _ in range(60)]
    rows = [(i, t, i) for i, t in enumerate([*TEXTS, *more])] + [(3, " ", 9), (None, "null id", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long").repartition(3)


def encoded(path, docs):
    tokenizer = Tokenizer.from_file(path)
    return tokenizer, [(r.doc_id, r.text or "", tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]


def test_counts(docs):
    _, want = encoded(BYTE, docs)
    got = token_counts.token_counts(docs, BYTE).collect()
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens) for r in got))) == sorted(map(str, ((d, len(t.encode()), len(ids)) for d, t, ids in want)))


@pytest.mark.parametrize("path", [WORD, public_tokenizers.path("piece_bpe_32k.model")])
def test_counts_by_whole_texts(spark, path):
    df = spark.createDataFrame([(1, "It's a naïve test."), (2, None)], "doc_id long, text string")
    if path == WORD:
        want = len(Tokenizer.from_file(WORD).encode("It's a naïve test.", add_special_tokens=False))
    else:
        import sentencepiece

        want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode("It's a naïve test."))
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, path).collect()} == {1: want, 2: 0}


def test_counts_of_an_empty_table_and_batches_by_bytes(docs):
    none = token_counts.token_counts(docs.limit(0), BYTE)
    assert none.columns == ["doc_id", "n_bytes", "n_tokens"] and none.count() == 0
    assert list(byte_batches(["aaaa", "éé", "🙂", "b" * 99, ""], 10)) == [["aaaa", "éé"], ["🙂"], ["b" * 99], [""]]


def test_kept_columns_keep_their_names(docs):
    got = lexicon.encode(docs.where("doc_id = 4"), WORD, keep=("doc_id", "n_tokens"))
    assert got.columns == ["doc_id", "n_tokens", "_n_tokens", "ids", "decoded"]
    assert [(r.doc_id, r.n_tokens, r["_n_tokens"]) for r in got.collect()] == [(4, 4, 1)]


def test_small_memory_changes_nothing():
    counter, roomy = token_counts.PieceCounter(BYTE, max_pieces=1, batch_bytes=3), token_counts.PieceCounter(BYTE)
    texts = [t or "" for t in TEXTS]
    assert [counter.lengths([t])[0] for t in texts] == roomy.lengths(texts)


def test_files(spark, docs):
    _, want = encoded(WORD, docs)
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, rows = 0, []
    for d, _, ids in want:
        ids = [*ids, 2]
        rows.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    for planes in ("bit", "byte"):
        folder, manifest = bit_planes.write_token_files(docs, WORD, end_id=2, planes=planes, file_ids=500)
        assert manifest.count() > 1
        got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, list(r.ids)) for r in bit_planes.read_token_files(spark, folder, manifest).collect()), key=lambda r: r[1])
        assert got == rows


def test_no_files(spark, docs):
    folder, manifest = bit_planes.write_token_files(docs.limit(0), WORD)
    assert bit_planes.read_token_files(spark, folder, manifest, digest_only=True).count() == 0


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_planes(planes):
    rng = np.random.default_rng(1)
    for top in (0, 1, 300, 49_408, (1 << 32) - 1):
        for n in (0, 1, 9, 70_000):
            ids = rng.integers(0, top + 1, n, dtype=np.uint64).astype(np.uint32)
            assert np.array_equal(bit_planes.from_planes(bit_planes.to_planes(ids, planes), n, planes), ids)
    writer = bit_planes.IdFileWriter(planes, block_ids=100)
    parts = [rng.integers(0, 5000, n).astype(np.uint32) for n in (0, 250, 3, 0, 99, 1)]
    for i, p in enumerate(parts):
        writer.add(None if i == 2 else i, p)
    got = list(bit_planes.IdFile(writer.finish()).documents())
    assert [(d, at) for d, at, _ in got] == [(0, 0), (1, 0), (None, 250), (3, 253), (4, 253), (5, 352)]
    assert all(np.array_equal(g[2], p) for g, p in zip(got, parts, strict=True))


@pytest.mark.parametrize("most", [0, 3, 100_000])
def test_lexicon_encoding(docs, most):
    tokenizer, want = encoded(WORD, docs)
    name = lexicon.build_lexicon(docs, WORD, most=most)
    got = lexicon.encode(docs, WORD, name)
    rows = sorted(str((r.doc_id, r.n_tokens, r.ids, r.decoded)) for r in got.collect())
    assert rows == sorted(str((d, len(ids), " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))) for d, _, ids in want)
    assert sorted(str((r.doc_id, r.decoded)) for r in lexicon.decode(got, WORD).collect()) == sorted(str((d, tokenizer.decode(ids, skip_special_tokens=False))) for d, _, ids in want)


def test_automaton(tmp_path):
    rng = random.Random(2)
    words = {bytes(rng.choice(b"abc\xc3") for _ in range(rng.randint(1, 6))): [rng.randint(0, 70_000) for _ in range(rng.randint(1, 4))] for _ in range(400)}
    (tmp_path / "l.bin").write_bytes(lexicon.compile_lexicon(words))
    lex = lexicon.Lexicon(str(tmp_path / "l.bin"))
    asked = [*words, b"", b"zz", b"abcabcabcabc", b"a" * 50]
    assert lex.look_up(asked) == [words.get(w) for w in asked]
    assert len(lex.final) < len({w[:i] for w in words for i in range(len(w) + 1)})  # suffixes are shared


def test_merges_of_long_pieces():
    merger, rng = lexicon.Merger(WORD), random.Random(3)
    tokenizer = Tokenizer.from_file(WORD)
    for n in (1, 2, 40, 48, 49, 300):
        piece = "".join(rng.choice("abcdeinrst") for _ in range(n))
        assert merger.ids(piece) == tokenizer.encode(piece, add_special_tokens=False).ids
    pieces = ["".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    assert merger.many(pieces) == [merger.ids(p) for p in pieces]
    assert merger.many([]) == []
