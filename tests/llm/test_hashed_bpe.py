"""Byte-level BPE by perfect hash and heaps against the tiktoken library."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from groundwork.llm import hashed_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LETTERS = " \n\t'sTréЖ漢🙂a1.,-\x1c\xa0́　"
TEXTS = [None, "", " ", "  ", "a", " a", "a ", "A  b", "it's 've x'll", "tab\tand\nline\r\n\r\nend \n", "naïve É é ß ñ 12x½ªº²", "日本語 ΑΣ Σ İ", "<|endoftext|>", "\x00 \x7f", "word " * 3000, "nospace" * 20_000, "🙂🙂 👩‍👩‍👧 é́"]


@pytest.fixture(scope="module")
def ranks():
    return hashed_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def table(tmp_path_factory, ranks):
    path = tmp_path_factory.mktemp("ranks") / "table.bin"
    path.write_bytes(hashed_bpe.compile_table(ranks))
    return str(path)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 20_000])
def test_perfect_hash_gives_each_slot_once(n):
    keys = [f"key {i}".encode() for i in range(n)]
    _, slot = hashed_bpe.perfect_hash(keys)
    assert sorted(slot.tolist()) == list(range(n))


def test_table_knows_its_tokens_and_no_other(table, ranks):
    held = hashed_bpe.Table(table)
    keys = list(ranks)
    assert held.look_up(keys) == [ranks[k] for k in keys]
    strange = [k + b"\xff\x00" for k in keys[::7]] + [b""]
    assert held.look_up(strange) == [-1] * len(strange)


def test_merges_are_those_of_the_library(table, library):
    rng = random.Random(3)
    codec = hashed_bpe.Codec(table, public_tokenizers.PATTERN)
    for _ in range(600):
        codec.memory.most_bytes = rng.choice([300, 5_000, 10**7])
        texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(4)]
        for t, ids in zip(texts, codec.encode(texts), strict=True):
            assert np.frombuffer(ids, "<i4").tolist() == library.encode_ordinary(t)
            assert codec.decode(ids) == t.encode()
        assert codec.memory.size <= 10**7


def test_rows(spark, library):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(3, " ", 1), (None, "null id", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long").repartition(3)
    table = hashed_bpe.share_table(spark, PATH)
    got = hashed_bpe.encode(docs, table, public_tokenizers.PATTERN, keep=("doc_id", "n_tokens"), slice_bytes=1000)
    assert got.columns == ["doc_id", "n_tokens", "_n_tokens", "ids", "decoded"]
    want = [(d, n, library.encode_ordinary(t or ""), (t or "").encode()) for d, t, n in rows]
    assert sorted(map(repr, ((r.doc_id, r.n_tokens, r.ids, bytes(r.decoded)) for r in got.collect()))) == sorted(map(repr, want))
    assert all(r["_n_tokens"] == len(r["ids"]) for r in got.collect())
    back = hashed_bpe.decode(got, table, keep=("doc_id", "n_tokens")).collect()
    assert sorted(map(repr, ((r.doc_id, bytes(r.decoded)) for r in back))) == sorted(map(repr, ((d, b) for d, _, _, b in want)))
    assert hashed_bpe.encode(docs.limit(0), table, public_tokenizers.PATTERN).count() == 0
    nothing = hashed_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), table).first()
    assert bytes(nothing.decoded) == b""


def test_vocabulary_without_single_bytes_is_refused(tmp_path):
    path = tmp_path / "few.tiktoken"
    path.write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        hashed_bpe.read_ranks(str(path))
