"""What an operator leaves in a Python worker goes when the next one starts, and what it needs while it works is bounded."""

import tracemalloc
import weakref

import numpy as np
import public_tokenizers

from groundwork.llm import bpe_words, common, lexicon
from groundwork.llm.subword_classifier import BUCKETS, Scorer

TABLE = np.random.default_rng(3).normal(0, 1, BUCKETS + 1).astype(np.float32)


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_freed_drops_the_vocabulary():
    known = weakref.ref(bpe_words.vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    assert known() is not None
    common.freed()
    assert known() is None


def test_a_scorer_forgets_words_and_long_words():
    scorer = Scorer(TABLE, 0.3, most=1000)
    for i in range(20):
        texts = [" ".join(f"w{i % 7}x{j}" for j in range(300)), "same words again again", "y" * 5000, ""]
        assert scorer.scores(texts) == Scorer(TABLE, 0.3).scores(texts)
    assert len(scorer.sums) <= 1000
    fresh = Scorer(TABLE, 0.3)
    assert fresh.scores(["y" * 5000]) + fresh.scores(["a"]) == Scorer(TABLE, 0.3).scores(["y" * 5000, "a"])
    assert "y" * 5000 not in fresh.sums and "a" in fresh.sums


def test_many_new_words_need_little_memory():
    scorer, text = Scorer(TABLE, 0.3), " ".join(f"someword{i}" for i in range(50_000))
    assert peak_mb(lambda: scorer.scores([text])) < 45


def test_many_pieces_are_merged_in_little_memory():
    merger, rng = lexicon.Merger(public_tokenizers.path("word_bpe_49k.json")), np.random.default_rng(5)
    pieces = ["".join(chr(97 + c) for c in row) for row in rng.integers(0, 26, (20_000, 48)).tolist()]
    found = []
    assert peak_mb(lambda: found.extend(merger.many(pieces))) < 30
    assert found[::2000] == [merger.ids(p) for p in pieces[::2000]]
