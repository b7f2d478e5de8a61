"""Words of many texts are cut and counted by Arrow, without an object for each word."""

import random

import numpy as np
import pyarrow as pa

from groundwork.llm import ppm


def test_words_are_those_of_the_bytes():
    rng = random.Random(5)
    texts = ["", " ", "\t\n\v\f\r ", "Aé Ab c d\x1c\x1fe\x85 \x00", *("".join(rng.choice(" \t\n\x0b\x0c\r\x1cAbÉ\x00") for _ in range(rng.randrange(60))) for _ in range(300))]
    every = pa.array([t.encode() for t in texts], pa.binary())
    for some in (every, every.slice(3, 100), every.slice(0, 0), every.slice(0, 1)):
        words, sizes = ppm.words_of(some)
        want = [t.as_py().lower().split() for t in some]
        assert sizes.tolist() == [len(w) for w in want]
        assert words.view(pa.binary()).to_pylist() == [w for ws in want for w in ws]


def test_words_that_are_not_trained_on_stand_there_with_zero():
    words, _ = ppm.words_of(pa.array([b"a B a", b"c a"], pa.binary()))
    names, n = ppm.count_words(words, np.array([True, True, True, False, False]))
    assert dict(zip(names.to_pylist(), n.tolist(), strict=True)) == {"a": 2, "b": 1, "c": 0}
