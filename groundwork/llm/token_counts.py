"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries, so that a very long text is many encoding calls and a piece that repeats is encoded once per
worker; only a run without any such boundary is one call, however long, as merges may reach over all of it. A boundary is safe before a single ASCII space with a character other
than white space on either side: the byte-level split pattern starts a new piece there whatever surrounds it,
and no special string of such a vocabulary holds a space. Vocabularies for which this is not known to hold
(another pre-tokenizer, a normalizer, special strings with spaces or stripping) are encoded text by text.
Unseen pieces go to the tokenizer in batches balanced by bytes.

Null texts count as empty and have 0 tokens. Rows are neither dropped nor merged; equal ids stay separate rows.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import byte_batches, held, unused

_TWO_SPACES = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def splits_at_spaces(path: str) -> bool:
    """Whether the vocabulary file's own split rules make the boundaries of this module safe."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
    return plain and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not pre.get("add_prefix_space")


class PieceCounter:
    """Counts tokens of texts, remembering the counts of at most max_pieces pieces."""

    def __init__(self, path: str, max_pieces: int = 1_000_000, batch_bytes: int = 65_536):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.max_pieces, self.batch_bytes = max_pieces, batch_bytes
        self.cut = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode_lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode_lengths = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self.cut = splits_at_spaces(path)
        self.counts: dict[str, int] = {}  # by piece; a piece inside a text stands here without the space before it
        self.first: dict[str, int] = {}  # by piece at a text's start

    def _learn(self, into: dict[str, int], pieces: set[str], before: str) -> None:
        unseen = [p for p in pieces if p not in into]
        for batch in byte_batches(unseen, self.batch_bytes):
            into.update(zip(batch, self.encode_lengths([before + p for p in batch]), strict=True))

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The first piece as it is, the others without the space that starts them."""
        if _TWO_SPACES.search(text):
            first, *rest = _SAFE.split(text)
            return [first, *(p[1:] for p in rest)]
        return text.split(" ")

    def lengths(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return [n for batch in byte_batches(texts, self.batch_bytes) for n in self.encode_lengths(batch)]
        if len(self.counts) + len(self.first) > self.max_pieces:
            self.counts.clear()
            self.first.clear()
        cut = [self.pieces(t) for t in texts]
        inner: set[str] = set()
        for p in cut:
            inner.update(p[1:])
        self._learn(self.counts, inner, " ")
        self._learn(self.first, {p[0] for p in cut}, "")
        look = self.counts.__getitem__
        return [self.first[p[0]] + sum(map(look, p[1:])) for p in cut]


def token_counts(df: DataFrame, tokenizer_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), group_bytes: int = 8_000_000) -> DataFrame:
    """keep columns, n_bytes (UTF-8) and n_tokens (both long) for every row of df; other columns of df are not read."""
    kept = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(unused(df, "text_to_count")))
    out = df.select(*keep).withColumns({"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema
    names = list(keep)

    def run(batches):
        counter = held(("pieces", tokenizer_path), lambda: PieceCounter(tokenizer_path))
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            lengths: list[int] = []
            for group in byte_batches(text.to_pylist(), group_bytes):
                lengths += counter.lengths(group)
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pc.binary_length(text.cast(pa.binary())).cast(pa.int64()), pa.array(lengths, pa.int64())], names=[*names, "n_bytes", "n_tokens"])

    return kept.mapInArrow(run, out)
