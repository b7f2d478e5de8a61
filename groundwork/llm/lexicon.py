"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The most frequent pieces of the corpus are compiled into an automaton that shares prefixes and suffixes; the number of
words that sort before a word is carried along its path and indexes a table of id sequences. The automaton is one
read-only file that every Python worker memory-maps. Pieces that it does not hold are merged exactly, pair by pair in
rank order. The lexicon changes only the work, never the ids, so its size is a parameter.

Decoding takes the ids alone: each id's token, joined by spaces, as the vocabularies known here have no decoder of their own.

Null texts count as empty: 0 tokens and empty strings. Equal ids stay separate rows; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import heapq
import mmap
import os
import struct
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.bpe_words import byte_letters, chunks, vocabulary
from groundwork.llm.common import Chunks, byte_slices, free_names, freed, held, share_file, staged, unused

#: The rank of pairs that do not merge.
NONE = 1 << 60
#: Most frequent words that the automaton holds, and most letters of one.
LEXICON_WORDS, LEXICON_LETTERS = 100_000, 64
#: Bytes of text that a task looks at together.
SLICE_BYTES = 2_000_000
#: Pieces that are merged together: some 400 bytes of memory for each letter that fits the longest.
TOGETHER = 4_000


class Merger:
    """Exact merges of one piece given as byte-level letters."""

    def __init__(self, path: str):
        v = vocabulary(path)
        self.vocab, self.suffix = v.vocab, v.suffix
        self.rank = {v.vocab[a] << 20 | v.vocab[b]: r << 20 | v.vocab[a + b] for r, (a, b) in enumerate(v.merges)}
        self.keys = np.array(sorted(self.rank), np.int64)
        self.packed = np.array([self.rank[k] for k in self.keys.tolist()], np.int64)
        alphabet = byte_letters()
        self.letters = np.zeros(max(map(ord, alphabet)) + 1, np.int64)
        self.endings = np.zeros(max(v.vocab[c] for c in alphabet) + 1, np.int64)
        for c in alphabet:
            self.letters[ord(c)] = v.vocab[c]
            self.endings[v.vocab[c]] = v.vocab[c + v.suffix]

    def ids(self, piece: str) -> list[int]:
        ids = [self.vocab[c] for c in piece[:-1]]
        ids.append(self.vocab[piece[-1] + self.suffix])
        return self._short(ids) if len(ids) <= 48 else self._long(ids)

    def many(self, pieces: list[str]) -> list[list[int]]:
        """Ids of many pieces; those of up to 48 letters are merged together, one merge of each in a round."""
        out: list[list[int]] = [[]] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) > 48:
                out[i] = self.ids(p)
            else:
                by_size.setdefault(-(-len(p) // 8), []).append(i)
        for places in by_size.values():
            for at in range(0, len(places), TOGETHER):
                some = places[at : at + TOGETHER]
                for i, ids in zip(some, self._together([pieces[i] for i in some]), strict=True):
                    out[i] = ids
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and new id (packed) of pairs of ids; NONE where they do not merge."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.packed[at], NONE)

    def _together(self, pieces: list[str]) -> list[list[int]]:
        sizes = np.array([len(p) for p in pieces])
        width = int(sizes.max())
        ids = np.full((len(pieces), width), -1, np.int64)
        inside = np.arange(width) < sizes[:, None]
        ids[inside] = self.letters[np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)]
        last = (np.arange(len(pieces)), sizes - 1)
        ids[last] = self.endings[ids[last]]
        done, rows = [None] * len(pieces), np.arange(len(pieces))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(pieces), 1), NONE)
        columns = np.arange(width)
        while len(rows):
            best = ranks.argmin(axis=1)
            packed = ranks[np.arange(len(rows)), best]
            over = packed == NONE
            if over.any():
                for r, found in zip(rows[over].tolist(), ids[over].tolist(), strict=True):
                    done[r] = [x for x in found if x >= 0]
                rows, ids, ranks, best, packed = (x[~over] for x in (rows, ids, ranks, best, packed))
                if not len(rows):
                    break
            each = np.arange(len(rows))
            ids[each, best] = packed & 0xFFFFF
            shift = np.minimum(columns + (columns > best[:, None]), width - 1)
            tail = ids[:, -1].copy()
            ids = np.take_along_axis(ids, shift, axis=1)
            ids[:, -1] = np.where(best == width - 1, tail, -1)
            ranks = np.take_along_axis(ranks, np.minimum(columns[:-1] + (columns[:-1] > best[:, None]), width - 2), axis=1)
            ranks[:, -1] = NONE
            for j in (best - 1, best):
                ok = (j >= 0) & (j < width - 1)
                ranks[each[ok], j[ok]] = self._ranks(ids[each[ok], j[ok]], ids[each[ok], j[ok] + 1])
        return done

    def _short(self, ids: list[int]) -> list[int]:
        rank, none = self.rank, NONE
        pairs = [rank.get(a << 20 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            ids[i] = best & 0xFFFFF
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank.get(ids[i] << 20 | ids[i + 1], none)
            if i:
                pairs[i - 1] = rank.get(ids[i - 1] << 20 | ids[i], none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (found := self.rank.get(ids[i] << 20 | ids[after[i]])):
                heapq.heappush(heap, (found >> 20, i, ids[i], ids[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.rank[a << 20 | b] & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [x for x in ids if x >= 0]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The automaton of the words (not empty) with their ids, as the bytes of a file."""
    order = sorted(words)
    register: dict[tuple, int] = {}
    edges: list[list[tuple[int, int]]] = [[]]
    final: list[bool] = [False]

    def settle(path: list[int], labels: bytes, down_to: int) -> None:
        """Replace the states of the last word below depth down_to by equal states seen before."""
        for depth in range(len(labels), down_to, -1):
            state = path[depth]
            key = (final[state], tuple(edges[state]))
            kept = register.setdefault(key, state)
            if kept != state:
                edges[path[depth - 1]][-1] = (labels[depth - 1], kept)

    path, last = [0], b""
    for word in order:
        same = len(os.path.commonprefix([word, last]))
        settle(path, last, same)
        path = path[: same + 1]
        for label in word[same:]:
            edges.append([])
            final.append(False)
            edges[path[-1]].append((label, len(edges) - 1))
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    settle(path, last, 0)

    number, places, stack = {}, [], [0]
    while stack:  # number the reachable states
        s = stack.pop()
        if s not in number:
            number[s] = len(places)
            places.append(s)
            stack.extend(t for _, t in edges[s])
    below: dict[int, int] = {}

    def count(state: int) -> int:
        todo = [state]
        while todo:
            s = todo[-1]
            missing = [t for _, t in edges[s] if t not in below]
            if missing:
                todo.extend(missing)
            else:
                below[s] = final[s] + sum(below[t] for _, t in edges[s])
                todo.pop()
        return below[state]

    count(0)
    keys, targets, skips = [], [], []
    for k, s in enumerate(places):
        skip = int(final[s])
        for label, t in edges[s]:
            keys.append(k << 8 | label)
            targets.append(number[t])
            skips.append(skip)
            skip += below[t]
    ids = [words[w] for w in order]
    arrays = [np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(skips, "<i4"), np.array([final[s] for s in places], "u1"), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<i4"), np.array([i for x in ids for i in x], "<i4")]
    return struct.pack("<6q", *(len(a) for a in arrays)) + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at, found = struct.unpack("<6q", data[:48]), 48, []
        for n, kind in zip(sizes, ("<i8", "<i4", "<i4", "u1", "<i4", "<i4"), strict=True):
            a = np.frombuffer(data, kind, n, at)
            found.append(a)
            at += a.nbytes + -a.nbytes % 8
        self.keys, self.targets, self.skips, self.final, self.offsets, self.ids = found

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, or None; all words walk the automaton together, a byte at a time."""
        out: list[list[int] | None] = [None] * len(words)
        if not words or not len(self.keys):
            return out
        sizes = np.array([len(w) for w in words])
        flat, start = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        live, state, index = np.nonzero(sizes)[0], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        depth = 0
        while len(live):
            key = state[live] << 8 | flat[start[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at = live[ok], at[ok]
            state[live] = self.targets[at]
            index[live] += self.skips[at]
            depth += 1
            ended = sizes[live] == depth
            for w in live[ended & (self.final[state[live]] == 1)].tolist():
                k = int(index[w])
                out[w] = self.ids[self.offsets[k] : self.offsets[k + 1]].tolist()
            live = live[~ended]
        return out


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The words (runs of letters between spaces, but for full stops and commas at the end; lower-cased) that occur most in all texts.

    Only words of up to LEXICON_LETTERS letters count, so that the lexicon, which comes to the driver, is bounded in bytes. They are all those of the least count (2 or more) that leaves at most `most`.
    """

    def run(batches):
        freed()
        for batch in batches:
            for part in byte_slices(batch, 0, SLICE_BYTES):
                seen: Counter[str] = Counter()
                for text in part.column(0):
                    seen.update(chunks(text.as_py()))
                words: dict[str, int] = {}
                for chunk, n in seen.items():
                    w = chunk.rstrip(".,")
                    if w.isalpha() and len(w) <= LEXICON_LETTERS:
                        w = w.lower()
                        words[w] = words.get(w, 0) + n
                yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    counted = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "word string, n long")
    repeated = staged(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    room, least = most, 0
    for n, pieces in sorted(((r.n, r["count"]) for r in repeated.groupBy(F.least("n", F.lit(100_000)).alias("n")).count().collect()), reverse=True):  # at most 100,000 numbers
        if pieces > room:
            break
        room, least = room - pieces, n
    return [r.word for r in repeated.where(F.col("n") >= least).select("word").collect()] if room < most else []


def build_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compile the corpus's frequent pieces into a file in the shared folder and hand it to all executors; returns its name for encode()."""
    merger, letters = Merger(tokenizer_path), vocabulary(tokenizer_path).to_letters
    pieces = list(map(letters, frequent_words(docs, text_col, most)))
    data = compile_lexicon({p.encode(): ids for p, ids in zip(pieces, merger.many(pieces), strict=True)})
    del merger, letters, pieces
    freed()
    return share_file(docs.sparkSession, "lexicon", data)


class Codec:
    """Encodes texts chunk by chunk and decodes ids; remembers the ids of chunks, 32-bit integers, up to most_bytes."""

    def __init__(self, tokenizer_path: str, lexicon_path: str | None, most_bytes: int = 100_000_000):
        self.vocab, self.merger, self.memory = vocabulary(tokenizer_path), Merger(tokenizer_path), Chunks(most_bytes)
        if self.vocab.decoder is not None:
            raise ValueError("only vocabularies whose decoder joins tokens by spaces are known here")
        self.lexicon = Lexicon(lexicon_path) if lexicon_path else None
        tokens = self.vocab.tokens
        self.tokens = pa.array([tokens.get(i, "") for i in range(max(tokens) + 1)])
        self.names = pa.array([str(i) for i in range(max(tokens) + 1)])

    def _learned(self, chunks: list[str]) -> dict[str, bytes]:
        gc.disable()  # many small objects that all stay
        try:
            cut = {c: [c.lower()] if c.isascii() and c.isalpha() else self.vocab.pieces(c) for c in chunks}
            pieces = list({p for ps in cut.values() if ps for p in ps})
            found = self.lexicon.look_up([p.encode() for p in pieces]) if self.lexicon else [None] * len(pieces)
            merged = iter(self.merger.many([p for p, ids in zip(pieces, found, strict=True) if ids is None]))
            ids_of = {p: array("i", next(merged) if ids is None else ids).tobytes() for p, ids in zip(pieces, found, strict=True)}
            out: dict[str, bytes] = {}
            for c, ps in cut.items():
                if ps is None:
                    out[c] = array("i", self.vocab.tokenizer.encode(c, add_special_tokens=False).ids).tobytes()
                else:
                    out[c] = ids_of[ps[0]] if len(ps) == 1 else b"".join(map(ids_of.__getitem__, ps))
            return out
        finally:
            gc.enable()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        cut = list(map(chunks, texts))
        look = self.memory.finder(set().union(*cut), self._learned)
        return [b"".join(map(look, cs)) for cs in cut]

    def columns(self, ids: list[bytes]) -> list[pa.Array]:
        """Counts, ids as decimal text and the texts that they decode to."""
        counts = np.array([len(x) // 4 for x in ids], np.int64)
        flat, ends = pa.array(np.frombuffer(b"".join(ids), np.int32)), pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return [pa.array(counts), *(pc.binary_join(pa.ListArray.from_arrays(ends, strings.take(flat)), " ") for strings in (self.names, self.tokens))]


def encode(docs: DataFrame, tokenizer_path: str, lexicon: str | None = None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", most_bytes: int = 100_000_000) -> DataFrame:
    """keep columns, n_tokens (long), ids (decimal, one space between) and decoded (the ids decoded again, as the tokenizer's decode does).

    Other columns are not read; an output whose name a kept column has gets an underscore in front. most_bytes: what a worker remembers of chunks (about
    twice as much of its memory); less of it is more work.
    """
    n_keep, added = len(keep), free_names(keep, "n_tokens", "ids", "decoded")
    out = docs.select(*keep, F.lit(0).cast("long").alias(added[0]), F.lit("").alias(added[1]), F.lit("").alias(added[2])).schema

    def run(batches):
        codec = held(("codec", tokenizer_path, lexicon, most_bytes), lambda: Codec(tokenizer_path, SparkFiles.get(lexicon) if lexicon else None, most_bytes))
        for batch in batches:
            for part in byte_slices(batch, n_keep, SLICE_BYTES // 2):
                columns = codec.columns(codec.encode(part.column(n_keep).to_pylist()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_keep)), *columns], names=[*keep, *added])

    return docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(unused(docs, "text_to_encode"))).mapInArrow(run, out)


def decode(encoded: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """Texts of ids given as decimal text, as the tokenizer's decode gives them with special tokens kept."""
    out = encoded.select(*keep).withColumn("decoded", F.lit("")).schema

    def run(batches):
        tokens = {str(i): t for i, t in vocabulary(tokenizer_path).tokens.items()}
        for batch in batches:
            texts = [" ".join(map(tokens.__getitem__, (t or "").split())) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return encoded.select(*keep, F.col(ids_col).alias(unused(encoded, "ids_to_decode"))).mapInArrow(run, out)

