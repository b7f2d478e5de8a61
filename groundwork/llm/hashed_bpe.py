"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash (hash and displace) over the vocabulary gives every pre-token one slot to look at; if the slot's
token is the pre-token, its rank is the id. Tier two: other pre-tokens are merged, a heap of pair ranks over linked bytes. The table
is one file in the shared folder, handed to every executor and memory-mapped there. No vocabulary is kept in this package.

Texts are cut before a space between two characters other than white space, where the split pattern starts a new
pre-token whatever is around, so that a worker can remember what chunks give; it remembers no more than a fixed number of bytes.

Null texts count as empty: no ids, and nothing decoded. Equal and null ids stay rows of their own; an empty table gives no rows. Other columns
are not read; an output whose name a kept column has gets an underscore in front.
"""

from __future__ import annotations

import base64
import gc
import heapq
import mmap
import re
import struct

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import Chunks, byte_slices, free_names, held, share_file, unused

_TWO_SPACES = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
#: Keys a bucket of the perfect hash has on average.
BUCKET = 4


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file of lines `base64 rank`; every single byte has to be a token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} lacks single bytes")
    return ranks


def _mixed(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """A place in n for 64-bit hashes h under displacements d."""
    x = (h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    return ((x * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(20)) % np.uint64(n)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def perfect_hash(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of each bucket, and the slot (0 to n - 1, each once) of each of n distinct keys.

    Buckets are placed from the largest to the smallest by the first displacement whose places are free; a bucket of one key takes any free slot, which stands as a negative number.
    """
    n, h = len(keys), _hashes(keys)
    if len(np.unique(h)) < n:
        raise ValueError("keys are not distinct")
    n_buckets = -(-n // BUCKET)
    displaced, slot, taken = np.zeros(n_buckets, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    bucket = (h % np.uint64(max(n_buckets, 1))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    singles = []
    for b in np.argsort(-sizes, kind="stable").tolist():
        own = order[starts[b] : starts[b + 1]]
        if len(own) == 1:
            singles.append((b, own[0]))
        if len(own) < 2:
            continue
        first, width = 0, 64
        while True:
            d = np.arange(first, first + width)
            places = np.sort(_mixed(h[own][None, :], d[:, None], n).astype(np.int64), axis=1)
            fits = ~taken[places].any(axis=1) & (np.diff(places, axis=1) > 0).all(axis=1)
            if fits.any():
                break
            first, width = first + width, min(4 * width, 1 << 16)
        displaced[b] = d[fits.argmax()]
        slot[own] = _mixed(h[own], np.full(len(own), displaced[b]), n).astype(np.int64)
        taken[slot[own]] = True
    for (b, key), free in zip(singles, np.nonzero(~taken)[0], strict=True):
        displaced[b], slot[key] = -free - 1, free
    return displaced, slot


def compile_table(ranks: dict[bytes, int]) -> bytes:
    """The perfect hash and its tokens as the bytes of a file."""
    keys = sorted(ranks)
    displaced, slot = perfect_hash(keys)
    by_slot = [b""] * len(keys)
    for k, s in zip(keys, slot.tolist(), strict=True):
        by_slot[s] = k
    arrays = [displaced.astype("<i8"), np.array([ranks[k] for k in by_slot], "<i8"), np.cumsum([0, *map(len, by_slot)]).astype("<i8"), np.frombuffer(b"".join(by_slot), "u1")]
    return struct.pack("<4q", *map(len, arrays)) + b"".join(a.tobytes() for a in arrays)


class Table:
    """A compiled table, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at, found = struct.unpack("<4q", data[:32]), 32, []
        for n, kind in zip(sizes, ("<i8", "<i8", "<i8", "u1"), strict=True):
            found.append(np.frombuffer(data, kind, n, at))
            at += found[-1].nbytes
        self.displaced, self.ranks, offsets, letters = found
        flat, at = letters.tobytes(), offsets.tolist()
        self.tokens = [flat[a:b] for a, b in zip(at, at[1:], strict=False)]

    def look_up(self, keys: list[bytes]) -> list[int]:
        """The rank of each key, -1 for keys that are no token."""
        if not keys:
            return []
        h = _hashes(keys)
        d = self.displaced[(h % np.uint64(len(self.displaced))).astype(np.int64)]
        slots = np.where(d < 0, -d - 1, _mixed(h, np.maximum(d, 0), len(self.tokens)).astype(np.int64))
        tokens = self.tokens
        return [r if tokens[s] == k else -1 for k, s, r in zip(keys, slots.tolist(), self.ranks[slots].tolist(), strict=True)]


class Merger:
    """Exact merges of what is no token as a whole: always the pair of least rank, the leftmost of equal ones."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << 24 | b] = rank
        of_byte = self.single.tolist()
        self.two = np.array([self.pairs.get(a << 24 | b, -1) for a in of_byte for b in of_byte], np.int64)

    def many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces (none empty) as 32-bit integers. All lie one after the other in one linked list of bytes, each with a heap of its own."""
        if not pieces:
            return []
        letters = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        ends = np.cumsum([len(p) for p in pieces])
        first = np.full(len(letters), -1, np.int64)
        first[:-1] = self.two[letters[:-1] << 8 | letters[1:]]
        first[ends - 1] = -1
        now, ids = first.tolist(), self.single[letters].tolist()
        places = np.arange(len(letters))
        shift = 14 if max(map(len, pieces)) < 1 << 14 else 40  # small numbers where they do
        within, mask = places - np.repeat(ends - [len(p) for p in pieces], [len(p) for p in pieces]), (1 << shift) - 1
        offers = np.where(first >= 0, first << shift | within, -1).tolist()
        after, before = (places + 1).tolist(), (places - 1).tolist()
        get, pop, push, heapify = self.pairs.get, heapq.heappop, heapq.heappush, heapq.heapify
        start = 0
        for end in ends.tolist():
            heap = [x for x in offers[start:end] if x >= 0]
            heapify(heap)
            while heap:
                found = pop(heap)
                rank, i = found >> shift, start + (found & mask)
                if now[i] != rank:
                    continue
                j = after[i]
                ids[i], now[j] = rank, -2
                after[i] = k = after[j]
                if k < end:
                    before[k] = i
                    now[i] = r = get(rank << 24 | ids[k], -1)
                    if r >= 0:
                        push(heap, r << shift | i - start)
                else:
                    now[i] = -1
                h = before[i]
                if h >= start:
                    now[h] = r = get(ids[h] << 24 | rank, -1)
                    if r >= 0:
                        push(heap, r << shift | h - start)
            start = end
        left = np.array(now) != -2
        flat = np.array(ids, "<i4")[left].tobytes()
        at = (4 * np.cumsum(left))[ends - 1].tolist()
        return [flat[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)]


class Codec:
    """Encodes and decodes texts; ids are little-endian 32-bit integers. What chunks gave is remembered up to most_bytes."""

    def __init__(self, table_path: str, pattern: str, most_bytes: int = 240_000_000):
        self.table, self.memory = Table(table_path), Chunks(most_bytes)
        ranks = self.table.ranks.tolist()
        self.merger = Merger(dict(zip(self.table.tokens, ranks, strict=True)))
        self.token_of = dict(zip(ranks, self.table.tokens, strict=True))
        self.split = regex.compile(pattern).findall

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The text's chunks: the first with a space in front as its mark, the others without the space that starts them."""
        first, *rest = [p[1:] if i else p for i, p in enumerate(_SAFE.split(text))] if _TWO_SPACES.search(text) else text.split(" ")
        return [" " + first, *rest]

    def _learned(self, chunks: list[str]) -> dict[str, bytes]:
        gc.disable()  # many small objects that all stay
        try:
            cut = [self.split(c[1:] if c[:1] == " " else " " + c) for c in chunks]
            pieces = list(set().union(*cut))
            keys = [p.encode() for p in pieces]
            ranks = self.table.look_up(keys)
            merged = iter(self.merger.many([k for k, r in zip(keys, ranks, strict=True) if r < 0]))
            ids = {p: next(merged) if r < 0 else r.to_bytes(4, "little") for p, r in zip(pieces, ranks, strict=True)}
            return {c: ids[ps[0]] if len(ps) == 1 else b"".join(map(ids.__getitem__, ps)) for c, ps in zip(chunks, cut, strict=True)}
        finally:
            gc.enable()

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = list(map(self.chunks, texts))
        look = self.memory.finder(set().union(*cut), self._learned)
        return [b"".join(map(look, cs)) for cs in cut]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids, a million at a time."""
        flat, tokens = np.frombuffer(ids, "<i4"), self.token_of
        return b"".join(b"".join(map(tokens.__getitem__, flat[at : at + 1_000_000].tolist())) for at in range(0, len(flat), 1_000_000))


def share_table(spark: SparkSession, ranks_path: str) -> str:
    """Compile the vocabulary's table (one row a token, so its size is the vocabulary's) and hand it to all executors; returns its name for encode()."""
    return share_file(spark, "ranks", compile_table(read_ranks(ranks_path)))


def _codec(table: str, pattern: str) -> Codec:
    return held(("hashed-bpe", table, pattern), lambda: Codec(SparkFiles.get(table), pattern))


def encode(docs: DataFrame, table: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", slice_bytes: int = 2_000_000) -> DataFrame:
    """keep columns, n_tokens (long), ids (array of int) and decoded (binary: the bytes of the ids, decoded again) of every row."""
    counted, listed, shown = free_names(keep, "n_tokens", "ids", "decoded")
    told = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(unused(docs, "text_to_encode")))
    out = docs.select(*keep, F.lit(0).cast("long").alias(counted), F.array().cast("array<int>").alias(listed), F.lit(None).cast("binary").alias(shown)).schema
    n_keep = len(keep)

    def run(batches):
        codec = _codec(table, pattern)
        for batch in batches:
            for part in byte_slices(batch, n_keep, slice_bytes):
                ids = codec.encode(part.column(n_keep).to_pylist())
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                flat = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(ids))])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)
                decoded = pa.array(map(codec.decode, ids), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_keep)), pa.array(sizes), lists, decoded], names=[*keep, counted, listed, shown])

    return told.mapInArrow(run, out)


def decode(encoded: DataFrame, table: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """keep columns and decoded (binary) of rows with an array of ids; null counts as no ids."""
    (shown,) = free_names(keep, "decoded")
    told = encoded.select(*keep, F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias(unused(encoded, "ids_to_decode")))
    out = encoded.select(*keep, F.lit(None).cast("binary").alias(shown)).schema
    n_keep = len(keep)

    def run(batches):
        codec = _codec(table, r"\s+|\S+")
        for batch in batches:
            lists = (np.array(x, "<i4").tobytes() for x in batch.column(n_keep).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n_keep)), pa.array(map(codec.decode, lists), pa.binary())], names=[*keep, shown])

    return told.mapInArrow(run, out)
