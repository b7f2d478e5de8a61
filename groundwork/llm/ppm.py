"""LM scoring by prediction by partial matching (PPM), with a word-frequency score beside it.

The model is a byte-context trie of order ORDER learned from the training texts (A-Z lower-cased), with one end mark per text.
Each node's byte counts come from one aggregation of all training texts' (ORDER + 1)-byte strings; shorter contexts are
their sums. The escape is estimated by method D: a byte seen c times of T in a context with q distinct bytes has (2c - 1) / 2T,
the escape q / 2T, and after an escape the bytes seen in the longer context are excluded from T and q of the shorter one.
Below the empty context the unseen bytes are equally likely. A text's score is the log10 probability of its bytes and end
mark: the sum over positions.

Neither trie nor texts are ever in one place. The trie is cut into shards of about SHARD_STRINGS strings: ranges of the contexts read
from their last byte backwards, so that all suffixes of a context lie in its own shard, but for the few that reach over the
shard's two ends; of these (at most ORDER an end, of at most 256 bytes each) the shard gets the whole counts. The corpus is cut
into parts of about PART_BYTES bytes; a part asks for each of its distinct strings once, at the shard that has their contexts, and
gets their log-probabilities back. A shard with many askers is copied to cells of about CELL_STRINGS asked strings, so a task holds
one shard and answers one part after the other. The driver sees one number per shard.

The word-frequency score needs the corpus count of every word of every text. Parts send each distinct word once, with its count in their
training texts; the totals of those that other parts have too are joined back to the parts. A part has no word twice, so no word can be
hot among these rows.

Null texts count as empty: they have the end mark only. A null id is trained on (its CRC-32 is that of an empty text). Equal ids stay
separate rows. Without training texts all bytes are equally likely, and the word-frequency score is 0 for every token. A long text is
cut into pieces for counting and scoring, but is one row. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import crc_of_id, small_or_shuffled, staged

ORDER, SHARD_STRINGS, CELL_STRINGS = 5, 500_000, 2_000_000
#: Bytes of text counted or scored at a time, distinct strings held while counting, and bytes of text of a part.
BATCH_BYTES, HELD_STRINGS, PART_BYTES = 1_000_000, 1_000_000, 8_000_000
_END = b"\xff"  # no UTF-8 text holds this byte


def pieces(texts: pa.Array, order: int, most: int):
    """Lists, of about `most` bytes in all, of (row, bytes): the order bytes before a piece of a text, and the piece; A-Z lower-cased, the end mark last."""
    held, size = [], 0
    for row, text in enumerate(texts):
        marked = b"".join((_END * order, text.as_py().lower(), _END))
        for at in range(order, len(marked), most):
            held.append((row, marked[at - order : at + most]))
            size += len(held[-1][1])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of binary texts, A-Z lower-cased, one text's after the other's, and how many each text has."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    flat, sizes = cut.flatten(), pc.list_value_length(cut).to_numpy().astype(np.int64)
    some = pc.binary_length(flat).to_numpy() > 0  # white space at a text's ends leaves empty words
    kept, ends = np.concatenate([[0], np.cumsum(some)]), np.cumsum(sizes)
    return flat.filter(pa.array(some)), kept[ends] - kept[ends - sizes]


def numbered(words: list[pa.Array]) -> tuple[np.ndarray, pa.Array]:
    """The place of each word among the distinct ones, and these."""
    found = pa.chunked_array(words, pa.string()).dictionary_encode().combine_chunks()
    return found.indices.to_numpy(), found.dictionary


def strings(cut: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-byte string that ends at each byte of pieces (with the order bytes before them), as numbers; and where each piece's begin."""
    flat = np.frombuffer(b"".join(cut), np.uint8)
    sizes = np.array([len(b) for b in cut])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    code = np.zeros(len(flat) - order, np.int64)
    for i in range(order + 1):
        code <<= 8
        code |= flat[i : len(flat) - order + i]
    inside = np.ones(len(flat), bool)
    for j in range(order):
        inside[starts + j] = False
    return code[inside[order:]], np.concatenate([[0], np.cumsum(sizes - order)[:-1]])


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sums of their counts."""
    every = np.concatenate(codes)
    by = np.argsort(every)
    every = every[by]
    first = np.nonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])[0]
    return every[first], np.add.reduceat(np.concatenate(counts)[by], first) if len(first) else np.zeros(0, np.int64)


def distinct_of(codes: list[np.ndarray]) -> np.ndarray:
    every = np.sort(np.concatenate(codes))
    return every[np.concatenate([[True], every[1:] != every[:-1]])[: len(every)]]


def count_strings(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """code and n: how often each (order + 1)-byte string occurs in texts(text: binary)."""

    def run(batches):
        codes, counts, held = [], [], 0
        for batch in batches:
            for part in pieces(batch.column(0), order, BATCH_BYTES):
                every = np.sort(strings([b for _, b in part], order)[0])
                first = np.nonzero(np.concatenate([[True], every[1:] != every[:-1]]))[0]
                codes.append(every[first])
                counts.append(np.diff(first, append=len(every)))
                held += len(first)
                if held > HELD_STRINGS:
                    kinds, n = merged(codes, counts)
                    if len(kinds) > HELD_STRINGS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], names=["code", "n"])
                        codes, counts, held = [], [], 0
                    else:
                        codes, counts, held = [kinds], [n], len(kinds)
        if codes:
            kinds, n = merged(codes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], names=["code", "n"])

    return texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Level:
    """The trie's contexts of one length: their strings with counts, and per context its total, kinds and what an escape from it leaves."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.codes, self.n = codes, n
        context = codes >> 8
        self.first = np.concatenate([[0], np.nonzero(context[1:] != context[:-1])[0] + 1]) if len(codes) else np.zeros(0, np.int64)
        self.contexts = context[self.first]
        self.total = np.add.reduceat(n, self.first) if len(codes) else n
        self.kinds = np.diff(np.append(self.first, len(codes)))
        self.left_total = self.left_kinds = np.zeros(len(self.contexts), np.int64)

    def leave_to(self, shorter: Level, mask: int) -> None:
        """What the next shorter contexts hold once this level's bytes are excluded."""
        if len(self.codes):
            excluded = np.add.reduceat(shorter.n[np.searchsorted(shorter.codes, self.codes & mask)], self.first)
            parent = np.searchsorted(shorter.contexts, self.contexts & (mask >> 8))
            self.left_total, self.left_kinds = shorter.total[parent] - excluded, shorter.kinds[parent] - self.kinds


class Trie:
    """A shard's levels, from the longest contexts to the empty one.

    whole gives, by length, the strings and counts in the whole corpus of the contexts that reach over the shard's ends; the counts of
    all other contexts are sums of the shard's own strings.
    """

    def __init__(self, codes: np.ndarray, n: np.ndarray, whole: dict[int, tuple[np.ndarray, np.ndarray]], order: int):
        self.order = order
        by = np.argsort(codes)
        codes, n = codes[by], n[by]
        self.levels = [Level(codes, n)]
        for k in range(order - 1, -1, -1):
            codes, n = merged([codes & ((1 << 8 * (k + 1)) - 1)], [n])
            if k in whole:
                more, n_more = whole[k]
                own = ~np.isin(codes >> 8, more >> 8)
                codes, n = merged([codes[own], more], [n[own], n_more])
            self.levels.append(Level(codes, n))
        for i in range(order):
            self.levels[i].leave_to(self.levels[i + 1], (1 << 8 * (order - i)) - 1)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each string's last byte after the bytes before it."""
        out, live = np.zeros(len(codes)), np.arange(len(codes))
        total, kinds = np.full(len(codes), -1, np.int64), np.zeros(len(codes), np.int64)
        for i, level in enumerate(self.levels):
            if not len(level.codes) or not len(live):
                continue
            x = codes[live] & ((1 << 8 * (self.order - i + 1)) - 1)
            at = np.minimum(np.searchsorted(level.contexts, x >> 8), len(level.contexts) - 1)
            here = level.contexts[at] == x >> 8
            t = np.where(total[live] < 0, level.total[at], total[live])
            q = np.where(total[live] < 0, level.kinds[at], kinds[live])
            place = np.minimum(np.searchsorted(level.codes, x), len(level.codes) - 1)
            seen = here & (level.codes[place] == x)
            out[live[seen]] += np.log10((2 * level.n[place[seen]] - 1) / (2 * t[seen]))
            gone = here & ~seen
            some = gone & (t > 0)
            out[live[some]] += np.log10(q[some] / (2 * t[some]))
            total[live[gone]], kinds[live[gone]] = level.left_total[at[gone]], level.left_kinds[at[gone]]
            live = live[~seen]
        out[live] -= np.log10(max(1, 256 - len(self.levels[-1].codes)))
        return out


def turned(codes: np.ndarray, order: int) -> np.ndarray:
    """The contexts of strings as numbers, last byte first: contexts that end alike stand together."""
    key = np.zeros(len(codes), np.int64)
    for i in range(1, order + 1):
        key = key << 8 | (codes >> 8 * i) & 255
    return key


def turned_column(code: str, order: int) -> Column:
    key = F.lit(0).cast("long")
    for i in range(1, order + 1):
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftright(code, 8 * i).bitwiseAND(F.lit(255)))
    return key


def sharded(counts: DataFrame, order: int, most: int) -> tuple[DataFrame, DataFrame, np.ndarray, np.ndarray]:
    """counts(code, n) with their shard; the whole counts (shard, k, code, n) of contexts that reach over a shard's ends; the shards' first keys, ascending, and numbers."""
    spark = counts.sparkSession
    ranged = staged(counts.withColumn("key", turned_column("code", order)).repartitionByRange(1 + counts.count() // most, "key").withColumn("shard", F.spark_partition_id()), "shards")
    found = sorted((r.low, r.shard) for r in ranged.groupBy("shard").agg(F.min("key").alias("low")).collect()) or [(0, 0)]  # a row per shard
    lows, numbers = (np.array(x, np.int64) for x in zip(*found, strict=True))
    ends = {(k, int(low) >> 8 * (order - k), int(numbers[i + side])) for i, low in enumerate(lows) for k in range(order) for side in (-1, 0) if i + side >= 0}
    edges = spark.createDataFrame(sorted(ends), "k int, prefix long, shard int")  # at most 2 * order a shard
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.shiftright("key", 8 * (order - k)).alias("prefix"), F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("code")) for k in range(order))))
    asked = small_or_shuffled(edges.select("k", "prefix").distinct(), len(ends))
    sums = ranged.select(levels.alias("at"), "n").select("at.*", "n").join(asked, ["k", "prefix"]).groupBy("k", "prefix", "code").agg(F.sum("n").alias("n"))
    whole = staged(sums.join(small_or_shuffled(edges, len(ends)), ["k", "prefix"]).select("shard", "k", "code", "n"), "shard-ends")
    return ranged.select("shard", "code", "n"), whole, lows, numbers


_PARTS = "kind string, part long, block binary, word binary, n long, shard int, codes binary"
_TYPES = {"part": pa.int64(), "block": pa.binary(), "word": pa.binary(), "n": pa.int64(), "shard": pa.int32(), "codes": pa.binary()}


def part_rows(kind: str, k: int, **columns) -> pa.RecordBatch:
    """k rows of one kind; columns that are not given are null."""
    return pa.RecordBatch.from_arrays([pa.array([kind]).take(pa.array(np.zeros(k, np.int64))), *(columns.get(name, pa.nulls(k, t)) for name, t in _TYPES.items())], names=["kind", *_TYPES])


def blocked(rows: pa.RecordBatch) -> bytes:
    """Rows as one compressed value, so that their texts are stored and shuffled small."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def plain(blob) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def coded(codes: np.ndarray) -> bytes:
    """Sorted strings as compressed differences."""
    return compressed(np.diff(codes, prepend=np.int64(0)).tobytes())


def decoded(blob) -> np.ndarray:
    return np.cumsum(np.frombuffer(plain(blob), np.int64))


def of_strings(strings: np.ndarray, codes: np.ndarray, log: np.ndarray) -> np.ndarray:
    """The value in log of each string, codes being sorted and holding them all; equal strings are looked up once."""
    by = np.argsort(strings)
    ordered = strings[by]
    first = np.nonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[0]
    out = np.empty(len(strings))
    out[by] = np.repeat(log[np.searchsorted(codes, ordered[first])], np.diff(first, append=len(strings)))
    return out


def count_words(words: pa.Array, trained: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and how many of each are trained on; those that never are only stand there."""
    place, names = numbered([words])
    return names, np.bincount(place[trained], minlength=len(names))


def parts(batches, order: int, lows: np.ndarray, numbers: np.ndarray):
    """Rows of kind doc (a block of a part's documents), word (a part's distinct word with its training count n) and ask (n distinct strings of a part that one shard answers)."""
    from pyspark import TaskContext

    part, size = TaskContext.get().partitionId() << 24, 0
    words: list[tuple[pa.Array, np.ndarray]] = []
    codes: list[np.ndarray] = []

    def closed():
        every = distinct_of(codes)
        shard = numbers[np.maximum(np.searchsorted(lows, turned(every, order), "right") - 1, 0)]
        for s in np.unique(shard).tolist():
            mine = every[shard == s]
            yield part_rows("ask", 1, part=pa.array([part]), n=pa.array([len(mine)]), shard=pa.array([s], pa.int32()), codes=pa.array([coded(mine)], pa.binary()))
        place, names = numbered([w for w, _ in words])
        n = np.bincount(place, np.concatenate([k for _, k in words]), len(names)).astype(np.int64)
        for at in range(0, len(names), 50_000):
            some = names[at : at + 50_000]
            yield part_rows("word", len(some), part=pa.array(np.full(len(some), part)), word=some.view(pa.binary()), n=pa.array(n[at : at + 50_000]))

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            yield part_rows("doc", 1, part=pa.array([part]), block=pa.array([blocked(rows)], pa.binary()))
            size += pc.sum(pc.binary_length(rows.column(2))).as_py() + rows.num_rows
            said, each = words_of(rows.column(2))
            words.append(count_words(said, np.repeat(~rows.column(1).to_numpy(zero_copy_only=False), each)))
            for cut in pieces(rows.column(2), order, BATCH_BYTES):
                codes.append(distinct_of([strings([b for _, b in cut], order)[0]]))
            if sum(map(len, codes)) > 2 * HELD_STRINGS:
                codes[:] = [distinct_of(codes)]
            if size > PART_BYTES:
                yield from closed()
                part, size = part + 1, 0
                words.clear()
                codes.clear()
    if codes:
        yield from closed()


def word_totals(words: DataFrame) -> DataFrame:
    """Replies to words(part, word, n): rows of part, words and ns (binary; many words of the part, and their counts in the whole corpus) for words that two
    parts or more have; each distinct word is counted once in the sums of kinds (1 if it was trained on) and tokens (its count)."""
    dealt = words.repartition("word")
    totals = dealt.groupBy("word").agg(F.sum("n").alias("total"), F.min("part").alias("first"), F.max("part").alias("last"))
    joined = dealt.join(totals, "word").select("part", "word", "total", (F.col("part") == F.col("first")).alias("lead"), (F.col("first") < F.col("last")).alias("shared"))

    def run(batches):
        for batch in batches:
            part, total, lead = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            cuts = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]]).tolist()
            rows = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                some = batch.slice(lo, hi - lo)
                once = total[lo:hi][lead[lo:hi]]
                told = some.filter(some.column(4))
                rows.append((int(part[lo]), compressed(b" ".join(told.column(1).to_pylist())), compressed(told.column(2).to_numpy().tobytes()), int((once > 0).sum()), int(once.sum())))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["part", "words", "ns", "kinds", "tokens"])

    return joined.sortWithinPartitions("part").mapInArrow(run, "part long, words binary, ns binary, kinds long, tokens long")


def packed(counts: DataFrame) -> DataFrame:
    """counts(shard, k, code, n) as rows of many: shard, k, codes and ns (binary)."""

    def run(batches):
        for batch in batches:
            shard, k, code, n = (batch.column(i).to_numpy() for i in range(4))
            by = np.lexsort((code, k, shard))
            shard, k, code, n = shard[by], k[by], code[by], n[by]
            cuts = np.nonzero((np.diff(shard) != 0) | (np.diff(k) != 0))[0] + 1
            rows = [(int(shard[i[0]]), int(k[i[0]]), coded(code[i]), n[i].tobytes()) for i in np.split(np.arange(len(shard)), cuts) if len(i)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())], names=["shard", "k", "codes", "ns"])

    return counts.select("shard", "k", "code", "n").mapInArrow(run, "shard int, k int, codes binary, ns binary")


def answers(counts: DataFrame, whole: DataFrame, asks: DataFrame, order: int) -> DataFrame:
    """part, codes and logs (binary, in step) for asks(part, shard, codes, n): each cell has one shard's trie and answers one part after the other."""
    sizes = staged(asks.groupBy("shard").agg(F.ceil(F.sum("n") / CELL_STRINGS).cast("int").alias("cells")), "shard-cells")
    cells = small_or_shuffled(sizes, sizes.count())
    strings_of = packed(counts.withColumn("k", F.lit(order)).unionByName(whole)).join(cells, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.lit(0).alias("step"), "k", F.lit(None).cast("long").alias("part"), "codes", "ns")
    asking = asks.join(cells, "shard").select("shard", F.pmod(F.xxhash64("part"), "cells").cast("int").alias("cell"), F.lit(1).alias("step"), F.lit(0).alias("k"), "part", "codes", F.lit(None).cast("binary").alias("ns"))
    dealt = strings_of.unionByName(asking).repartition("shard", "cell").sortWithinPartitions("shard", "cell", "step")

    def run(batches):
        cell, trie, own = None, None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for shard, at, step, k, part, codes, ns in zip(*columns, batch.column(5), batch.column(6), strict=True):
                if (shard, at) != cell:
                    cell, trie, own = (shard, at), None, []
                got = decoded(codes.as_buffer())
                if step == 0:
                    own.append((k, got, np.frombuffer(ns.as_py(), np.int64)))
                    continue
                if trie is None:
                    none = [np.zeros(0, np.int64)]
                    by_k = {j: ([c for i, c, _ in own if i == j] or none, [n for i, _, n in own if i == j] or none) for j in {order, *(i for i, _, _ in own)}}
                    flat = {j: (np.concatenate(c), np.concatenate(n)) for j, (c, n) in by_k.items()}
                    trie, own = Trie(*flat.pop(order), flat, order), []
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([codes.as_py()], pa.binary()), pa.array([trie.log10(got).tobytes()], pa.binary())], names=["part", "codes", "logs"])

    return dealt.mapInArrow(run, "part long, codes binary, logs binary")


def scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Learn from the rows of docs where held_out is false and score all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    counts, whole, lows, numbers = sharded(staged(count_strings(texts.where("NOT held_out").select("text"), order), "strings"), order, SHARD_STRINGS)
    cut = staged(texts.mapInArrow(lambda batches: parts(batches, order, lows, numbers), _PARTS), "parts")
    replied = staged(word_totals(cut.where("kind = 'word'").select("part", "word", "n")), "word-totals")
    ends = texts.where("NOT held_out").count()
    told = replied.agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    tokens, kinds = told.tokens + ends, told.kinds + (1 if ends else 0)
    each, end = float(np.log10(tokens + kinds + 1)), float(np.log10(ends + 1))
    null = F.lit(None).cast("binary")
    logs = answers(counts, whole, cut.where("kind = 'ask'").select("part", "shard", "codes", "n"), order)
    replies = logs.select("part", null.alias("words"), null.alias("ns"), "codes", "logs").union(replied.select("part", "words", "ns", null, null))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in left["block"]]
        docs = pa.concat_tables(found).combine_chunks().to_batches() if found else []
        blobs = right.filter(pc.is_valid(right["codes"]))
        codes = np.concatenate([np.zeros(0, np.int64), *(decoded(b.as_buffer()) for b in blobs["codes"])])
        log = np.concatenate([np.zeros(0), *(np.frombuffer(b.as_buffer(), np.float64) for b in blobs["logs"])])
        by = np.argsort(codes)
        codes, log = codes[by], log[by]
        cut = [words_of(rows.column(2)) for rows in docs]
        place, names = numbered([w for w, _ in cut])
        trained = [np.repeat(~rows.column(1).to_numpy(zero_copy_only=False), n) for rows, (_, n) in zip(docs, cut, strict=True)]
        count = np.bincount(place[np.concatenate([np.zeros(0, bool), *trained])], minlength=len(names))
        said = right.filter(pc.is_valid(right["words"]))
        others = words_of(pa.array([plain(b.as_buffer()) for b in said["words"]], pa.binary()))[0]  # these have their counts in the whole corpus
        count[pc.index_in(others, value_set=names).to_numpy()] = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(plain(b.as_buffer()), np.int64) for b in said["ns"])])
        known, passed = np.log10(count + 1.0)[place], 0
        results = []
        for rows in docs:
            k = rows.num_rows
            score, base, n_tokens, n_known = np.zeros(k), [], [], []
            for some in pieces(rows.column(2), order, BATCH_BYTES):
                each_byte, starts = strings([b for _, b in some], order)
                np.add.at(score, [r for r, _ in some], np.add.reduceat(of_strings(each_byte, codes, log), starts))
            for n in cut.pop(0)[1].tolist():
                counted = known[passed : passed + n].tolist()
                passed += n
                n_tokens.append(n + 1)
                n_known.append(int(ends > 0) + n - counted.count(0.0))
                base.append(end + sum(counted) - each * (n + 1))
            results.append(pa.table({"doc_id": rows.column(0), "held_out": rows.column(1), "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([tokens] * k, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(score)}))
        return pa.concat_tables(results)

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    blocks = cut.where("kind = 'doc'").select("part", "block")
    return blocks.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(answer, out)


def held_out(id_col: str = "doc_id"):
    """Rows never learned from: the id's CRC-32 leaves 2 when divided by 7."""
    return crc_of_id(id_col) % 7 == 2
