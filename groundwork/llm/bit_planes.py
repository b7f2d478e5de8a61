"""Token-id files of shuffled planes.

Ids are cut into blocks of a fixed size. A block is transposed into bit planes or byte planes, each plane is
compressed with zstandard, and the file ends in an index of its blocks and documents, so that a reader can fetch
any block alone. A file is

    magic, planes of block 0, planes of block 1, ..., index (zstandard-compressed JSON head and int64 arrays), length of the index, magic

Files are written by Spark tasks under names of their own; only files listed in the committed manifest count, so a
task that is run again leaves an orphan behind and nothing else.

Null texts count as empty: they have only the end id. Rows with equal document ids follow each other, ordered by text;
null ids come first. An empty table gives no files and no rows.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundwork.llm.bpe_words import chunks, vocabulary
from groundwork.llm.common import held, new_path, staged

MAGIC = b"IDPLANE1"
BLOCK_IDS = 65_536
FILE_IDS = 4_000_000


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of one block of uint32 ids, lowest first; planes of zeros at the top are left out."""
    bits = int(ids.max(initial=0)).bit_length()
    width = (bits + 7) // 8
    as_bytes = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    if planes == "byte":
        return [np.ascontiguousarray(as_bytes[:, i]).tobytes() for i in range(width)]
    rows = []
    for i in range(width):
        column = np.ascontiguousarray(as_bytes[:, i])
        rows += [np.packbits(column & np.uint8(1 << k), bitorder="little").tobytes() for k in range(min(8, bits - 8 * i))]
    return rows


def from_planes(rows: list[bytes], n: int, planes: str) -> np.ndarray:
    """The uint32 ids of one block."""
    table = np.zeros((n, 4), np.uint8)
    if planes == "byte":
        for i, row in enumerate(rows):
            table[:, i] = np.frombuffer(row, np.uint8)
        return table.view("<u4").reshape(-1)
    for i in range(0, len(rows), 8):
        column = np.zeros(n, np.uint8)
        for k, row in enumerate(rows[i : i + 8]):
            column |= np.unpackbits(np.frombuffer(row, np.uint8), count=n, bitorder="little") << np.uint8(k)
        table[:, i // 8] = column
    return table.view("<u4").reshape(-1)


class IdFileWriter:
    """Collects documents' ids and gives the bytes of a whole file; it holds compressed blocks and one open block."""

    def __init__(self, planes: str = "bit", block_ids: int = BLOCK_IDS, level: int = 1):
        self.planes, self.block_ids, self.zstd = planes, block_ids, zstandard.ZstdCompressor(level=level)
        self.out, self.blocks, self.open, self.n_open = io.BytesIO(), [], [], 0
        self.out.write(MAGIC)
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        self.open.append(ids)
        self.n_open += len(ids)
        if self.n_open >= self.block_ids:
            whole = np.concatenate(self.open)
            full = len(whole) // self.block_ids * self.block_ids
            for at in range(0, full, self.block_ids):
                self._block(whole[at : at + self.block_ids])
            self.open, self.n_open = [whole[full:]], len(whole) - full

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.zstd.compress(p) for p in to_planes(ids, self.planes)]
        self.blocks.append({"n": len(ids), "at": self.out.tell(), "planes": [len(p) for p in packed]})
        for p in packed:
            self.out.write(p)

    def finish(self) -> bytes:
        if self.n_open:
            self._block(np.concatenate(self.open))
            self.open, self.n_open = [], 0
        head = json.dumps({"planes": self.planes, "blocks": self.blocks, "nulls": [i for i, d in enumerate(self.doc_ids) if d is None], "docs": len(self.doc_ids)}).encode()
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes()
        index = self.zstd.compress(struct.pack("<q", len(head)) + head + ids + np.array(self.lengths, "<i8").tobytes())
        self.out.write(index + struct.pack("<q", len(index)) + MAGIC)
        return self.out.getvalue()


class IdFile:
    """A file's bytes, read by its index."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC or data[-8:] != MAGIC:
            raise ValueError("not a token-id file, or a broken one")
        self.data, self.zstd = data, zstandard.ZstdDecompressor()
        (size,) = struct.unpack("<q", data[-16:-8])
        index = self.zstd.decompress(data[-16 - size : -16])
        (head_size,) = struct.unpack("<q", index[:8])
        head = json.loads(index[8 : 8 + head_size])
        n = head["docs"]
        at = 8 + head_size
        nulls = set(head["nulls"])
        self.planes, self.blocks = head["planes"], head["blocks"]
        self.doc_ids = [None if i in nulls else d for i, d in enumerate(np.frombuffer(index, "<i8", n, at).tolist())]
        self.lengths = np.frombuffer(index, "<i8", n, at + 8 * n)

    def block(self, k: int) -> np.ndarray:
        b, rows = self.blocks[k], []
        at = b["at"]
        for size in b["planes"]:
            rows.append(self.zstd.decompress(self.data[at : at + size]))
            at += size
        return from_planes(rows, b["n"], self.planes)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, first id's place in the file, ids), holding only the blocks that a document touches."""
        k, held, base, at = 0, np.zeros(0, np.uint32), 0, 0
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist(), strict=True):
            parts = [held]
            have = base + len(held)
            while have < at + n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, at, held[at - base : at - base + n]
            at += n
            held, base = held[at - base :], at


class _Pieces(dict):
    """Ids (as bytes) by piece, from the tokenizers library's own model."""

    def __init__(self, model):
        self.tokenize = model.tokenize

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = array("I", [t.id for t in self.tokenize(piece)]).tobytes()
        return ids


class _Chunks(dict):
    """Ids (as bytes) by chunk."""

    def __init__(self, vocab, pieces: _Pieces):
        self.vocab, self.pieces, self.piece = vocab, pieces, pieces.__getitem__

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            ids = self.pieces[chunk.lower()]
        elif (cut := self.vocab.pieces(chunk)) is None:
            ids = array("I", self.vocab.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        else:
            ids = b"".join(map(self.piece, cut))
        self[chunk] = ids
        return ids


class DocumentEncoder:
    """Ids of whole texts by the tokenizers library, each distinct chunk and piece encoded once while it is remembered."""

    def __init__(self, path: str, end_id: int | None, most: int = 900_000):
        vocab = vocabulary(path)
        self.end, self.most = b"" if end_id is None else array("I", [end_id]).tobytes(), most
        self.pieces = _Pieces(vocab.tokenizer.model)
        self.chunks = _Chunks(vocab, self.pieces)
        self.look = self.chunks.__getitem__

    def encode(self, text: str) -> np.ndarray:
        for held in (self.chunks, self.pieces):
            if len(held) > self.most:
                held.clear()
        return np.frombuffer(b"".join(map(self.look, chunks(text))) + self.end, np.uint32)


MANIFEST = "file string, part int, seq int, n_docs long, n_ids long, n_bytes long"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", planes: str = "bit", folder: str | None = None, file_ids: int = FILE_IDS) -> tuple[str, DataFrame]:
    """Encode every text and write its ids, in ascending order of id_col, as files in folder (by default a new one in the shared folder).

    Returns the folder and the committed manifest: file, part, seq (their order), n_docs, n_ids, n_bytes.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-ids")
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        encoder = held(("documents", tokenizer_path, end_id), lambda: DocumentEncoder(tokenizer_path, end_id))
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0

        def flush(writer: IdFileWriter):
            data = writer.finish()
            name = f"ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.idp"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(data)
            return pa.RecordBatch.from_pylist([{"file": name, "part": part, "seq": seq, "n_docs": len(writer.doc_ids), "n_ids": writer.n_ids, "n_bytes": len(data)}], schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

        writer = IdFileWriter(planes)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                writer.add(doc_id, encoder.encode(text.as_py()))
                if writer.n_ids >= file_ids:
                    yield flush(writer)
                    writer, seq = IdFileWriter(planes), seq + 1
        if writer.doc_ids:
            yield flush(writer)

    return folder, staged(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, digest_only: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids (array) unless digest_only."""
    if not manifest.take(1):
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
        return spark.createDataFrame([], schema)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("file_start"))
    files = spark.read.format("binaryFile").load(f"{folder}/*.idp").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    schema = "file string, doc_id long, at long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [(d, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), None if digest_only else ids.astype(np.int64)) for d, at, ids in IdFile(data.as_py()).documents()]
                columns = [pa.array([name] * len(rows)), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(4))]
                names = ["file", "doc_id", "at", "n_tokens", "ids_crc32"]
                if not digest_only:
                    columns.append(pa.array([r[4] for r in rows], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rest = [] if digest_only else ["ids"]
    return files.mapInArrow(run, schema).join(starts, "file").select("doc_id", (F.col("at") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32", *rest)
