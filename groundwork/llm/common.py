"""What the operators of this subpackage share: the shared folder, staged tables, split rules and byte-balanced batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: At most this many rows, and bytes of values in them, are ever broadcast; beyond either the same join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or one of our own where that is unset (as in tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="groundwork-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store_of(folder: str):
    """The file system of a shared folder and the folder's path in it, for tasks that read or write files there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and lost executors lose nothing.

    Nobody else reads the folder, so it gets no _SUCCESS marker, whose two files would start two of chmod beside the driver on a local store.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number of its own for each row, the same in every later plan, and the name of that column.

    Rows of Parquet files are numbered by their file (a row per file is joined to them, 16 bytes each) and place, so nothing is copied; other rows are
    written once with their numbers.
    """
    row, file, at = unused(docs, "row"), unused(docs, "file_hash"), unused(docs, "row_place")
    try:
        files = docs.select(F.col("_metadata.file_path").alias("path")).distinct()
        placed = docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    except AnalysisException:  # rows that do not come straight from files
        files = None
    if files is not None:
        numbered = staged(files.select(F.xxhash64("path").alias(file), "path", F.row_number().over(Window.orderBy("path")).cast("long").alias("number")), "files")
        n = numbered.count()
        if n == numbered.select(file).distinct().count():
            keyed = placed.join(small_or_shuffled(numbered.select(file, "number"), n), file)
            return keyed.select(*docs.columns, (F.shiftleft("number", 38) + F.col(at)).alias(row)), row
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents-by-row"), row


_HELD: dict = {}
#: Empty the caches that freed() empties with it.
_CACHES: list[Callable[[], None]] = []


def until_freed(make):
    """make, with its last results remembered until freed()."""
    cached = lru_cache(maxsize=4)(make)
    _CACHES.append(cached.cache_clear)
    return cached


def held(key, make):
    """A Python worker's one large memory, made by make(); asking for another drops it, as workers serve many operators one after the other."""
    if key not in _HELD:
        freed()
        _HELD[key] = make()
    return _HELD[key]


def freed() -> None:
    """Drop the memory that held() and until_freed() keep in this Python worker: operators that do not use it call this first."""
    _HELD.clear()
    for clear in _CACHES:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_or_shuffled(df: DataFrame, rows: int, n_bytes: int | None = None) -> DataFrame:
    """A join side of `rows` counted rows: broadcast it while that is within BROADCAST_ROWS, else leave it to a shuffle join.

    Rows are numbers, or short strings of a fixed length, of at most 128 bytes; of others n_bytes, their bytes, is counted as well.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (rows * 128 if n_bytes is None else n_bytes) <= BROADCAST_BYTES else df


def crc_of_id(col: str) -> Column:
    """CRC-32 of an id written as text; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def byte_batches(items: Iterable[str], max_bytes: int) -> Iterator[list[str]]:
    """Consecutive lists of texts of about max_bytes in all; a longer text is a list of its own."""
    batch: list[str] = []
    size = 0
    for item in items:
        n = (len(item) if item.isascii() else len(item.encode())) + 1
        if batch and size + n > max_bytes:
            yield batch
            batch, size = [], 0
        batch.append(item)
        size += n
    if batch:
        yield batch


class Chunks:
    """What a worker remembers of chunks of text, as bytes: up to most_bytes in all, no chunk of more than `longest` characters.

    Half of it is what was wanted last; when that is full it becomes the older half, of which only what is wanted again is taken over.
    """

    def __init__(self, most_bytes: int, longest: int = 1000):
        self.most_bytes, self.longest, self.size = most_bytes, longest, 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.passing: list[str] = []

    @staticmethod
    def bytes_of(some: dict[str, bytes]) -> int:
        return 240 * len(some) + 2 * sum(map(len, some)) + sum(map(len, some.values()))

    def finder(self, wanted: set[str], learn):
        """A function from each wanted chunk to its bytes, good until the next call; learn(list of chunks) gives those of chunks not remembered."""
        for c in self.passing:
            del self.known[c]
        missing = wanted.difference(self.known)
        new = {c: self.older[c] for c in missing.intersection(self.older)}
        new.update(learn(list(missing.difference(new))))
        self.passing = [c for c in new if len(c) > self.longest]
        self.size += self.bytes_of(new) - self.bytes_of({c: new[c] for c in self.passing})
        if self.size > self.most_bytes // 2:
            self.older = self.known
            self.known = {c: self.older[c] for c in wanted.difference(new)}
            self.size = self.bytes_of(self.known)
        self.known.update(new)
        return self.known.__getitem__


def free_names(keep: Iterable[str], *names: str) -> list[str]:
    """Names for the outputs beside kept columns: one that a kept column has gets underscores in front."""
    taken, out = {k.lower() for k in keep}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def byte_slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about max_bytes of that text column in each; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def share_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Write data to the shared folder and hand it to all executors; returns the name for SparkFiles."""
    file, folder = f"{name}-{uuid.uuid4().hex}.bin", new_path(spark, name)
    store, root = store_of(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{file}") as out:
        out.write(data)
    spark.sparkContext.addFile(f"{folder}/{file}")
    return file


def reading(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)
