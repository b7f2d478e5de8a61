"""Exact dedup by Golomb-coded fingerprint exchange.

Texts are equal when they are identical after white space (space and the characters 9 to 13) is deleted.

1. Each task reads its rows once and hashes each normalised text to 64 bits. Per part of at most PART_ROWS rows, the
   sorted distinct hashes are cut by their owner (the hash's leading bits), and each cut goes to its owner as one
   Golomb-Rice coded blob. A hash that a part holds twice is marked in a bitmap beside the blob.
2. Each owner decodes its blobs, finds the hashes that stand in two parts or are marked, and returns one bitmap a part.
3. Each part reads its own bitmaps (and no others) from the shared folder and keeps its own rows that they mark: the suspects.
4. Only suspects are shuffled, for the verification by bytes: they are grouped by hash and whole normalised text, with
   partial aggregation before the shuffle, so a group that holds a third of all rows costs one row a task.

All exchanges carry one row per part and owner or one per distinct text and task; no group of rows is gathered, and nothing is broadcast
but groups of copies of a checked number. Null texts count as empty, and all empty texts are equal. Equal rows (same id, same text) are rows of one group.
Null ids stand after all others when ties are settled. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import freed, new_path, row_keyed, small_or_shuffled, staged, store_of

#: Rows of a part, and of hashes that one owner gets on average.
PART_ROWS, OWNER_HASHES = 200_000, 1_000_000
WHITE = b" \t\n\x0b\x0c\r"


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Rice parameter and code of sorted distinct uint64 values: differences as unary quotients and k-bit remainders."""
    if not len(values):
        return 0, b""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = int(gaps.astype(np.float64).mean()) + 1
    k = max(0, min(63, mean.bit_length() - 1))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    rest = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - k :]
    return k, np.int64(len(values)).tobytes() + np.int64(len(unary)).tobytes() + np.packbits(unary).tobytes() + np.packbits(rest.reshape(-1)).tobytes()


def golomb_decode(k: int, code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, np.uint64)
    n, n_unary = np.frombuffer(code, np.int64, 2)
    at = 16 + (int(n_unary) + 7) // 8
    ends = np.nonzero(np.unpackbits(np.frombuffer(code[16:at], np.uint8), count=int(n_unary)))[0]
    quotients = np.diff(ends, prepend=-1) - 1
    full = np.zeros((int(n), 64), np.uint8)
    if k:
        full[:, 64 - k :] = np.unpackbits(np.frombuffer(code[at:], np.uint8), count=int(n) * k).reshape(int(n), k)
    gaps = np.packbits(full, axis=1).view(">u8").reshape(-1).astype(np.uint64) + (quotients.astype(np.uint64) << np.uint64(k))
    return np.cumsum(gaps, dtype=np.uint64)


_ROWS = {"doc_id": pa.int64(), "row": pa.int64(), "hash": pa.int64(), "n_chars": pa.int64(), "text_sha256": pa.string(), "plain": pa.binary(), "part": pa.int64()}
_CODES = {"owner": pa.int32(), "k": pa.int32(), "code": pa.binary(), "twice": pa.binary()}


def fingerprints(docs: DataFrame, owner_bits: int, hash_bits: int = 64) -> DataFrame:
    """One scan of docs(doc_id, row, n_chars, text): a row per document (kind doc, with its normalised text) and a row per part and owner (kind code)."""
    schema = "kind string, doc_id long, row long, hash long, n_chars long, text_sha256 string, plain binary, part long, owner int, k int, code binary, twice binary"
    arrow = pa.schema([("kind", pa.string()), *_ROWS.items(), *_CODES.items()])

    def run(batches):
        from pyspark import TaskContext

        freed()
        part, held, n_held = TaskContext.get().partitionId() << 24, [], 0

        def exchange():
            values, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            owners = (values >> np.uint64(64 - owner_bits)).astype(np.int64) if owner_bits else np.zeros(len(values), np.int64)
            for owner in np.unique(owners).tolist():
                mine = owners == owner
                k, code = golomb_encode(values[mine])
                yield {"kind": "code", "part": part, "owner": owner, "k": k, "code": code, "twice": np.packbits(counts[mine] > 1).tobytes()}

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                n, plain, digests, hashes = some.num_rows, [], [], np.empty(some.num_rows, np.int64)
                for i, text in enumerate(some.column(3)):
                    plain.append(text.as_py().translate(None, WHITE))
                    d = hashlib.sha256(plain[-1])
                    digests.append(d.hexdigest())
                    hashes[i] = int.from_bytes(d.digest()[:8], "big", signed=True) >> (64 - hash_bits) << (64 - hash_bits)
                yield pa.RecordBatch.from_arrays([pa.array(["doc"] * n, pa.string()), some.column(0), some.column(1), pa.array(hashes), some.column(2), pa.array(digests, pa.string()), pa.array(plain, pa.binary()), pa.array(np.full(n, part)), *(pa.nulls(n, t) for t in _CODES.values())], schema=arrow)
                held.append(hashes)
                n_held += n
                if n_held >= PART_ROWS:
                    yield pa.RecordBatch.from_pylist(list(exchange()), schema=arrow)
                    part, held, n_held = part + 1, [], 0
        if n_held:
            yield pa.RecordBatch.from_pylist(list(exchange()), schema=arrow)

    return docs.select("doc_id", "row", "n_chars", "text").mapInArrow(run, schema)


def marked(k: int, code: bytes, bitmap: bytes) -> np.ndarray:
    """The hashes of a blob that its bitmap marks."""
    values = golomb_decode(k, code)
    return values[np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(values)).astype(bool)]


def bitmaps(codes: DataFrame) -> str:
    """The owners' answers to the parts' codes(part, owner, k, code, twice), as a folder of one folder per part: owner, k, code and common, the bitmap of
    the hashes that stand for two rows or more."""

    def owner(table: pa.Table) -> pa.Table:
        parts = [golomb_decode(k, c) for k, c in zip(table["k"].to_pylist(), table["code"].to_pylist(), strict=True)]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(v)).astype(bool) for t, v in zip(table["twice"].to_pylist(), parts, strict=True)]
        seen, counts = np.unique(np.concatenate([*parts, *(v[t] for t, v in zip(twice, parts, strict=True))]), return_counts=True)
        common = seen[counts > 1]
        maps = [np.packbits(np.isin(v, common, assume_unique=True)).tobytes() for v in parts]
        return pa.table({"part": table["part"], "owner": table["owner"], "common": pa.array(maps, pa.binary())})

    path = new_path(codes.sparkSession, "bitmaps")
    told = codes.select("part", "owner", "k", "code", "twice").groupBy("owner").applyInArrow(owner, "part long, owner int, common binary")
    codes.select("part", "owner", "k", "code").join(told, ["part", "owner"]).repartition("part").write.partitionBy("part").parquet(path)
    return path


def suspects(rows: DataFrame, folder: str) -> DataFrame:
    """The rows(part, hash, plain, n_chars, doc_id, row) whose part's bitmaps in the folder mark their hash."""

    def run(batches):
        import pyarrow.dataset as ds

        store, root = store_of(folder)
        now, common = None, np.zeros(0, np.int64)
        for batch in batches:
            part, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for p in np.unique(part).tolist():
                if p != now:
                    blobs = ds.dataset(f"{root}/part={p}", filesystem=store, format="parquet").to_table(columns=["k", "code", "common"]).to_pylist()
                    now, common = p, np.concatenate([marked(b["k"], b["code"], b["common"]) for b in blobs]).view(np.int64)
                mine = part == p
                keep[mine] = np.isin(hashes[mine], common)
            yield batch.filter(pa.array(keep))

    told = rows.select("part", "hash", "plain", "n_chars", "doc_id", "row")
    return told.mapInArrow(run, told.schema)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, hash_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id (the row that stays: most code points, then the smallest id), group_size, kept, text_sha256.

    Of rows that share both id and text, each is marked kept if its id is the keep_id. With row_col, a distinct number for each row, there are row and
    stays too: of rows that share id and text, only that of the smallest number stays. Hashes of fewer bits change the work, not the rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    told = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"), F.char_length(text).cast("long").alias("n_chars"), text.cast("binary").alias("text"))
    owner_bits = max(0, min(20, (docs.count() // OWNER_HASHES).bit_length()))
    exchanged = staged(fingerprints(told, owner_bits, hash_bits), "fingerprints", "kind")
    rows = exchanged.where("kind = 'doc'")
    verified = (
        suspects(rows, bitmaps(exchanged.where("kind = 'code'")))
        .groupBy("hash", "plain")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("n_chars", (-F.col("doc_id")).alias("first"), (-F.col("row")).alias("at"))).alias("best"))
        .where("group_size > 1")
        .select("hash", F.sha2("plain", 256).alias("text_sha256"), "group_size", (-F.col("best.first")).alias("keep_id"), (-F.col("best.at")).alias("keep_row"))
    )
    groups = staged(verified, "copies")
    alone = F.col("group_size").isNull()
    found = rows.select("doc_id", "row", "hash", "text_sha256").join(small_or_shuffled(groups, groups.count()), ["hash", "text_sha256"], "left")
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    out = [F.col("doc_id"), keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), F.col("text_sha256")]
    return found.select(*out, *([F.col("row"), (alone | (F.col("row") == F.col("keep_row"))).alias("stays")] if row_col else []))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows that share id and text, one stays."""
    keyed, row = row_keyed(docs)
    gone = staged(exact_duplicates(keyed, id_col, text_col, row).where("NOT stays").select(F.col("row").alias(row)), "gone")
    return keyed.join(small_or_shuffled(gone, gone.count()), row, "left_anti").select(*docs.columns)
