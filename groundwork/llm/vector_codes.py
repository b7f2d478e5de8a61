"""Vector code compression: product codes whose codebooks are refined by rounds of integer k-means with exponion search.

A vector is cut into equal parts; each part is replaced by the number of its nearest codebook entry. A round's search for one part starts at
the entry that the part had before, a, at distance u: every entry at distance u or less from the part is within 2u of a, by the triangle inequality, so only the
entries in that radius, a beginning of a's distance-sorted list of neighbours, are looked at, ties included. All distances are squared and
whole: a neighbour at squared distance D is looked at while D <= 4 u². Equal distances go to the lower index.

Each round writes the vectors with their entries in the shared folder and adds up each entry's parts in the tasks, so that only sums, a row for each task
and entry, are shuffled, and one row an entry comes to the driver.

Rows whose vector is null or holds null, NaN or infinite components are dropped. Null ids come after all others in the choice of the first
entries; among equal ids vectors decide, in their order. Fewer vectors than entries make smaller codebooks; an empty table gives no rows. Vectors of
unequal lengths, of lengths that do not divide by the parts, or with components beyond 2 ** 26 / scale are errors, as no exact code exists for them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import free_names, freed, small_or_shuffled, staged

#: Squared distances of up to 2 ** 10 components within this are exact in 64 bits.
MOST = 1 << 26
#: Within this, and 2 ** 7 components a part, products are exact as doubles, which are multiplied faster.
DOUBLE = 1 << 22
#: Labels' totals meet the rows in so many parts where they are not broadcast.
SALT = 16


def whole_vectors(rows: DataFrame, scale: int = 1024, vector_col: str = "embedding") -> DataFrame:
    """rows with v, floor(scale * x) of every component as an array of ints, in place of the vector; rows without a finite vector are left out."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    small = F.forall(whole, lambda c: F.abs(c) <= MOST)
    checked = F.when(small, whole.cast("array<int>")).otherwise(F.raise_error(F.lit("a component is too large for exact codes")).cast("array<int>"))
    return rows.where(x.isNotNull() & finite).withColumn("v", checked).drop(vector_col)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows of whole numbers, exact."""
    exact = np.float64 if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) <= DOUBLE and x.shape[1] <= 128 else np.int64
    a, b = x.astype(exact), y.astype(exact)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


class Neighbours:
    """A codebook (rows of whole numbers) with each entry's list of all entries by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = distances(entries, entries)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def nearest(self, x: np.ndarray, before: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row of x, and its squared distance; before: the entry to start at."""
        own = x - self.entries[before]
        reach = 4 * (own * own).sum(1)
        index, least = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        by_entry = np.lexsort((reach, before))
        for rows in np.split(by_entry, np.nonzero(np.diff(before[by_entry]))[0] + 1) if len(x) else ():
            a = before[rows[0]]
            for at in range(0, len(rows), block):  # rows of like reach together
                some = rows[at : at + block]
                n = np.searchsorted(self.apart[a], reach[some], side="right")
                near = self.order[a, : n[-1]]
                d = distances(x[some], self.entries[near])
                d[np.arange(len(near)) >= n[:, None]] = np.iinfo(np.int64).max
                least[some] = d.min(axis=1)
                index[some] = np.where(d == least[some][:, None], near, len(self.entries)).min(axis=1)
        return index, least


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1).astype(np.int64) if len(column) and len(flat) else np.zeros((len(column), 0), np.int64)


def assigned(vectors: DataFrame, codebooks: np.ndarray, codes_col: str | None) -> DataFrame:
    """vectors(..., v) with codes (array of int, one a part) and errors (their squared distances added up); codes_col: those of the round before."""
    kept = [c for c in vectors.columns if c not in ("codes", "errors")]
    out = vectors.select(*kept, F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("errors")).schema
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)  # parts x entries x components of the parameters
    at_v, at_codes = vectors.columns.index("v"), vectors.columns.index(codes_col) if codes_col else None
    at_kept = [vectors.columns.index(c) for c in kept]

    def run(batches):
        freed()
        books = [Neighbours(b) for b in shared.value]
        for batch in batches:
            x = _matrix(batch.column(at_v))
            before = _matrix(batch.column(at_codes)) if at_codes is not None else np.zeros((len(x), len(books)), np.int64)
            width = x.shape[1] // len(books)
            found = [b.nearest(x[:, p * width : (p + 1) * width], before[:, p]) for p, b in enumerate(books)]
            codes = np.stack([f[0] for f in found], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, len(books)), pa.int32()), pa.array(codes.ravel(), pa.int32()))
            errors = pa.array(sum(f[1] for f in found), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at_kept), lists, errors], names=[*kept, "codes", "errors"])

    return vectors.mapInArrow(run, out)


def refined(coded: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks with each entry replaced by floor(sum / count) of its parts; an entry without parts stays."""
    n_parts, n_entries, width = codebooks.shape

    def run(batches):
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((n_parts, n_entries), np.int64)
        for batch in batches:
            x, codes = _matrix(batch.column(0)), _matrix(batch.column(1))
            for p in range(n_parts):
                order = np.argsort(codes[:, p], kind="stable")
                entries, starts = np.unique(codes[order, p], return_index=True)
                if len(entries) and width:
                    sums[p, entries] += np.add.reduceat(x[order, p * width : (p + 1) * width], starts, axis=0)
                counts[p] += np.bincount(codes[:, p], minlength=n_entries)
        part, entry = np.nonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(sums[part, entry].ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()), lists], names=["part", "entry", "n", "sums"])

    partial = coded.select("v", "codes").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    totals = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)))
    new = codebooks.copy()
    for r in totals.collect():  # at most one row for each entry of the parameters
        new[r.part, r.entry] = [r[3 + i] // r.n for i in range(width)]
    return new


def first_codebooks(vectors: DataFrame, n_parts: int, n_entries: int, id_col: str) -> np.ndarray:
    """The parts of the vectors of the smallest ids."""
    first = [r.v for r in vectors.orderBy(F.col(id_col).asc_nulls_last(), "v").select("v").limit(n_entries).collect()]
    x = np.array(first, np.int64).reshape(len(first), -1)
    return np.stack(np.split(x, n_parts, axis=1))


def vector_codes(
    rows: DataFrame, n_parts: int = 4, n_entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = ("label",)
) -> tuple[DataFrame, np.ndarray]:
    """id, keep columns, v, codes and errors of every kept row, and the final codebooks (parts x entries x components).

    Other columns are not read; v, codes or errors get an underscore in front where a kept column has the name.
    """
    kept = [id_col, *keep]
    inner = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(kept)]
    vectors = staged(whole_vectors(rows.select(*inner, F.col(vector_col).alias("given")), scale, "given"), "whole-vectors")
    sizes = vectors.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if sizes.lo is None:
        codebooks, coded = np.zeros((n_parts, 0, 0), np.int64), vectors.withColumns({"codes": F.array().cast("array<int>"), "errors": F.lit(0).cast("long")})
    elif sizes.lo != sizes.hi or sizes.lo % n_parts:
        raise ValueError(f"vectors of {sizes.lo} to {sizes.hi} components have no {n_parts} equal parts")
    else:
        codebooks = first_codebooks(vectors, n_parts, n_entries, "kept_0")
        coded = staged(assigned(vectors, codebooks, None), "coded-vectors")
        for _ in range(rounds):
            codebooks = refined(coded, codebooks)
            coded = staged(assigned(coded, codebooks, "codes"), "coded-vectors")
    return coded.toDF(*kept, *free_names(kept, "v", "codes", "errors")), codebooks


def codebooks_sha256(codebooks: np.ndarray) -> str:
    """Of all components as decimal numbers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def code_text(codes: Column) -> Column:
    """Two hexadecimal digits a part."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def with_label_errors(coded: DataFrame, label_col: str = "label", error_col: str = "errors", salt_col: str = "vec_id") -> DataFrame:
    """coded with label_error: errors added up over the rows of equal labels, nulls together; a label's rows never meet in one task."""
    (shown,) = free_names(coded.columns, "label_error")
    totals = staged(coded.groupBy(F.col(label_col).alias("of_label")).agg(F.sum(error_col).alias(shown)), "label-errors")
    n, same = totals.count(), F.col(label_col).eqNullSafe(F.col("of_label"))
    side = small_or_shuffled(totals, n)
    if side is not totals:
        return coded.join(side, same).drop("of_label")
    side = totals.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return coded.withColumn("salt", F.pmod(F.xxhash64(salt_col), F.lit(SALT)).cast("int")).join(side, same & (F.col("salt") == F.col("of_salt"))).drop("salt", "of_salt", "of_label")
