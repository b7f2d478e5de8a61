"""WARC archives by way of a chunked record table.

A payload becomes rows (record, chunk number, bytes) of at most CHUNK bytes: the writer appends chunks to the open archive as they
come, the reader reads the archive as a stream, and both carry a SHA-1 from chunk to chunk: a task holds one payload as the table gives it
(one value) and one chunk besides; no record and no archive is ever put together. The digest
pass finds equal payloads (of at least min_bytes) by their digest, length and 64-bit hash: the record with the smallest page id is
written as a response, the others as revisits of it without payload; smaller payloads are all responses. The writer checks every digest that it
carried against the digest pass, the reader every response's payload against its header.

Archives are written by Spark tasks under names of their own and count only once they stand in the committed manifest. Each
record is stored as a gzip-free WARC/1.1 record; an archive is closed at ARCHIVE_BYTES.

Null html counts as an empty payload (and all empty payloads of at least min_bytes are equal); null urls are left out of the header. Rows that share page id and
payload are responses if that id is the smallest. Null page ids stand after all others and revisit only records with an id. An empty table
gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import new_path, small_or_shuffled, staged, store_of

CHUNK, ARCHIVE_BYTES = 65_536, 8_000_000
_URN = "urn:x-page:"


def payload(html_col: str) -> Column:
    return F.coalesce(F.col(html_col), F.lit("")).cast("binary")


def first_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """digest (hex SHA-1), n_bytes, check and first_id of payloads that two rows or more share."""
    body = payload(html_col)
    told = pages.select(F.col(id_col).alias("page_id"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("n_bytes"), F.xxhash64(body).alias("check")).where(F.col("n_bytes") >= min_bytes)
    return told.groupBy("digest", "n_bytes", "check").agg(F.min("page_id").alias("first_id"), F.count("*").alias("rows")).where("rows > 1 AND first_id IS NOT NULL").drop("rows")


def chunk_table(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """page_id, url, n_bytes, digest, refers_to, chunk_no and data: a row per chunk, in order within its task; revisits have one row without data."""
    groups = staged(first_records(pages, id_col, html_col, min_bytes), "first-records")
    body = F.col("body")
    told = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload(html_col).alias("body")).select("page_id", "url", "body", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("n_bytes"), F.xxhash64(body).alias("check"))
    linked = told.join(small_or_shuffled(groups, groups.count()), ["digest", "n_bytes", "check"], "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    chunks = F.when(F.col("refers_to").isNotNull(), F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk))).cast("int")
    rows = linked.withColumn("chunks", chunks).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select("page_id", "url", "n_bytes", "digest", "refers_to", "chunks", "chunk_no", F.when(F.col("refers_to").isNull(), F.substring(body, F.col("chunk_no") * chunk + 1, F.lit(chunk))).alias("data"))


def base32_of(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _header(kind: str, page_id: int | None, url: str | None, digest: str, n_bytes: int, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    length = len(http) + (n_bytes if refers_to is None else 0)
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n_bytes}", "Content-Type: application/http;msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(table: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Write a chunk table as archives; returns the folder and the committed manifest: file, records, bytes."""
    folder = folder or new_path(table.sparkSession, "warc")

    def run(batches):
        from pyspark import TaskContext

        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        part, name, out, size, records, sha = TaskContext.get().partitionId(), "", None, 0, 0, None

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"file": name, "records": records, "bytes": size}], schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            columns = [batch.column(i) for i in range(8)]
            for page_id, url, n_bytes, digest, refers_to, chunks, chunk_no, data in zip(*(c.to_pylist() for c in columns[:7]), columns[7], strict=True):
                if chunk_no == 0:
                    if out is not None and size >= archive_bytes:
                        yield closed()
                        out = None
                    if out is None:
                        name, size, records = f"pages-{part:06d}-{uuid.uuid4().hex}.warc", 0, 0
                        out = store.open_output_stream(f"{root}/{name}")
                    head = _header("response" if refers_to is None else "revisit", page_id, url, base32_of(digest), n_bytes, refers_to)
                    out.write(head)
                    size += len(head)
                    records += 1
                    sha = hashlib.sha1()
                if refers_to is None:
                    body = data.as_py() or b""
                    sha.update(body)
                    out.write(body)
                    size += len(body)
                if chunk_no == chunks - 1:
                    if refers_to is None and sha.hexdigest() != digest:
                        raise ValueError(f"record {page_id}: its chunks do not give its digest")
                    out.write(b"\r\n\r\n")
                    size += 4
        if out is not None:
            yield closed()

    return folder, staged(table.mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


def records_of(stream, chunk: int = CHUNK):
    """(headers, payload as an iterator of chunks) of each record of an archive read from a stream; a payload is to be read before the next record."""
    held = b""

    def until_blank_line() -> bytes | None:
        nonlocal held
        while (end := held.find(b"\r\n\r\n")) < 0:
            more = stream.read(chunk)
            if not more:
                return None
            held += more
        head, held = held[:end], held[end + 4 :]
        return head

    def payload_of(left: int):
        nonlocal held
        while left:
            if not held:
                held = stream.read(chunk)
                if not held:
                    raise ValueError("an archive ends inside a record")
            part, held = held[:left], held[left:]
            left -= len(part)
            yield part

    while (head := until_blank_line()) is not None:
        if not head.startswith(b"WARC/1.1\r\n"):
            raise ValueError("no record where one should begin")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        http = until_blank_line()
        body = payload_of(int(headers["Content-Length"]) - len(http) - 4)
        yield headers, body
        for _ in body:  # what has not been read
            pass
        if until_blank_line() != b"":
            raise ValueError("a record has no end")
    if held:
        raise ValueError("an archive ends inside a record")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the manifest's archives; digests are carried over chunks."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if not manifest.take(1):
        return spark.createDataFrame([], schema)
    names = manifest.select("file").repartition("file")

    def run(batches):
        store, root = store_of(folder)
        number = lambda urn: int(x) if (x := urn[1 + len(_URN) : -1]) else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for h, body in records_of(stream, chunk):
                        digest, n_bytes = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                        if h["WARC-Type"] == "response":
                            sha, n = hashlib.sha1(), 0
                            for part in body:
                                sha.update(part)
                                n += len(part)
                            if base64.b32encode(sha.digest()).decode() != digest or n != n_bytes:
                                raise ValueError(f"{h['WARC-Record-ID']}: the payload is not what its header says")
                        rows.append({"page_id": number(h["WARC-Record-ID"]), "payload_bytes": n_bytes, "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": number(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))

    return names.mapInArrow(run, schema)
