"""WARC archives over a chunked record table.

A payload is never handled whole: it becomes rows (record, chunk number, chunk), with a
SHA-1 carried from chunk to chunk.  Each chunk is written as one WARC record: payloads of
several chunks use the format's segmentation (`WARC-Segment-Number`, `continuation`
records).  Spark's text writer lays the records down, so any file system it knows will
do.  Reading streams each archive through the decompressor record by record; segments of
one payload are put in order by Spark, and again the digest is carried along.

Of records with equal payloads of at least `min_bytes` bytes, the one with the largest
page_id is the response and the others are revisits of it, without payload.

Defined results: null html is an empty payload; a null page_id is smaller than any
other; when the largest page_id occurs more than once with the same payload, one of these
rows is the response; a null URL has no target header; line breaks in URLs are
percent-encoded; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.llm.common import Workspace

CHUNK_CHARS = 1 << 18
FLUSH_BYTES = 4 << 20
CHUNKS = "record_id bigint, chunk int, n_chunks int, page_id bigint, url string, value string, n_bytes bigint, digest string"
RECORDS = "record_id bigint, page_id bigint, kind string, segment int, n_bytes bigint, digest string, refers_to bigint, data binary"


def base32_sha1(h) -> str:
    return base64.b32encode(h.digest()).decode()


def chunk_table(pages: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Rows of chunks from 1 on, and after them a row 0 with length and digest of the payload."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.int64()), ("chunk", pa.int32()), ("n_chunks", pa.int32()), ("page_id", pa.int64()),
            ("url", pa.string()), ("value", pa.string()), ("n_bytes", pa.int64()), ("digest", pa.string())])
        record, held, rows = TaskContext.get().partitionId() << 40, 0, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html = batch[0][i].as_py(), batch[1][i].as_py(), batch[2][i].as_py() or ""
                sha, n_bytes, n = hashlib.sha1(), 0, 0
                for n, at in enumerate(range(0, len(html), chunk_chars), 1):
                    piece = html[at : at + chunk_chars]
                    data = piece.encode()
                    sha.update(data)
                    n_bytes += len(data)
                    held += len(data)
                    rows.append((record, n, None, page, None, piece, len(data), None))
                    if held >= FLUSH_BYTES:
                        yield out()
                        held, rows = 0, []
                rows.append((record, 0, n, page, url, None, n_bytes, base32_sha1(sha)))
                record += 1
        if rows:
            yield out()

    return pages.select("page_id", "url", "html").mapInArrow(chunks, CHUNKS)


def record_types(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Response or revisit for each record; heads: record_id, page_id, n_bytes, digest."""
    first = heads.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.max(F.struct("page_id", "record_id")).alias("first"))
    again = (F.col("n_bytes") >= min_bytes) & (F.col("first.record_id") != F.col("record_id"))
    return heads.join(first, "digest", "left").withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"),
        "refers_to": F.when(again, F.col("first.page_id")), "refers_record": F.when(again, F.col("first.record_id")),
    }).drop("first")


def write_archives(pages: DataFrame, path: str, work: Workspace, min_bytes: int = 0, chunk_chars: int = CHUNK_CHARS) -> None:
    """Write every page as WARC records into gzip files below `path`."""
    table = work.store(chunk_table(pages, chunk_chars), "chunks")
    heads = work.store(record_types(table.where("chunk = 0").drop("chunk", "value"), min_bytes), "heads")
    bodies = table.where("chunk > 0").select("record_id", "chunk", "value", F.col("n_bytes").alias("chunk_bytes"))
    kept = heads.where("record_type = 'response'").join(bodies, "record_id", "left")
    empty = heads.where("record_type = 'revisit'").select(
        *heads.columns, F.lit(None).cast("int").alias("chunk"), F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("bigint").alias("chunk_bytes"))
    lines = kept.select(empty.columns).unionByName(empty).select(_record().alias("value"))
    # the writer ends each row with CR LF, which closes the record
    lines.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def _urn(page: Column, record: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), record.cast("string"), F.lit(">"))


def _record() -> Column:
    """Header block, empty line, payload and line end of one record."""
    col = F.col
    later = col("chunk") > 1
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"))
    url = F.replace(F.replace(col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    own = _urn(col("page_id"), col("record_id"))
    header = F.array_compact(F.array(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(later, "continuation").otherwise(col("record_type"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        line("WARC-Record-ID", F.when(later, F.concat(F.rtrim(own, F.lit(">")), F.lit(":"), col("chunk").cast("string"), F.lit(">"))).otherwise(own)),
        F.when(~F.coalesce(later, F.lit(False)), line("WARC-Target-URI", url)),
        F.when(later, line("WARC-Segment-Origin-ID", own)),
        F.when(col("n_chunks") > 1, line("WARC-Segment-Number", col("chunk"))),
        F.when((col("n_chunks") > 1) & (col("chunk") == col("n_chunks")), line("WARC-Segment-Total-Length", col("n_bytes"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), col("digest"))),
        F.when(col("record_type") == "revisit", line("WARC-Refers-To", _urn(col("refers_to"), col("refers_record")))),
        F.when(col("record_type") == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(col("record_type") == "revisit", line("X-Payload-Length", col("n_bytes"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        line("Content-Length", F.coalesce("chunk_bytes", F.lit(0)))))
    return F.concat(F.array_join(header, "\r\n"), F.lit("\r\n\r\n"), F.coalesce("value", F.lit("")), F.lit("\r\n"))


class _Stream:
    """Bytes of a gzip archive, decompressed as they are asked for."""

    def __init__(self, data) -> None:
        self.data, self.at, self.left, self.zip = data, 0, b"", zlib.decompressobj(31)

    def more(self) -> bool:
        if self.zip.eof:
            rest = self.zip.unused_data
            self.zip, tail = zlib.decompressobj(31), rest
        else:
            tail = self.zip.unconsumed_tail
        if not tail and self.at < len(self.data):
            tail = bytes(self.data[self.at : self.at + (1 << 16)])
            self.at += 1 << 16
        if not tail:
            return False
        self.left += self.zip.decompress(tail, 1 << 20)
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (k := self.left.find(mark)) < 0:
            if not self.more():
                return None
        out, self.left = self.left[:k], self.left[k + len(mark) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.left and not self.more():
                raise EOFError("archive ends inside a record")
            part, self.left = self.left[:n], self.left[n:]
            n -= len(part)
            yield part


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record; data holds the payload of segmented records only."""
    schema = pa.schema([
        ("record_id", pa.int64()), ("page_id", pa.int64()), ("kind", pa.string()), ("segment", pa.int32()),
        ("n_bytes", pa.int64()), ("digest", pa.string()), ("refers_to", pa.int64()), ("data", pa.binary())])

    def page_of(urn: str) -> int | None:
        page = urn.split(":")[2]
        return None if page == "null" else int(page)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                stream = _Stream(memoryview(batch[0][i].as_buffer()))
                while (block := stream.until(b"\r\n\r\n")) is not None:
                    head = dict(x.split(": ", 1) for x in block.decode().split("\r\n")[1:])
                    sha, data, n = hashlib.sha1(), [], 0
                    segmented = "WARC-Segment-Number" in head
                    for part in stream.take(int(head["Content-Length"])):
                        n += len(part)
                        sha.update(part)
                        if segmented:
                            data.append(part)
                    stream.until(b"\r\n\r\n")
                    urn, kind = head["WARC-Record-ID"].strip("<>"), head["WARC-Type"]
                    digest = base32_sha1(sha)
                    if kind == "revisit":
                        n, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:]
                    elif not segmented and digest != head["WARC-Payload-Digest"][5:]:
                        raise ValueError(f"{urn}: payload does not fit its digest")
                    rows.append((
                        int(urn.split(":")[3]), page_of(urn), kind, int(head.get("WARC-Segment-Number", 0)), n, digest,
                        page_of(head["WARC-Refers-To"].strip("<>")) if kind == "revisit" else None,
                        b"".join(data) if segmented else None))
                    held += n if segmented else 200
                    if held >= FLUSH_BYTES:
                        yield out()
                        rows, held = [], 0
        if rows:
            yield out()

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, RECORDS)


def read_archives(spark: SparkSession, path: str, work: Workspace) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page in the archives."""
    records = work.store(read_records(spark, path), "records")
    whole = records.where("segment = 0").select("page_id", "n_bytes", "digest", F.col("kind").alias("record_type"), "refers_to")

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments come in order; the digest goes from one to the next."""
        now, sha, n, page = None, None, 0, None
        done = []
        for batch in batches:
            for i in range(batch.num_rows):
                record, data = batch[0][i].as_py(), memoryview(batch[2][i].as_buffer())
                if record != now:
                    if now is not None:
                        done.append((page, n, base32_sha1(sha)))
                    now, sha, n, page = record, hashlib.sha1(), 0, batch[1][i].as_py()
                sha.update(data)
                n += len(data)
        if now is not None:
            done.append((page, n, base32_sha1(sha)))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))],
                names=["page_id", "n_bytes", "digest"])

    joined = (
        records.where("segment > 0").select("record_id", "page_id", "data", "segment").repartition("record_id")
        .sortWithinPartitions("record_id", "segment").select("record_id", "page_id", "data")
        .mapInArrow(carried, "page_id bigint, n_bytes bigint, digest string")
        .select("page_id", "n_bytes", "digest", F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to")))
    return whole.unionByName(joined).withColumnsRenamed({"n_bytes": "payload_bytes", "digest": "payload_digest"})
