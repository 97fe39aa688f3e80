"""WARC archives as chunked records.

Writing: pages become rows of (record, chunk number, bytes), so that a payload
never has to be in memory as a whole beside its row; tasks stream the chunks of
their records into gzip members of an archive file each. Of equal payloads the
one with the smallest id is written as ``response``, the others as ``revisit``
records that name it.

Reading: archives are read front to back in small blocks and come out as rows of
(record, chunk number, bytes) again, with the length and the SHA-256 of the
payload so far. The row of the last chunk holds those of the whole payload.

Archives lie in the folder that all executors share. Their names carry the task
attempt, and the manifest that Spark commits names the archives of successful
attempts, so a repeated task leaves no doubt about what belongs to the result.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import text_of
from tidewake.session import materialize, shared_dir

CHUNK = 1 << 20
MANIFEST = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType())])


def _open(path: str):
    """File system and path of a place such as ``file:/x``, ``hdfs://h/x`` or ``s3://b/x``."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def classified(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int) -> DataFrame:
    """Pages with payload length, digest, record type and the id that a revisit refers to.

    Rows that share both payload and smallest id are all responses. Null ids are
    larger than any other; payloads that only null ids have are all responses.
    """
    payload = text_of(payload_col)
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("bytes"), F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    firsts = rows.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("d"), "first")
    joined = rows.join(firsts, (F.col("digest") == F.col("d")) & (F.col("bytes") >= min_revisit), "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return joined.select(
        "id", "url", "bytes", "digest", F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, F.col("first")).alias("refers_to"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record_chunks(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(record, chunk number, bytes) rows; a record without payload has one empty chunk, in the order of writing."""
    count = F.greatest(F.ceil(F.octet_length("payload") / F.lit(chunk)), F.lit(1))
    numbered = records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)).cast("int") - 1)))
    piece = F.substring(F.coalesce("payload", F.lit("")).cast("binary"), F.col("chunk_no") * chunk + 1, F.lit(chunk))
    return numbered.select("id", "url", "bytes", "digest", "type", "refers_to", "chunk_no", piece.alias("data"))


def _header(row: dict) -> bytes:
    """Head of a record; a line of its own names the page id."""
    def record_id(key) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, str(key))}>"

    url = "".join(c for c in row["url"] or "" if c > " ") or "about:blank"
    lines = [
        "WARC/1.1", f"WARC-Type: {row['type']}", f"WARC-Record-ID: {record_id(row['id'])}", f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{row['digest']}", "Content-Type: text/html; charset=utf-8",
        f"X-Payload-Length: {row['bytes']}", f"Content-Length: {0 if row['type'] == 'revisit' else row['bytes']}",
    ]
    if row["id"] is not None:
        lines.append(f"X-Page-Id: {row['id']}")
    if row["type"] == "revisit":
        lines.append(f"WARC-Refers-To: {record_id(row['refers_to'])}")
        lines.append(f"X-Refers-To-Page-Id: {row['refers_to']}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write_archives(records: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """Stream records into archives under ``folder``, one per task; returns the stored manifest."""
    def run(batches):
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        files, path = _open(name)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        records, member = 0, None
        with files.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                    if row["chunk_no"] == 0:
                        if member is not None:
                            member.write(b"\r\n\r\n")
                            member.close()
                        member = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=3, mtime=0)
                        member.write(_header(row))
                        records += 1
                    member.write(row["data"])
            if member is not None:
                member.write(b"\r\n\r\n")
                member.close()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=MANIFEST.names)

    manifest = record_chunks(records, chunk).mapInArrow(run, MANIFEST)
    return materialize(manifest, "warc-manifest")


class _Reader:
    """Reads an archive in blocks, whatever the size of its records."""

    def __init__(self, raw):
        self.stream, self.buffer = gzip.GzipFile(fileobj=raw, mode="rb"), b""

    def line(self) -> bytes | None:
        while (end := self.buffer.find(b"\r\n")) < 0:
            more = self.stream.read(1 << 16)
            if not more:
                return None
            self.buffer += more
        line, self.buffer = self.buffer[:end], self.buffer[end + 2:]
        return line

    def chunks(self, length: int, chunk: int):
        while length:
            size = min(length, chunk)
            while len(self.buffer) < size:
                more = self.stream.read(max(1 << 16, size - len(self.buffer)))
                if not more:
                    raise EOFError("archive ends inside a record")
                self.buffer += more
            piece, self.buffer = self.buffer[:size], self.buffer[size:]
            length -= size
            yield piece


def _records(raw, chunk: int):
    """(head fields, chunk number, bytes, length so far, digest so far, last) of an archive."""
    reader = _Reader(raw)
    while (first := reader.line()) is not None:
        if not first:
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError("not at the head of a record")
        head = {}
        while line := reader.line():
            name, _, value = line.decode().partition(": ")
            head[name] = value
        total, seen, digest = int(head["Content-Length"]), 0, hashlib.sha256()
        if not total:
            yield head, 0, b"", 0, digest.hexdigest(), True
        for number, piece in enumerate(reader.chunks(total, chunk)):
            seen += len(piece)
            digest.update(piece)
            yield head, number, piece, seen, digest.hexdigest(), seen == total


def read_archives(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of the archives that the manifest names.

    Columns: ``record_id``, ``page_id`` (text), ``url``, ``record_type``,
    ``refers_to`` (text), ``stated_bytes`` and ``stated_digest`` (from the head),
    ``chunk_no``, ``data``, ``bytes_so_far``, ``digest_so_far``, ``last``.
    """
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in ("record_id", "page_id", "url", "record_type", "refers_to")],
        T.StructField("stated_bytes", T.LongType()), T.StructField("stated_digest", T.StringType()),
        T.StructField("chunk_no", T.LongType()), T.StructField("data", T.BinaryType()),
        T.StructField("bytes_so_far", T.LongType()), T.StructField("digest_so_far", T.StringType()), T.StructField("last", T.BooleanType()),
    ])

    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()])],
                names=schema.names)

        for names in batches:
            for name in names.column("archive").to_pylist():
                files, path = _open(name)
                rows, held = [], 0
                with files.open_input_stream(path, compression=None, buffer_size=1 << 16) as raw:
                    for head, number, piece, seen, digest, last in _records(raw, chunk):
                        rows.append((
                            head["WARC-Record-ID"], head.get("X-Page-Id"), head["WARC-Target-URI"], head["WARC-Type"], head.get("X-Refers-To-Page-Id"),
                            int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:"), number, piece, seen, digest, last,
                        ))
                        held += len(piece) + 200
                        if held > 2 * chunk:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    # An archive is read by one task: deal the names out evenly.
    named = manifest.where("records > 0").select("archive")
    return named.repartition(max(1, named.sparkSession.sparkContext.defaultParallelism), "archive").mapInArrow(run, schema)


def archive_round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit: int = 100, chunk: int = CHUNK, folder: str | None = None,
) -> DataFrame:
    """Write ``pages`` as archives and return what reading them back gives, one row per record.

    Columns: id, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``. Responses have length and digest of the payload as read;
    revisits, which carry no payload, those stated in their heads. A null
    payload is empty; every row becomes a record, so repeated rows are repeated;
    other columns are ignored; an empty table gives no rows.
    """
    spark: SparkSession = pages.sparkSession
    id_type = pages.schema[id_col].dataType
    records = classified(pages, id_col, url_col, payload_col, min_revisit)
    manifest = write_archives(records, folder or shared_dir(spark, "warc"), chunk)
    last = read_archives(manifest, chunk).where("last")
    read = F.col("record_type") == "response"
    return last.select(
        F.col("page_id").cast(id_type).alias(id_col),
        F.when(read, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(read, F.col("digest_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast(id_type).alias("refers_to"),
    )


QUERY_SQL = r"""
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM f
"""
