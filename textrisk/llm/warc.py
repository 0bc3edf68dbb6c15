"""WARC archives of pages, read back through an index of their records.

Writing a partition appends one compressed member per record to an archive of its own and
yields an index row: archive, offset, length, URL and digest. Only archives named by the
index, which Spark commits as a table, count; what a lost task left behind is in no index row.

Reading sorts the selected index rows by archive and offset, joins ranges that lie next to
each other into one read, and cuts the records out of it.

Archives are written and read by the tasks through ``pyarrow.fs``, so the folder may be on any
store that it reaches by URI (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.llm.words import small_batches
from textrisk.session import staged

#: An archive is closed after the batch of rows with which it reaches this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Ranges of at most this distance are read together, up to this many bytes.
READ_GAP = 64 << 10
#: Compressed bytes of a reading task: about, and at least while there are cores without work.
TASK_BYTES = 64 << 20
LEAST_TASK_BYTES = 1 << 20
READ_BYTES = 8 << 20

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"

INDEX = (
    "page_id bigint, url string, archive string, offset bigint, length bigint, digest string, "
    "record_type string"
)
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open_store(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder)


def _one_line(value: str) -> str:
    """Control characters of a header value as percent codes."""
    return "".join(c if c.isprintable() or ord(c) > 159 else f"%{ord(c):02X}" for c in value)


def encode_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record, not compressed. A revisit carries no payload, but its length and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """The fields of ``RECORD``. A payload that does not have its digest raises an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("no record begins here")
    header = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(header["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = header["WARC-Type"]
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"damaged payload of page {header.get('Page-ID')}")
    number = {k: int(header[k]) if k in header else None for k in ("Page-ID", "Refers-To-Page-ID")}
    return {
        "page_id": number["Page-ID"],
        "url": header.get("WARC-Target-URI"),
        "record_type": kind,
        "refers_to": number["Refers-To-Page-ID"],
        "payload_bytes": len(payload) if kind == "response" else int(declared["Content-Length"]),
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _write_rows(batches, folder: str, archive_bytes: int, schema: pa.Schema):
    """Input columns: page_id, url, html, refers_to. The index rows of an archive are handed
    on when it is closed."""
    store, root = _open_store(folder)
    name, stream, offset, index = None, None, 0, []
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if stream is None:
                name = f"{uuid.uuid4().hex}.warc.gz"
                store.create_dir(root, recursive=True)
                stream, offset = store.open_output_stream(f"{root}/{name}", compression=None), 0
            payload = (row["html"] or "").encode()
            digest = payload_digest(payload)
            record = encode_record(row["page_id"], row["url"], payload, digest, row["refers_to"])
            member = gzip.compress(record, 3, mtime=0)
            stream.write(member)
            kind = "response" if row["refers_to"] is None else "revisit"
            rows.append(
                {"page_id": row["page_id"], "url": row["url"], "archive": name, "offset": offset,
                 "length": len(member), "digest": digest, "record_type": kind}
            )
            offset += len(member)
        index.append(pa.RecordBatch.from_pylist(rows, schema=schema))
        if offset >= archive_bytes:
            stream.close()
            yield from index
            stream, index, offset = None, [], 0
    if stream is not None:
        stream.close()
    yield from index


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def write_archives(
    pages: DataFrame, folder: str, least_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``) below ``folder``.
    Returns the index, staged.

    Of pages with equal payloads of at least ``least_revisit`` bytes, those with the smallest
    ``page_id`` are responses, the others revisits of it. Null ``html`` is an empty payload. A
    row without ``page_id`` is always a response. Repeated rows give repeated records. Further
    columns are ignored.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    digests = rows.where(
        F.col("page_id").isNotNull() & (F.octet_length("html") >= least_revisit)
    ).select("page_id", F.sha1(F.col("html").cast("binary")).alias("hash"))
    firsts = digests.groupBy("hash").agg(
        F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")
    )
    revisits = (
        digests.join(firsts.where("refers_to <> last").drop("last"), "hash")
        .where("page_id <> refers_to")
        .select("page_id", "hash", "refers_to")
        .distinct()
    )
    # A page_id may come with several payloads, so the payload is part of the key.
    keyed = rows.withColumn("hash", F.sha1(F.col("html").cast("binary")))
    marked = keyed.join(revisits, ["page_id", "hash"], "left").drop("hash")
    schema = _arrow_schema(pages.sparkSession, INDEX)
    return staged(
        marked.mapInArrow(
            lambda batches: _write_rows(batches, folder, archive_bytes, schema), INDEX
        )
    )


def _read_rows(batches, folder: str, schema: pa.Schema):
    """Input columns: archive, offset, length; sorted."""
    store, root = _open_store(folder)
    name, stream = None, None
    for batch in batches:
        archives, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
        begin = 0
        while begin < len(archives):
            stop, end = begin + 1, offsets[begin] + lengths[begin]
            while (
                stop < len(archives)
                and archives[stop] == archives[begin]
                and offsets[stop] - end <= READ_GAP
                and offsets[stop] + lengths[stop] - offsets[begin] <= READ_BYTES
            ):
                end = max(end, offsets[stop] + lengths[stop])
                stop += 1
            if archives[begin] != name:
                if stream is not None:
                    stream.close()
                name = archives[begin]
                stream = store.open_input_file(f"{root}/{name}")
            data = stream.read_at(end - offsets[begin], offsets[begin])
            records = []
            for i in range(begin, stop):
                at = offsets[i] - offsets[begin]
                records.append(decode_record(gzip.decompress(data[at : at + lengths[i]])))
            yield pa.RecordBatch.from_pylist(records, schema=schema)
            begin = stop
    if stream is not None:
        stream.close()


def read_records(
    selected: DataFrame, folder: str, range_bytes: int = 64 << 20, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """The records that the index rows ``selected`` name, by sorted and joined range reads.

    Ranges of one archive are dealt into stretches of ``range_bytes``, so a large archive is
    read by many tasks and each stretch is read forwards. A task reads about ``task_bytes``.
    """
    schema = _arrow_schema(selected.sparkSession, RECORD)
    places = selected.select("archive", "offset", "length").withColumn(
        "stretch", F.floor(F.col("offset") / range_bytes)
    )
    # By bytes to read, with a number: the rows themselves are too narrow to be dealt by their size.
    wanted = places.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    cores = selected.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-wanted // task_bytes), min(cores, -(-wanted // LEAST_TASK_BYTES)), 1)
    dealt = places.repartition(tasks, "archive", "stretch").sortWithinPartitions("archive", "offset")
    return dealt.drop("stretch").mapInArrow(
        lambda batches: _read_rows(batches, folder, schema), RECORD
    )
