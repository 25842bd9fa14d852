"""WARC archives with an index of their records, and reads of selected records by byte range.

Every record is a gzip member of its own, so its offset and length in the file are enough to read it alone. A task
writes its records to a file of its own name and hands on one index row per record; the index is committed by Spark, so
a file of a lost or repeated attempt is in no index and is never read. Payloads are compared by digest: among equal
ones the record with the largest id holds the payload, the others are revisits of it.

Reading goes by the index: the selected records of a stretch of a file are sorted by offset, ranges with small gaps
between them become one read, and each record is checked against the digest it carries.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import HOT_PARTS, by_group
from evenkeel.staging import scratch_path, stage

#: Fixed value: the profile that marks a revisit by payload digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 0
FILE_BYTES = 1 << 30
STRETCH_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"
INDEX = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "file string, offset long, length long"
)
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A gzip member with a response record, or with a revisit record if ``refers_to`` is given.

    Both hold the HTTP header with the payload's length; only the response holds the payload. Characters that a header
    line can't hold are percent-encoded in the URL, and a null URL or id has no line.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}"]
    lines.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


_URL_SAFE = "".join(chr(c) for c in range(33, 127))
_PAGE = re.compile(r"<urn:page:(-?\d*)>")


def parse(member: bytes) -> dict:
    """The fields of a record and its payload (null for a revisit); a response's digest and length are verified."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    is_response = fields["WARC-Type"] == "response"
    if is_response and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    own = _PAGE.fullmatch(fields["WARC-Record-ID"])[1]
    other = _PAGE.fullmatch(fields["WARC-Refers-To"])[1] if "WARC-Refers-To" in fields else ""
    return {
        "page_id": int(own) if own else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(other) if other else None,
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if is_response else None,
    }


def _files(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def with_revisits(
    pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``(page_id, url, payload, refers_to)``: the largest id with the same payload, null where the row is that one.

    Payloads under ``min_bytes`` refer to nothing. A null id is less than any other; rows that tie for the largest are
    all responses. The few payloads that make up a visible part of the table are broadcast, the rest is joined by digest.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    )
    digest = F.when(F.length("payload") >= min_bytes, F.unhex(F.sha1("payload")))
    keyed = rows.withColumn("_digest", digest)
    seen = keyed.groupBy("_digest").agg(F.max("page_id").alias("_largest"), F.count(F.lit(1)).alias("_copies"))
    repeated = stage(seen.where(F.col("_digest").isNotNull() & (F.col("_copies") > 1)), "payloads")
    all_rows = pages.count()
    is_hot = F.col("_copies") * HOT_PARTS >= F.lit(all_rows)
    hot = repeated.where(is_hot).select("_digest", F.col("_largest").alias("_hot"), F.lit(True).alias("_is_hot")).limit(
        HOT_PARTS
    )
    cold = repeated.where(~is_hot).select(F.col("_digest").alias("_join"), F.col("_largest").alias("_cold"))
    # Rows that have found their payload, or have none to look for, get keys of their own, so that they spread.
    own = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")).cast("binary")
    marked = keyed.join(F.broadcast(hot), "_digest", "left")
    spread = marked.withColumn(
        "_join", F.when(F.col("_is_hot").isNull() & F.col("_digest").isNotNull(), F.col("_digest")).otherwise(own)
    )
    joined = spread.join(cold, "_join", "left").withColumn("_response", F.coalesce("_hot", "_cold"))
    older = F.col("_response").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("_response")))
    return joined.select("page_id", "url", "payload", F.when(older, F.col("_response")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Writes ``rows (page_id, url, payload, refers_to)`` as archives below ``folder``, and returns their index.

    ``folder`` is a URI that all executors share and that Arrow's file systems open (file, hdfs, s3, gs). The index is a
    written table with one row per record: its file, offset, length, URL and digest. Every task writes one file, and a
    further one when that has ``file_bytes``. No rows give an empty index and no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, path = _files(folder)
        system.create_dir(path, recursive=True)
        out, name, offset, number = None, "", 0, 0
        try:
            for batch in batches:
                index = []
                for i in range(batch.num_rows):
                    page_id, url, payload, refers_to = (batch.column(c)[i].as_py() for c in range(4))
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"part-{task.partitionId():06d}-{number:03d}-{task.taskAttemptId()}.warc.gz"
                        out, offset, number = system.open_output_stream(
                            f"{path}/{name}", compression=None
                        ), 0, number + 1
                    member = record(page_id, url, payload, refers_to, date)
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    index.append(
                        (
                            page_id,
                            url,
                            kind,
                            payload_digest(payload),
                            len(payload),
                            f"{folder}/{name}",
                            offset,
                            len(member),
                        )
                    )
                    offset += len(member)
                if index:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*index, strict=True), _INDEX_TYPES, strict=True)],
                        _INDEX_NAMES,
                    )
        finally:
            if out is not None:
                out.close()

    return stage(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, INDEX), "warc-index")


_INDEX_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_INDEX_TYPES = [{"long": pa.int64(), "string": pa.string()}[f.split()[1]] for f in INDEX.split(", ")]


def read_records(
    index: DataFrame, stretch_bytes: int = STRETCH_BYTES, gap_bytes: int = GAP_BYTES, payloads: bool = True
) -> DataFrame:
    """The records of the ``index`` rows given: ids, type, digest, length, URL, and payloads unless left out.

    Each stretch of a file is one group. Its records are read in the order of their offsets; those with at most
    ``gap_bytes`` between them come from one read. A record given twice is returned twice; an empty index gives no rows.
    The stretches set the number of tasks, not the size of the index, which says little of the bytes it points to.
    """

    def read(keys: tuple, group: pa.Table) -> pa.Table:
        system, path = _files(keys[0].as_py())
        wanted = sorted(zip(group.column("offset").to_pylist(), group.column("length").to_pylist(), strict=True))
        ranges: list[list[int]] = []
        for offset, length in wanted:
            if ranges and offset - ranges[-1][1] <= gap_bytes:
                ranges[-1][1] = max(ranges[-1][1], offset + length)
            else:
                ranges.append([offset, offset + length])
        found, at = [], 0
        with system.open_input_file(path) as archive:
            for begin, end in ranges:
                data = archive.read_at(end - begin, begin)
                while at < len(wanted) and wanted[at][0] < end:
                    offset, length = wanted[at]
                    fields = parse(data[offset - begin : offset - begin + length])
                    if not payloads:
                        fields["payload"] = None
                    found.append(fields)
                    at += 1
        return pa.Table.from_pylist(found, _RECORD_SCHEMA)

    stretch = F.floor(F.col("offset") / F.lit(stretch_bytes)).cast("long")
    places = index.select("file", stretch.alias("_stretch"), "offset", "length")
    stretches = places.agg(F.approx_count_distinct(F.struct("file", "_stretch"))).first()[0]
    return by_group(places, stretches, "file", "_stretch").groupBy("file", "_stretch").applyInArrow(read, RECORDS)


_RECORD_SCHEMA = pa.schema([
    (
        f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]
    ) for f in RECORDS.split(", ")
])


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Archives every page below ``folder`` (by default in the session's shared folder) and returns the index.

    Null html counts as empty; null ids and URLs are kept; repeated rows give a record each; extra columns are left out.
    """
    return write_archives(with_revisits(pages, min_bytes), folder or scratch_path(pages.sparkSession, "warc"))
