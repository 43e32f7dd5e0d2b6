"""WARC archives: index first, then coalesced byte-range reads.

Writing. Equal payloads of at least ``LEAST_BYTES`` bytes are stored once: the row with
the smallest id is the response, the others are revisits that carry headers only. The
digest table is aggregated before it is joined, and only digests that occur more than
once take part. Every task writes one archive (a gzip member a record, written through
the file system of the shared folder) and returns an index row a record: file, offset,
length, URL and digest. Names are new at each attempt and only indexed ones are read.

Reading. Selected index rows are put in order of (file, offset) and neighbouring byte
ranges are merged if at most ``GAP`` bytes lie between them, up to ``RANGE_BYTES``; each
range is one read.

Edge cases. A null html is an empty payload. Repeated ids with equal payloads are all
written; the first one met by (id, url) order of the digest table decides who the
response is: every row whose id equals the smallest id is a response. Null URLs are
written as an empty target. Empty tables give an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import materialize, open_fs, scratch

LEAST_BYTES = 100
GAP, RANGE_BYTES = 64 * 1024, 8 << 20
#: Bytes of payload that one archive is meant to hold before compression.
ARCHIVE_BYTES = 64 << 20
_INDEX = "id long, url string, record_type string, refers_to long, payload_bytes long, digest string, file string, offset long, length long"


def record(kind: str, url: str, number: int | None, digest: str, payload: bytes, size: int, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record, uncompressed; line breaks in a URL are percent-encoded."""
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{number} {url}')}>",
        f"WARC-Target-URI: {url}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Row-Id: {'' if number is None else number}", f"X-Payload-Bytes: {size}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Row-Id: {refers_to}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, payload, payload_bytes, digest, record_type, refers_to for every row."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    digest = F.sha2("payload", 256)
    # ids and digests only: the payloads stay where they are until the digests that repeat are known
    keys = rows.where(F.length("payload") >= LEAST_BYTES).select("id", digest.alias("digest"))
    repeated = materialize(
        keys.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("__d"), "first"), "repeated"
    )
    rows = rows.select("id", "url", "payload", F.length("payload").cast("long").alias("payload_bytes"), digest.alias("digest"))
    joined = rows.join(repeated, rows.digest == repeated["__d"], "left").drop("__d")
    revisit = F.col("first").isNotNull() & (F.col("payload_bytes") >= LEAST_BYTES) & (F.col("first") != F.col("id"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("first"))).drop("first")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", uri: str | None = None, date: datetime | None = None) -> DataFrame:
    """Write a record a row; the index of all records."""
    spark = pages.sparkSession
    uri = uri or scratch(spark, "warc")
    when = (date or datetime(2000, 1, 1, tzinfo=timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    typed = with_types(pages, id_col, url_col, html_col)
    columns = ["id", "url", "record_type", "refers_to", "payload_bytes", "digest", "payload"]
    # a revisit's payload is not stored, so it isn't handed over either
    source = typed.withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload"))).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, offset = None, 0, 0
        for batch in batches:
            rows = []
            for number, url, kind, first, size, digest, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{uri}/{uuid.uuid4().hex}.warc.gz"
                    filesystem, path = open_fs(name)
                    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
                    out, held, offset = filesystem.open_output_stream(path, compression=None), 0, 0
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = press.compress(record(kind, url, number, digest, payload or b"", size, first, when)) + press.flush()
                out.write(data)
                rows.append((number, url, kind, first, size, digest, name, offset, len(data)))
                offset, held = offset + len(data), held + size
                if held >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if rows:
                a = list(zip(*rows))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(a, kinds)], names=["id", "url", "record_type", "refers_to", "payload_bytes", "digest", "file", "offset", "length"])
        if out is not None:
            out.close()

    return materialize(source.mapInArrow(run, _INDEX), "warc-index")


def _ranges(places: list[tuple[str, int, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int, int]]]]:
    """Merge sorted (file, offset, length, key) into (file, start, end, members)."""
    file, start, end, members = None, 0, 0, []
    for f, offset, length, key in places:
        if f == file and offset - end <= GAP and offset + length - start <= RANGE_BYTES:
            end = max(end, offset + length)
        else:
            if members:
                yield file, start, end, members
            file, start, end, members = f, offset, offset + length, []
        members.append((offset, length, key))
    if members:
        yield file, start, end, members


def read_records(spark: SparkSession, index: DataFrame) -> DataFrame:
    """id, url, record_type, refers_to, payload_bytes, payload_digest, payload, payload_ok of the records that ``index`` selects.

    A revisit's payload is null: it is its response's. ``payload_ok``: the stored payload has the digest of its header.
    """
    ordered = index.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns), range(len(batch))))
            for file, start, end, members in _ranges(places):
                filesystem, path = open_fs(file)
                with filesystem.open_input_file(path) as f:
                    block = f.read_at(end - start, start)
                rows = []
                for offset, length, _ in members:
                    headers, payload = parse(zlib.decompress(block[offset - start : offset - start + length], 31))
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    first, stored = headers.get("X-Refers-To-Row-Id"), kind != "revisit"
                    number = headers["X-Row-Id"]
                    rows.append((
                        int(number) if number else None, headers["WARC-Target-URI"], kind, int(first) if first else None,
                        len(payload) if stored else int(headers["X-Payload-Bytes"]), hashlib.sha256(payload).hexdigest() if stored else digest,
                        payload if stored else None, not stored or hashlib.sha256(payload).hexdigest() == digest,
                    ))
                a = list(zip(*rows))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(a, kinds)], names=["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "payload_ok"])

    return ordered.mapInArrow(run, "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, payload_ok boolean")

