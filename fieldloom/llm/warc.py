"""WARC archives: write with an index, then read records back by coalesced byte ranges.

Method: each task writes archives of its own (one gzip member a record) to the shared folder and
returns, per record, file, offset, length, URL and digest; these rows are the index, a Parquet
table. A reader selects from the index, range-partitions what it wants by file and offset, joins
neighbouring ranges (gaps up to ``GAP`` bytes) into one read of at most ``READ`` bytes, and unpacks
the members it asked for. A retried or speculative task writes files of other names, and only the
attempt that Spark accepts is in the index.

Records with equal payloads are found by digest before writing: partial maxima per digest give the
page that keeps the payload (the largest id); the others become revisits that point to it. Payloads
travel once, dealt by digest; pages of a digest with more than ``HOT_ROWS`` pages are dealt over
several tasks, and only that digest's one row is repeated.

Results in odd cases: null html is an empty payload; with a null url the record has no target;
line breaks in a url are written percent-encoded; records of one page id and payload (repeated
rows) are all responses if the id is the largest; payloads under ``min_bytes`` are always responses;
a null page id is written as ``null`` and read as null; an empty table gives no archive and no rows;
extra columns are not read; payloads of any length are written whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, own_folder, read, ship
from fieldloom.operators.skew import skew_join

#: Bytes of an archive before the task starts another; of the largest gap and the longest read.
ARCHIVE, GAP, READ = 1 << 30, 1 << 16, 1 << 23
#: Pages of one digest that a task takes.
HOT_ROWS = 1000
_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
_INDEX = "file string, offset long, length long, url string, digest string"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def sha1_base32(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column: five hex digits make four of base32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), *_BASE32)


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", sha1_base32(F.col("payload")))
    counted = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    shared = cut(counted.where("n > 1").select(F.col("digest").alias("of"), "kept", "n"))
    joined = skew_join(rows, shared.select("of", "kept"), [("digest", "of")], "left", HOT_ROWS, keys_from=shared.select(F.col("of").alias("digest"), "n"), rows="n")
    other = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id")) & (F.octet_length("payload") >= min_bytes)
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("kept")).alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _name(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes, int]:
    """(header fields, payload in the record, length of the full payload) of a gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, payload, int(http.rpartition(b"Content-Length: ")[2])


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write what ``decide`` gives below ``folder``; the index, reread from its table there."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out = name = None
        at = 0
        try:
            for batch in batches:
                index: list[tuple] = []
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= ARCHIVE:
                        if out is not None:
                            out.close()
                        name, at = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    member = record(page_id, url, payload, digest, refers_to)
                    out.write(member)
                    index.append((name, at, len(member), url, digest))
                    at += len(member)
                if index:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*index, strict=True), kinds, strict=True)], names=["file", "offset", "length", "url", "digest"]
                    )
        finally:
            if out is not None:
                out.close()

    rows.mapInArrow(run, _INDEX).write.parquet(f"{folder}/index")
    return rows.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


def coalesced(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, ranges in it) of the reads that cover sorted (offset, length) ranges."""
    held: list[tuple[int, int]] = []
    end = 0
    for offset, length in ranges:
        if held and (offset - end > GAP or offset + length - held[0][0] > READ):
            yield held[0][0], end, held
            held = []
        held.append((offset, length))
        end = offset + length
    if held:
        yield held[0][0], end, held


def _page(name: str | None) -> int | None:
    return None if name is None or name.endswith(":null>") else int(name[10:-1])


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the index rows. Digests of responses are computed anew and checked."""
    ship(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            files = batch.column(0).to_pylist()
            places = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            at = 0
            while at < len(files):
                stop = at
                while stop < len(files) and files[stop] == files[at]:
                    stop += 1
                with system.open_input_file(f"{root}/{files[at]}") as source:
                    for start, end, ranges in coalesced(places[at:stop]):
                        data = source.read_at(end - start, start)
                        yield _records(data[o - start : o - start + n] for o, n in ranges)
                at = stop

    def _records(members: Iterator[bytes]) -> pa.RecordBatch:
        rows = []
        for member in members:
            fields, payload, full = parse(member)
            kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
            rows.append((_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, _page(fields.get("WARC-Refers-To")), full, digest, payload if payloads and kind == "response" else None))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    wanted = index.select("file", "offset", "length")
    count = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartitionByRange(count, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, _RECORD)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to."""
    folder = own_folder(spark, "warc")
    index = write_archives(decide(read(spark, sf_dir, "pages")), folder)
    found = read_records(index, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_DIGEST = " || ".join(
    f"substr('{_BASE32[1]}', CAST(('0x' || substr(h, {k}, 5)) AS BIGINT) // {32**p} % 32 + 1, 1)" for k in range(1, 41, 5) for p in (3, 2, 1, 0)
)
OP7_SQL = f"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
kept AS (SELECT h, max(page_id) AS kept FROM hashed GROUP BY h)
SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM hashed JOIN kept USING (h)
"""
