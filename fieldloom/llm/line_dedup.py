"""Line dedup: repeated lines stay only in the first document that holds them.

Method: every line that is long enough becomes a narrow row (128-bit hash of its key,
document, position). The rows are range-partitioned by hash, then document, then position,
and sorted within partitions, so that a line found in a third of all documents is spread over
many partitions. The sorted rows are written once; from each partition only its first and last
hash with their first document are fetched (two records a partition), which tells each later
partition whether its first hash began before it. Then each partition streams its rows once and
reports the rows that are not of the hash's first document. These positions become one
compressed keep bitmap per document (bit i: line i stays; zlib over packed bits). A hash of the
text travels beside the id, so that a bitmap is of one text only. To apply the bitmaps, texts of
documents that lose lines (and few others, by a filter on ids) are shuffled to them; all others stay
where they lie.

Results in odd cases: a null or empty text is one empty line; short keys (under ``min_length``
code points) always stay; repeated lines of the first document all stay; rows with equal ids, or
with null ids, count as one document where the first is sought (a line stays in all of them or in
none), but each loses only the positions of its own text; a null document id sorts before all
others; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, lower_ascii, map_arrow, parted, read

#: What is stripped from both ends of a line: `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
ORDER = ["h1", "h2", "doc", "pos"]


def line_rows(docs: DataFrame, doc: str, text: str, min_length: int) -> DataFrame:
    """(h1, h2, doc, pos, check) of each line whose key has ``min_length`` code points or more."""
    lines = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("pos", "line"), F.xxhash64(text).alias("check"))
    keyed = lines.select("doc", "pos", "check", lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key")).where(F.length("key") >= min_length)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(11), "key").alias("h2"), "doc", "pos", "check")


def _changes(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: its last hash, that hash's first document in it, and whether the
    whole partition is that one hash."""
    first = last = head = None
    for batch in batches:
        h1, h2, doc, *_ = _changes(batch)
        for k in range(len(h1) - 1, -1, -1):  # the start of the batch's last run of equal hashes
            if (h1[k], h2[k]) != (h1[-1], h2[-1]):
                break
        else:
            k = -1
        if first is None:
            first = (h1[0], h2[0])
        if last != (h1[-1], h2[-1]) or k >= 0:
            last, head = (h1[-1], h2[-1]), doc[k + 1]
    if last is not None:
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "h1": [int(last[0])], "h2": [int(last[1])], "doc": [int(head)], "single": [first == last]}
        )


def _carried(edges: list) -> dict[int, tuple[int, int, int]]:
    """For each partition the hash that the one before it ended with, and its first document."""
    out: dict[int, tuple[int, int, int]] = {}
    before = None
    for e in sorted(edges, key=lambda e: e.part):
        if before is not None:
            out[e.part] = before
        if not (e.single and before is not None and before[:2] == (e.h1, e.h2)):
            before = (e.h1, e.h2, e.doc)
    return out


def repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_length: int = 10, partitions: int | None = None) -> DataFrame:
    """(doc, check, pos) of the lines that an earlier document holds; ``doc`` is a long, ``check`` a hash of the text."""
    spark = docs.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = line_rows(docs, doc, text, min_length).select("h1", "h2", F.coalesce(F.col("doc"), F.lit(-(2**63))).cast("long").alias("doc"), "pos", "check")
    rows = cut(rows)  # the bounds of the ranges are drawn from a sample: lines are parsed once
    rows = cut(rows.repartitionByRange(count, *ORDER).sortWithinPartitions(*ORDER))
    carried = _carried(rows.mapInArrow(_edges, "part int, h1 long, h2 long, doc long, single boolean").collect())

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at1, at2, head = carried.get(TaskContext.get().partitionId(), (None, None, None))
        for batch in batches:
            h1, h2, doc_ids, pos, check = _changes(batch)
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new[0] = at1 is None or (h1[0], h2[0]) != (at1, at2)
            run = np.cumsum(new) - 1
            heads = doc_ids[new]
            if not new[0]:
                heads, run = np.concatenate([[head], heads]), run + 1
            firsts = heads[run]
            at1, at2, head = h1[-1], h2[-1], firsts[-1]
            late = np.flatnonzero(doc_ids != firsts)
            if len(late):
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[late]), pa.array(check[late]), pa.array(pos[late])], names=["doc", "check", "pos"])

    return rows.mapInArrow(stream, "doc long, check long, pos int")


def pack(positions: np.ndarray) -> bytes:
    """The keep bitmap up to the byte of the last dropped line; all lines beyond it stay."""
    bits = np.ones((int(positions.max()) // 8 + 1) * 8 if len(positions) else 0, np.uint8)
    bits[positions] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def unpack(bitmap: bytes | None, lines: int) -> np.ndarray:
    """A flag for each of ``lines`` lines; no bitmap: all stay."""
    if not bitmap:
        return np.ones(lines, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:lines]
    return np.concatenate([bits, np.ones(lines - len(bits), np.uint8)]).astype(bool)


def keep_bitmaps(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_length: int = 10, partitions: int | None = None) -> DataFrame:
    """(doc, check, n_dropped, bitmap) of each document that loses lines; a repeated row counts once."""
    dropped = repeated_lines(docs, doc, text, min_length, partitions).groupBy("doc", "check").agg(F.collect_set("pos").alias("pos"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(x) for x in lists], pa.int64()), pa.array([pack(x) for x in lists], pa.binary())],
            names=["doc", "check", "n_dropped", "bitmap"],
        )

    return map_arrow(dropped, each, "doc long, check long, n_dropped long, bitmap binary")


def apply_bitmap(text: str | None, bitmap: bytes | None) -> tuple[str, int]:
    """The kept lines joined by a newline, and the number of lines before."""
    lines = (text or "").split("\n")
    if not bitmap:
        return text or "", len(lines)
    return "\n".join(x for x, stays in zip(lines, unpack(bitmap, len(lines)), strict=True) if stays), len(lines)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the columns ``n_dropped`` and ``bitmap`` (null: all lines stay). Only rows
    whose id may have a bitmap are shuffled."""
    named = cut(bitmaps.withColumnsRenamed({"doc": "__doc", "check": "__check"}))
    held = docs.withColumn("__held", F.coalesce(F.col(doc), F.lit(-(2**63))).cast("long"))
    some, rest = parted(held, "__held", named, "__doc")
    joined = some.join(named, (F.col("__held") == F.col("__doc")) & (F.xxhash64(text) == F.col("__check")), "left").drop("__doc", "__check")
    if rest is not None:
        joined = joined.unionByName(rest.withColumns({c: F.lit(None).cast(named.schema[c].dataType) for c in ("n_dropped", "bitmap")}))
    return joined.drop("__held")


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_length: int = 10) -> DataFrame:
    """``docs`` with the repeated lines cut from their texts; all columns and rows stay, and
    ``n_chars``, where there is one, is that of the text that is left. Texts without such
    lines are as they were, null included."""
    marked = with_bitmaps(docs.select(F.col(doc).alias("__key"), F.col(text).alias("__text"), F.struct("*").alias("__row")), keep_bitmaps(docs, doc, text, min_length), "__key", "__text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, maps = batch.column(1).to_pylist(), batch.column(4).to_pylist()
        kept = [t if m is None else apply_bitmap(t, m)[0] for t, m in zip(texts, maps, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(2), pa.array(kept, pa.string())], names=["row", "text"])

    out = map_arrow(marked, each, f"row {docs.schema.simpleString()}, text string")
    columns = [
        F.col("text").alias(text) if c == text else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`")
        for c in docs.columns
    ]
    return out.select(*columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document, by its keep bitmap."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = with_bitmaps(docs, keep_bitmaps(docs))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts, dropped, maps = (batch.column(i) for i in range(4))
        kept = [apply_bitmap(t, m) for t, m in zip(texts.to_pylist(), maps.to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([n for _, n in kept], pa.int64()),
                dropped.fill_null(0),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t, _ in kept], pa.string()),
            ],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return map_arrow(marked, each, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(f.first_doc <> k.doc_id, false) AS dropped
  FROM keyed k LEFT JOIN firsts f ON f.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
