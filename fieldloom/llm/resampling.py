"""Importance resampling of a corpus towards a target set.

Method: runs of one and two words are hashed into buckets, and the buckets' counts over the corpus
and over the target set give each bucket a gain, the logarithm of how much likelier it is in the
target. A document's weight is the mean gain of its runs; with Gumbel noise from its id, the
highest scores are a weighted draw without replacement. Gains are an array that every task holds (a
number a bucket), and tasks score whole batches of texts by array operations: each word is hashed
once, and a run's crc32 is combined from those of its words by tables of how zeros move a crc.

The cutoff is found by a weighted median of medians. In each round every partition gives the median
of the keys that are still open and how many they are; the median of these, weighted by the sizes,
has at least a quarter of all open keys on either side, so each round discards that much or more,
exactly. Keys are (score, id, runs, row): no two are equal, so ties never matter. Rows are stored
anew when few are left open, and the last few thousand are looked at directly. Only the winners are sorted, by
ranges of that key, and numbered by prefix sums over the partitions.

Texts are never shuffled; they are read twice, once for counts and once for weights. What reaches
the driver: a row a bucket, a row a partition and round, ``DIRECT`` keys at the end. A task holds
the open keys of its partition (32 bytes a document).

Results in odd cases: a null or empty text, or one without words, has no runs and weight 0, and is
never drawn; a word or a text of any length is taken whole, piece by piece; rows of one id each
count and are scored; among equal scores the smaller id goes first, null ids last (their noise is
that of an empty id), then fewer runs; an empty corpus gives no rows; an empty target gives gains
by the same formula; extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldloom.llm.shared import cut, map_arrow, read, ship
from fieldloom.llm.words import ALPHANUMERIC, text_bytes

#: Bytes of text taken at once; longer words are hashed one by one; keys looked at directly.
PIECE, LONG_WORD, DIRECT = 1 << 19, 64, 4096
LAST = 2**63 - 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _byte_table() -> np.ndarray:
    """What a byte does to a crc32: division by its polynomial, bit by bit."""
    v = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        v = np.where(v & 1, (v >> 1) ^ np.uint32(0xEDB88320), v >> 1).astype(np.uint32)
    return v


def _zeros_tables(longest: int) -> np.ndarray:
    """[n, k, b]: what n zero bytes make of a crc whose byte k is b, other bytes 0."""
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(longest):
        out[n + 1] = _BYTE[out[n] & 255] ^ (out[n] >> 8)
    return out


_BYTE = _byte_table()
_ZEROS = _zeros_tables(LONG_WORD)


class Piece(NamedTuple):
    """The words of a run of bytes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # the text of each word


def words_of_piece(data: np.ndarray, bounds: np.ndarray, first_row: int) -> Piece:
    """The words of the texts that part ``data`` at ``bounds``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ALPHANUMERIC[data]
    fresh = np.zeros(len(data) + 2, bool)
    fresh[bounds + 1] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | fresh[1:]))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh[1:]))
    rows = np.searchsorted(bounds, starts, "right") - 1 + first_row
    return Piece(data, starts, ends, rows)


def crcs(piece: Piece) -> np.ndarray:
    """The crc32 of each word: all words byte by byte together, the longest first."""
    sizes = piece.ends - piece.starts
    order = np.argsort(-sizes, kind="stable")
    starts, falling = piece.starts[order], -sizes[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(min(LONG_WORD, int(sizes.max(initial=0)))):
        n = int(np.searchsorted(falling, -k))  # words of more than k bytes
        part = state[:n]
        state[:n] = _BYTE[(part ^ piece.data[starts[:n] + k]) & 255] ^ (part >> 8)
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for k in np.flatnonzero(sizes > LONG_WORD):
        out[k] = zlib.crc32(piece.data[piece.starts[k] : piece.ends[k]])
    return out


def joined(before: np.ndarray, piece: Piece, at: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The crc32 of what has the crc32 ``before``, a space and the words ``at``, whose own are ``own``."""
    spaced = ~(_BYTE[(~before ^ np.uint32(32)) & 255] ^ (~before >> 8))
    sizes = piece.ends[at] - piece.starts[at]
    n = np.minimum(sizes, LONG_WORD)
    out = own.copy()
    for k in range(4):
        out ^= _ZEROS[n, k, (spaced >> np.uint32(8 * k)) & 255]
    for k in np.flatnonzero(sizes > LONG_WORD):
        out[k] = zlib.crc32(piece.data[piece.starts[at[k]] : piece.ends[at[k]]], int(spaced[k]))
    return out


def pieces(texts: pa.Array) -> Iterator[tuple[Piece, bool]]:
    """All words in order, and whether a piece goes on with the text of the one before. Pieces end
    between texts, or between the words of a long one."""
    data, offsets = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1
        if stop > row:
            yield words_of_piece(_FOLD[data[offsets[row] : offsets[stop]]], offsets[row:stop] - offsets[row], row), False
            row = stop
            continue
        at, end, more = offsets[row], offsets[row + 1], False
        while at < end:
            to = min(at + PIECE, end)
            while to < end and ALPHANUMERIC[data[to - 1 : to + 1]].all():  # not within a word
                found = np.flatnonzero(~ALPHANUMERIC[data[to : min(to + PIECE, end)]])
                to = to + int(found[0]) if len(found) else min(to + PIECE, end)
            yield words_of_piece(_FOLD[data[at:to]], np.zeros(1, np.int64), row), more
            at, more = to, True
        row += 1


def features(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every run of one or two words."""
    carried = np.zeros(0, np.uint32)
    for piece, goes_on in pieces(texts):
        if not goes_on:
            carried = carried[:0]
        if not len(piece.starts):
            continue
        own = crcs(piece)
        second = np.flatnonzero(piece.rows[1:] == piece.rows[:-1]) + 1
        before = own[second - 1]
        if len(carried):
            second, before = np.concatenate([[0], second]), np.concatenate([carried, before])
        pairs = joined(before, piece, second, own[second])
        yield np.concatenate([piece.rows, piece.rows[second]]), (np.concatenate([own, pairs]) % np.uint32(buckets)).astype(np.int64)
        carried = own[-1:]


def bucket_counts(texts: DataFrame, text: str, buckets: int) -> np.ndarray:
    """How many runs fall into each bucket, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in features(batch.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    ship(texts.sparkSession)
    found = texts.select(F.col(text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths: the logarithm of its share of the target over that of the
    corpus, both with one more run in each bucket."""
    buckets, in_corpus, in_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log(float((t + 1) * (in_corpus + buckets)) / float((s + 1) * (in_target + buckets)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def noise(key: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths, from the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, seed: int, doc: str, text: str) -> DataFrame:
    """(doc, n_features, weight, score) of each row."""
    buckets = len(gain)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for rows, found in features(batch.column(1), buckets):
            low, high = int(rows.min()), int(rows.max()) + 1
            n[low:high] += np.bincount(rows - low, minlength=high - low)
            sums[low:high] += np.bincount(rows - low, weights=gain[found], minlength=high - low).astype(np.int64)  # whole, below 2^53
        weight = sums // np.maximum(n, 1)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight)], names=["doc", "n_features", "weight"])

    kind = docs.schema[doc].dataType.simpleString()
    rows = map_arrow(docs.select(F.col(doc).alias("doc"), F.col(text)), each, f"doc {kind}, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc"), seed))


# The cutoff

Key = tuple[int, int, int, int]
#: The order of a draw: falling score, then rising id, runs and row.
ORDER = ("place", "tie", "n_features", "row")


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``ORDER``."""
    return rows.select("*", (-F.col("score")).alias("place"), F.coalesce(F.col("doc").cast("long"), F.lit(LAST)).alias("tie"), F.monotonically_increasing_id().alias("row"))


def up_to(key: Key) -> Column:
    """Whether a row's key comes before ``key`` or is it."""
    out = F.lit(True)
    for name, v in reversed(list(zip(ORDER, key, strict=True))):
        out = (F.col(name) < v) | ((F.col(name) == v) & out)
    return out


def _open(batch: pa.RecordBatch, low: Key | None, high: Key | None) -> list[np.ndarray]:
    """The key columns of the rows after ``low`` up to ``high``."""
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]

    def within(key: Key) -> np.ndarray:
        out = np.ones(len(columns[0]), bool)
        for c, v in reversed(list(zip(columns, key, strict=True))):
            out = (c < v) | ((c == v) & out)
        return out

    keep = np.ones(len(columns[0]), bool) if high is None else within(high)
    if low is not None:
        keep &= ~within(low)
    return [c[keep] for c in columns]


def medians(keys: DataFrame, low: Key | None, high: Key | None) -> list[tuple[Key, int]]:
    """(median key, number) of the open keys of each partition that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_open(b, low, high) for b in batches]
        columns = [np.concatenate(c) for c in zip(*held, strict=True)] if held else [np.zeros(0, np.int64)] * 4
        n = len(columns[0])
        if n:
            middle = np.lexsort(columns[::-1])[(n - 1) // 2]
            yield pa.RecordBatch.from_arrays([pa.array([int(c[middle])]) for c in columns] + [pa.array([n])], names=[*ORDER, "n"])

    ship(keys.sparkSession)
    found = keys.select(*ORDER).mapInArrow(run, "place long, tie long, n_features long, row long, n long").collect()
    return [(tuple(r[c] for c in ORDER), r.n) for r in found]


def weighted_median(found: list[tuple[Key, int]]) -> Key:
    """The key up to which half of the weight lies."""
    found = sorted(found)
    half, seen = sum(n for _, n in found) / 2, 0
    for key, n in found:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, direct: int = DIRECT) -> Key | None:
    """The ``k``-th key in order, None for none. ``keys`` has been stored; no two are equal."""
    if k < 1:
        return None
    low: Key | None = None
    high: Key | None = None
    stored = None
    while True:
        found = medians(keys, low, high)
        n = sum(m for _, m in found)
        if n < k:
            raise ValueError(f"{k} keys asked for, {n} there")
        if n <= direct or n == 1:
            within = (F.lit(True) if high is None else up_to(high)) & (F.lit(True) if low is None else ~up_to(low))
            return sorted(tuple(r) for r in keys.where(within).select(*ORDER).collect())[k - 1]
        if stored is None:
            stored = n
        elif n < stored / 8:
            within = (F.lit(True) if high is None else up_to(high)) & (F.lit(True) if low is None else ~up_to(low))
            keys, stored = cut(keys.select(*ORDER).where(within)), n
        pivot = weighted_median(found)
        first = keys.where(up_to(pivot) & (F.lit(True) if low is None else ~up_to(low))).count()
        if first == k:
            return pivot
        if first > k:
            high = pivot
        else:
            low, k = pivot, k - first


def ranked(winners: DataFrame, rank: str = "rank") -> DataFrame:
    """``winners`` numbered from 1 by ``ORDER``: sorted by ranges, then counted through."""
    rows = cut(winners.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(b.num_rows for b in batches)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], names=["part", "n"])

    starts, at = {}, 0
    for r in sorted(rows.select("row").mapInArrow(count, "part int, n long").collect(), key=lambda r: r.part):
        starts[r.part] = at
        at += r.n

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = starts.get(TaskContext.get().partitionId(), 0) + 1
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(at, at + b.num_rows))], names=[*b.schema.names, rank])
            at += b.num_rows

    return rows.mapInArrow(number, StructType([*rows.schema, StructField(rank, LongType())]))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000, doc: str = "doc_id", text: str = "text", target_text: str = "text",
    direct: int = DIRECT,
) -> DataFrame:
    """(doc, n_features, weight, score, rank) of each row: ``percent`` of the documents of
    ``min_words`` words or more are drawn and have a rank. Ids are whole numbers."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    rows = cut(keyed(scored(docs, gain, seed, doc, text)))
    fit = F.col("n_features") >= max(1, 2 * min_words - 1)  # n words have 2n - 1 runs
    key = cutoff(rows.where(fit), percent * rows.where(fit).count() // 100, direct)
    names = ("doc", "n_features", "weight", "score")
    if key is None:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    drawn = fit & up_to(key)
    return ranked(rows.where(drawn)).select(*names, "rank").unionByName(rows.where(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are drawn, all their columns. No text is shuffled: each row is
    scored once more and held against the cutoff, so rows that equal the last one drawn in score,
    id and number of words all stay."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, "text", buckets))
    rows = cut(keyed(scored(docs, gain, seed, doc, text)).where(F.col("n_features") >= max(1, 2 * min_words - 1)))
    key = cutoff(rows, percent * rows.count() // 100)
    if key is None:
        return docs.limit(0)
    place, tie, n_features, _ = key
    names = docs.columns
    at = names.index(text)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for found, bucket in features(batch.column(at), buckets):
            np.add.at(n, found, 1)
            np.add.at(sums, found, gain[bucket])
        mine = -(sums // np.maximum(n, 1) + batch.column(batch.num_columns - 2).to_numpy())
        ids = batch.column(batch.num_columns - 1).to_numpy()
        kept = (mine < place) | ((mine == place) & ((ids < tie) | ((ids == tie) & (n <= n_features))))
        kept &= n >= max(1, 2 * min_words - 1)
        return pa.RecordBatch.from_arrays([c.filter(pa.array(kept)) for c in batch.columns[:-2]], names=names)

    extra = docs.select("*", noise(F.col(doc), seed).alias("__noise"), F.coalesce(F.col(doc).cast("long"), F.lit(LAST)).alias("__tie"))
    return map_arrow(extra, keep, docs.schema)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, drawn or not."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = resample(docs, read(spark, sf_dir, "benchmark").select("text"))
    return rows.select(F.col("doc").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")
