"""Benchmark decontamination by a generalised suffix automaton of the test items.

Method: the normalised items are compiled into one suffix automaton over words. Training words
stream through it; at each word the automaton knows the longest suffix read so far that occurs in
an item. Where that length reaches the window, the last ``window`` words are hit, and the state
names the items. Spans of hit words are cut out, and documents whose share of hit words exceeds a
limit are dropped.

Texts are hashed to words by numpy; words whose short runs occur in no item cannot be part of a
match, so only the remaining stretches are walked word by word. Nothing is shuffled, and documents
are dropped where they lie. An automaton
holds at most ``SHARD_WORDS`` words (plus one item): a larger benchmark is split by item into
shards, each compiled by the driver and broadcast for a pass of its own, and the passes' spans are
merged per document (its id and a hash of its text). So what is broadcast has a fixed size whatever the benchmark's.

Results in odd cases: null texts have no words; an item without words gives no window; an item
shorter than the window is one window as a whole; repeated items are each counted under their id;
ids of items that repeat count once; an empty benchmark hits nothing; an empty table gives no rows;
extra columns are not read by ``overlaps`` and pass through ``decontaminate`` unchanged; rows of
repeated or null ids are judged each by its own text, with any number of shards.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, map_arrow, read
from fieldloom.llm.words import ALPHANUMERIC, FOLDED, U, chunks, rolling

SHARD_WORDS = 200_000
#: Words in the runs that are looked up before a stretch is walked.
SEED = 4
_SIEVE_BITS = 22


class SuffixAutomaton:
    """All substrings of several word sequences; which windows end in which items."""

    def __init__(self, items: Iterable[tuple[str, np.ndarray]], window: int):
        """``items``: (id, hashes of the words)."""
        self.window = window
        held = [(name, words.tolist()) for name, words in items if len(words)]
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in held:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self._mark(held)
        self.seed = min([SEED, window, *(len(w) for _, w in held)])
        runs = [rolling(np.array(w, U), self.seed) for _, w in held]
        self.runs = np.unique(np.concatenate(runs)) if runs else np.zeros(0, U)
        self.shortest = min([window, *(len(w) for _, w in held)])
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.runs >> U(64 - _SIEVE_BITS)] = True

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The part of state ``q`` that is reached from ``p`` by the longest string."""
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: int) -> int:
        if (q := self.step[last].get(w)) is not None:  # known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _mark(self, held: list[tuple[str, list[int]]]) -> None:
        """``ends``: items by the state of a full window; ``whole``: (words, item) of short items
        by state; ``top``: the state on the way to the root that has the full window."""
        self.ends: dict[int, set[str]] = defaultdict(set)
        self.whole: dict[int, set[tuple[int, str]]] = defaultdict(set)
        for name, words in held:
            need, s = min(self.window, len(words)), 0
            for k, w in enumerate(words, 1):
                s = self.step[s][w]
                while self.length[self.link[s]] >= need:
                    s = self.link[s]
                if k >= need:
                    if need == self.window:
                        self.ends[s].add(name)
                    else:
                        self.whole[s].add((need, name))
        self.top = [-1] * len(self.step)
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= self.window:
                self.top[s] = self.top[up] if self.length[up] >= self.window else s
            if up > 0 and up in self.whole:
                self.whole[s] |= self.whole[up]

    def walk(self, words: list[int], at: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        """Stream words that start at position ``at`` of their document; report hit spans."""
        s = length = 0
        for k, w in enumerate(words, at + 1):
            while s and w not in self.step[s]:
                s = self.link[s]
                length = self.length[s]
            if (t := self.step[s].get(w)) is None:
                s = length = 0
                continue
            s, length = t, length + 1
            if length >= self.window:
                spans.append((k - self.window, k))
                found |= self.ends[self.top[s]]
            if s in self.whole:
                for n, name in self.whole[s]:
                    if n <= length:
                        spans.append((k - n, k))
                        found.add(name)

    def stretches(self, words: np.ndarray, bounds: np.ndarray) -> Iterable[tuple[int, int, int]]:
        """(text, start, end) of the stretches that may hold a match."""
        runs = rolling(words, self.seed)
        maybe = np.flatnonzero(self.sieve[runs >> U(64 - _SIEVE_BITS)])
        if not len(maybe) or not len(self.runs):
            return
        at = np.minimum(np.searchsorted(self.runs, runs[maybe]), len(self.runs) - 1)
        known = maybe[self.runs[at] == runs[maybe]]
        text = np.searchsorted(bounds, known, "right") - 1
        inside = known + self.seed <= bounds[text + 1]
        known, text = known[inside], text[inside]
        breaks = np.flatnonzero((np.diff(known) != 1) | (np.diff(text) != 0)) + 1
        for part in np.split(np.arange(len(known)), breaks):
            if len(part) and len(part) + self.seed - 1 >= self.shortest:
                yield int(text[part[0]]), int(known[part[0]]), int(known[part[-1]]) + self.seed


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans' union as disjoint spans in order; neighbours are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_FOUND = "n_words long, starts array<int>, ends array<int>, items array<string>"


def _hashed(items: DataFrame, item: str, text: str) -> tuple[DataFrame, int]:
    """((item, words): the hashes of each item's words; the number of shards)."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [w.hashes[p:q].tobytes() for _, _, w, _ in chunks(batch.column(1), ALPHANUMERIC, FOLDED) for p, q in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], names=["item", "words"])

    named = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text))
    hashed = cut(map_arrow(named, each, "item string, words binary").distinct())
    total = hashed.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    return hashed, max(1, -(-total // (8 * SHARD_WORDS)))


def _automata(items: DataFrame, item: str, text: str, window: int) -> Iterable[SuffixAutomaton]:
    """One automaton for each shard of the items; the driver holds one shard at a time."""
    hashed, shards = _hashed(items, item, text)
    for shard in range(shards):
        part = hashed if shards == 1 else hashed.where(F.pmod(F.xxhash64("item", "words"), F.lit(shards)) == shard)
        yield SuffixAutomaton(((r.item, np.frombuffer(r.words, U)) for r in part.toLocalIterator()), window)


def _clean(docs: DataFrame, text: str, automaton: SuffixAutomaton) -> DataFrame:
    """The rows whose text holds no window, filtered where they lie."""
    held, at = docs.sparkSession.sparkContext.broadcast(automaton), docs.columns.index(text)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sam = held.value
        stays = np.ones(batch.num_rows, bool)
        for first, _, words, _ in chunks(batch.column(at), ALPHANUMERIC, FOLDED):
            for k, a, b in sam.stretches(words.hashes, words.bounds):
                if stays[first + k]:
                    spans: list = []
                    sam.walk(words.hashes[a:b].tolist(), a - int(words.bounds[k]), spans, set())
                    stays[first + k] = not spans
        return batch.filter(pa.array(stays))

    return map_arrow(docs, each, docs.schema)


def _pass(docs: DataFrame, text: str, automaton: SuffixAutomaton, extra: list[str]) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(automaton)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sam = held.value
        counts, starts, ends, items = [], [], [], []
        for first, stop, words, _ in chunks(batch.column(batch.schema.get_field_index(text)), ALPHANUMERIC, FOLDED):
            spans: dict[int, list] = defaultdict(list)
            found: dict[int, set] = defaultdict(set)
            for k, a, b in sam.stretches(words.hashes, words.bounds):
                sam.walk(words.hashes[a:b].tolist(), a - int(words.bounds[k]), spans[k], found[k])
            for k in range(stop - first):
                merged = merge(spans[k]) if k in spans else []
                counts.append(int(words.bounds[k + 1] - words.bounds[k]))
                starts.append([a for a, _ in merged])
                ends.append([b for _, b in merged])
                items.append(sorted(found[k]) if k in found else [])
        columns = [batch.column(batch.schema.get_field_index(c)) for c in extra]
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (starts, ends)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), *lists, pa.array(items, pa.list_(pa.string()))], names=[*extra, "n_words", "starts", "ends", "items"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return map_arrow(docs, each, f"{kinds}, {_FOUND}")


def overlaps(docs: DataFrame, items: DataFrame, window: int = 10, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc, n_words, starts, ends, items): of each document its number of words, the spans of hit
    words (from, up to; disjoint, in order) and the sorted ids of the items it holds windows of."""
    return _overlaps(docs, items, window, doc, text, item, item_text).drop("check")


def _overlaps(docs: DataFrame, items: DataFrame, window: int, doc: str, text: str, item: str, item_text: str) -> DataFrame:
    """What ``overlaps`` gives, and ``check``: a hash of the text."""
    plain = docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("check"), F.col(text).alias("text"))
    passes = [_pass(plain, "text", automaton, ["doc", "check"]) for automaton in _automata(items, item, item_text, window)]
    if len(passes) == 1:
        return passes[0]
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    # Equal rows have equal spans: sets hold one entry a pass however many rows there are.
    joined = every.groupBy("doc", "check").agg(
        F.max("n_words").alias("n_words"), F.collect_set(F.struct("starts", "ends")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.count(F.lit(1)).alias("rows")
    )
    joined = joined.select("doc", "check", "n_words", F.flatten("spans.starts").alias("s"), F.flatten("spans.ends").alias("e"), "items", (F.col("rows") / len(passes)).cast("int").alias("rows"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [merge(zip(s, e, strict=True)) for s, e in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        lists = [pa.array([[x[k] for x in m] for m in spans], pa.list_(pa.int32())) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *lists, *batch.columns[5:]], names=["doc", "check", "n_words", "starts", "ends", "items", "rows"])

    merged = map_arrow(joined, each, f"doc {docs.schema[doc].dataType.simpleString()}, check long, {_FOUND}, rows int")
    return merged.withColumn("rows", F.explode(F.array_repeat(F.lit(1), F.col("rows")))).drop("rows")


def hit_words() -> F.Column:
    """The number of hit words, from ``starts`` and ``ends``."""
    lengths = F.zip_with("ends", "starts", lambda e, s: (e - s).cast("long"))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda n, x: n + x)


def cut_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """``text`` without the bytes from the first to the last word of each span; one space stays
    where both neighbours would else touch."""
    for _, _, words, data in chunks(pa.array([text]), ALPHANUMERIC, FOLDED):
        raw, out, at = data.tobytes(), [], 0
        for a, b in zip(starts, ends, strict=True):
            out.append(raw[at : words.starts[a]])
            at = int(words.ends[b - 1])
        return b"".join([*out, raw[at:]]).decode()
    return text


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_length: int = 9, max_coverage: float = 0.0, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without hit spans longer than ``max_length`` words and without the documents whose
    share of hit words exceeds ``max_coverage``; at 0 every document with a hit goes. With a higher
    limit documents stay and lose the spans. All columns are kept."""
    if max_coverage <= 0:
        automata = iter(_automata(items, item, item_text, window))
        only = next(automata)
        if next(automata, None) is None:  # one shard: each row is judged where it lies
            return _clean(docs, text, only)
    found = _overlaps(docs, items, window, doc, text, item, item_text).where(F.size("starts") > 0).select(F.col("doc").alias("__doc"), F.col("check").alias("__check"), "starts", "ends", hit_words().alias("__hit"), F.col("n_words").alias("__words"))
    over = F.col("__hit") > F.lit(max_coverage) * F.col("__words")
    if max_coverage <= 0:
        return docs.join(found.where(over).select("__doc", "__check").distinct(), docs[doc].eqNullSafe(F.col("__doc")) & (F.xxhash64(docs[text]) == F.col("__check")), "left_anti")
    found = found.dropDuplicates(["__doc", "__check"])
    same = F.col("__own").eqNullSafe(F.col("__doc")) & (F.xxhash64("__text") == F.col("__check"))
    joined = docs.select(F.col(text).alias("__text"), F.struct("*").alias("__row"), F.col(doc).alias("__own")).join(found, same, "left").where(~F.coalesce(over, F.lit(False)))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for t, s, e in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            spans = [(a, b) for a, b in zip(s or [], e or [], strict=True) if b - a > max_length]
            texts.append(cut_spans(t, *zip(*spans, strict=True)) if spans else t)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = map_arrow(joined.select("__row", "__text", "starts", "ends"), each, f"row {docs.schema.simpleString()}, text string")
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = hit_words()
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


OP3_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_starts AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM item_words WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM item_starts),
sizes AS (SELECT DISTINCT n FROM windows),
doc_starts AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc_words, sizes WHERE len(w) >= n
),
hits AS (
  SELECT d.doc_id, d.p, d.n, x.item_id
  FROM doc_starts d JOIN windows x ON x.n = d.n AND x.g = array_to_string(d.w[d.p : d.p + d.n - 1], ' ')
),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) t GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) t GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""
