"""Substring dedup: repeated passages by sharded phrase automata.

A window is ``length`` consecutive words of one document. A word is removed if a window that covers
it has a word sequence that also starts anywhere else.

Method, in four steps, none of which needs more than a bounded part of the data at a time:

1. Anchors. Of the ``GRAM``-word runs inside a window the one with the smallest hash is the
   window's anchor; equal windows have equal anchors. Neighbouring windows with one anchor (at most
   ``SPREAD``) form a context: a stretch of a document. Contexts are counted by (anchor, content)
   with partial sums, so copies and shared passages collapse to one row with a count before
   anything is compared. Anchors that occur once are dropped: their windows occur once.
2. Confirm. The windows of the contexts left, each context once, are counted by hash (weighted by
   the context's count). Those that occur twice or more are the recurring phrases; each is taken
   from one context.
3. Automata. Phrases are sharded by anchor; each shard's phrases are compiled into an Aho-Corasick
   automaton over words (pyahocorasick), and the shard's contexts stream through it, which locates
   every occurrence. A shard with many phrases or contexts is a grid of phrase and context blocks,
   every one of its automata meeting every one of its context blocks, so that an anchor that a third
   of all documents hold is many tasks.
4. Located windows go back from contexts to the documents that hold them, as bit masks.

Anchors are 64-bit hashes, contexts 128 bits; within a context words are told apart by 40 bits of
their hashes, so that two windows are confused only if every word in which they differ agrees in
these (2^-40 each).

Results in odd cases: a null text has no words; texts under ``length`` words lose nothing; a text of
any length is taken whole; repeated rows are two documents with equal windows, so they lose all that
windows cover; an empty table gives no rows; extra columns are not read by ``repeated_spans``.
"""

from __future__ import annotations


from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, map_arrow, passes, read, sieve, slot
from fieldloom.llm.words import BETWEEN_SPACE, EXACT, U, chunks, mix, rolling
from fieldloom.operators.skew import skew_join

LENGTH, GRAM = 35, 8
#: Windows of a context at most (bits of a mask); phrases of an automaton; contexts of a block.
SPREAD, PHRASES, CONTEXTS = 28, 8192, 16384
#: Occurrences of one anchor that a task takes.
HOT_ROWS = 4096


#: Bytes of a word's hash that travel with a context.
WORD_BYTES = 5


def packed(hashes: np.ndarray) -> bytes:
    return hashes.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def unpacked(words: bytes | pa.Buffer) -> np.ndarray:
    out = np.zeros((len(words) // WORD_BYTES, 8), np.uint8)
    out[:, :WORD_BYTES] = np.frombuffer(words, np.uint8).reshape(-1, WORD_BYTES)
    return out.view(U).ravel()


class Contexts(NamedTuple):
    """The contexts of a group of texts, in order."""

    anchor: np.ndarray
    content: np.ndarray
    text: np.ndarray  # row, less the group's first
    start: np.ndarray  # first word, within the group
    count: np.ndarray  # windows
    again: np.ndarray  # the anchor stands in it more than once, so a window may repeat within


def contexts_of(hashes: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Contexts:
    grams = rolling(hashes, gram)
    span = length - gram + 1  # grams of a window
    n = len(hashes) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Contexts(none.view(U), none.view(U), none, none, none, none)
    least, width = grams, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(grams) - span + 1], least[span - width :])
    text = np.searchsorted(bounds, np.arange(n), "right") - 1
    inside = np.arange(n) + length <= bounds[text + 1]
    at = np.flatnonzero(inside)
    if not len(at):
        return Contexts(least[:0], least[:0], at, at, at, at)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (text[at[1:]] != text[at[:-1]]) | (least[at[1:]] != least[at[:-1]])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(at)))
    parts = -(-counts // SPREAD)  # a long run (periodic text) is several contexts
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = at[np.repeat(starts, parts)] + number * SPREAD
    count = np.minimum(SPREAD, np.repeat(counts, parts) - number * SPREAD)
    grams_in = count + span - 1
    first = np.cumsum(grams_in) - grams_in
    each = np.repeat(start - first, grams_in) + np.arange(grams_in.sum())
    again = np.add.reduceat(grams[each] == np.repeat(least[start], grams_in), first, dtype=np.int64) > 1
    return Contexts(least[start], _content(hashes, start, count + length - 1), text[start], start, count, again)


def _content(hashes: np.ndarray, start: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of each stretch of words."""
    salted = mix(hashes ^ U(0xA0761D6478BD642F))
    sums = np.zeros(len(hashes) + 1, U)
    base = U(0xE7037ED1A0B428DB)
    up = np.cumprod(np.concatenate([[U(1)], np.full(len(hashes), base, U)]))
    down = np.cumprod(np.concatenate([[U(1)], np.full(len(hashes), U(pow(0xE7037ED1A0B428DB, -1, 2**64)), U)]))
    np.cumsum(salted * up[:-1], out=sums[1:])
    return mix((sums[start + words] - sums[start]) * down[start] + words.astype(U))


#: ``place``: first word * 256 + windows.
_OCCURRENCE = "anchor long, content long, doc long, check long, place long, again int"


def _plain(docs: DataFrame, doc: str, text: str, *more: Column) -> DataFrame:
    """(doc, check, text, more): ``check`` tells rows of one id apart by their text."""
    words = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(words).alias("check"), words.alias("text"), *more)


def occurrences(plain: DataFrame, length: int) -> DataFrame:
    """All contexts of all documents, a row each."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        docs, checks = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
        parts = []
        for first, _, words, _ in chunks(batch.column(2), BETWEEN_SPACE, EXACT):
            c = contexts_of(words.hashes, words.bounds, length)
            parts.append((c.anchor.view(np.int64), c.content.view(np.int64), first + c.text, (c.start - words.bounds[c.text]) * 256 + c.count, c.again))
        if not parts:
            return None
        anchor, content, row, place, again = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(content), batch.column(0).take(pa.array(row)), pa.array(checks[row]), pa.array(place), pa.array(again.astype(np.int32))],
            names=["anchor", "content", "doc", "check", "place", "again"],
        )

    return map_arrow(plain, each, _OCCURRENCE)


def _with_words(plain: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, content, n, words) of the wanted contexts, their words' hashes from one document."""
    lists = wanted.groupBy("doc", "check").agg(F.collect_list(F.struct("anchor", "content", "n", "place")).alias("held"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        held = batch.column(1).to_pylist()
        out: list[tuple] = []
        for first, stop, words, _ in chunks(batch.column(0), BETWEEN_SPACE, EXACT):
            for k in range(first, stop):
                own = words.hashes[words.bounds[k - first] : words.bounds[k - first + 1]]
                out += [(h["anchor"], h["content"], h["n"], packed(own[h["place"] >> 8 : (h["place"] >> 8) + (h["place"] & 255) + length - 1])) for h in held[k]]
        if not out:
            return None
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["anchor", "content", "n", "words"])

    bits = plain.sparkSession.sparkContext.broadcast(sieve(lists, F.col("doc")))

    def sift(batch: pa.RecordBatch) -> pa.RecordBatch:
        may = passes(bits.value, batch.column(3).to_numpy())
        return batch.filter(pa.array(may)).select(["doc", "check", "text"])

    # A row that stands there twice gives a context twice, whose windows recur anyway.
    some = map_arrow(plain.withColumn("slot", slot(F.col("doc"))), sift, "doc long, check long, text string")
    joined = some.join(lists.withColumnsRenamed({"doc": "__doc", "check": "__check"}), F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("check") == F.col("__check")))
    return map_arrow(joined.select("text", "held"), each, "anchor long, content long, n long, words binary")


def _phrases(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, words, mask): which windows of a context are the phrases taken from it."""

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = [rolling(mix(unpacked(w.as_buffer())), length) for w in batch.column(3)]
        counts = [len(r) for r in runs]
        row = pa.array(np.repeat(np.arange(len(runs)), counts))
        offset = np.concatenate([np.arange(c) for c in counts]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(runs).view(np.int64)), *(batch.column(k).take(row) for k in (0, 1, 2)), pa.array(offset)],
            names=["window", "anchor", "content", "n", "offset"],
        )

    each = map_arrow(contexts, windows, "window long, anchor long, content long, n long, offset int")
    # The anchor is a function of the window; as a second key it makes the comparison 128 bits wide.
    found = each.groupBy("window", "anchor").agg(F.sum("n").alias("n"), F.min("content").alias("content"), F.min_by("offset", "content").alias("offset")).where("n > 1")
    masks = found.groupBy("anchor", "content").agg(F.bit_or(F.expr("shiftleft(1L, offset)")).alias("mask"))
    return masks.join(contexts.select("anchor", "content", "words"), ["anchor", "content"]).select("anchor", "content", "words", "mask")


def locate(phrases: list[tuple[bytes, int]], contexts: list[bytes], length: int) -> list[int]:
    """For each context a mask of the windows in it that are phrases; a phrase is a window, told by
    its bit in the mask, of some stretch of words."""
    numbers: dict[int, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for words, mask in phrases:
        ids = [numbers.setdefault(h, len(numbers) + 1) for h in unpacked(words).tolist()]
        for offset in range(len(ids) - length + 1):
            if mask >> offset & 1:
                automaton.add_word(tuple(ids[offset : offset + length]), length)
    automaton.make_automaton()
    out = []
    for words in contexts:
        ids = tuple([numbers.get(h, 0) for h in unpacked(words).tolist()])
        out.append(sum({1 << (end - length + 1) for end, _ in automaton.iter(ids)}))
    return out


def _located(contexts: DataFrame, phrases: DataFrame, length: int) -> DataFrame:
    """(anchor, content, mask): the windows of each context that recur."""
    total = phrases.agg(F.sum(F.expr("bit_count(mask)"))).first()[0] or 0
    shards = max(1, -(-int(total) // PHRASES) * 2)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")
    blocks = lambda n, most: F.greatest(F.lit(1), F.ceil(n / most)).cast("int")
    phrase_counts = phrases.groupBy(shard.alias("shard")).agg(blocks(F.sum(F.expr("bit_count(mask)")), PHRASES).alias("p_blocks"))
    context_counts = contexts.groupBy(shard.alias("shard")).agg(blocks(F.count(F.lit(1)), CONTEXTS).alias("c_blocks"))
    grid = cut(phrase_counts.join(context_counts, "shard"))
    block = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "anchor", "content"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = phrases.withColumn("shard", shard).join(grid, "shard").withColumn("p", block(1, F.col("p_blocks"))).select("shard", "p", each(F.col("c_blocks")).alias("c"), "words", "mask")
    right = contexts.withColumn("shard", shard).join(grid, "shard").withColumn("c", block(2, F.col("c_blocks"))).select("shard", each(F.col("p_blocks")).alias("p"), "c", "anchor", "content", "words")

    def stream(known: pa.Table, held: pa.Table) -> pa.Table:
        phrase_rows = list(zip(known.column("words").to_pylist(), known.column("mask").to_pylist(), strict=True))
        masks = locate(phrase_rows, held.column("words").to_pylist(), length) if phrase_rows else [0] * held.num_rows
        hit = pa.array(np.flatnonzero(np.array(masks, np.int64)))
        return pa.table({"anchor": held.column("anchor").take(hit), "content": held.column("content").take(hit), "mask": pa.array([m for m in masks if m], pa.int64())})

    found = left.groupBy("shard", "p", "c").cogroup(right.groupBy("shard", "p", "c")).applyInArrow(stream, "anchor long, content long, mask long")
    return found.groupBy("anchor", "content").agg(F.bit_or("mask").alias("mask"))


def repeated_spans(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc, check, starts, masks): of each document with repeated windows the first words of its
    contexts and the masks of the repeated windows in them; ``check`` as in ``_plain``."""
    plain = _plain(docs, doc, text)
    every = occurrences(plain, length)
    anchors = cut(every.groupBy("anchor").agg(F.sum(F.col("again") + 1).alias("total"), F.count(F.lit(1)).alias("n")).where("total > 1").select("anchor", "n"))
    # Occurrences of an anchor that very many documents hold are dealt over several tasks.
    held = cut(skew_join(every, anchors.select(F.col("anchor").alias("of")), [("anchor", "of")], "semi", HOT_ROWS, keys_from=anchors, rows="n").drop("again"))
    del every, anchors
    wanted = held.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "check", "place")).alias("one"))
    contexts = cut(_with_words(plain, wanted.select("anchor", "content", "n", "one.*"), length))
    del wanted
    masks = cut(_located(contexts, cut(_phrases(contexts, length)), length))
    placed = held.join(masks, ["anchor", "content"]).select("doc", "check", F.expr("cast(place >> 8 as int)").alias("start"), "mask")
    return placed.groupBy("doc", "check").agg(F.collect_list("start").alias("starts"), F.collect_list("mask").alias("masks"))


def removed_words(n: int, starts: list[int], masks: list[int], length: int = LENGTH) -> np.ndarray:
    """A flag for each of ``n`` words: covered by a repeated window."""
    bits = (np.array(masks, np.int64)[:, None] >> np.arange(SPREAD)) & 1
    row, offset = np.nonzero(bits)
    at = np.array(starts, np.int64)[row] + offset
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge)[:n] > 0


def _kept(docs: DataFrame, keys: list[Column], doc: str, text: str, length: int) -> DataFrame:
    """``keys`` and (n_words, n_removed, kept): the kept words joined by one space."""
    spans = cut(repeated_spans(docs, doc, text, length))
    rows = _plain(docs.withColumn("__keys", F.struct(*keys)), doc, text, F.col("__keys").alias("keys"))
    bits = docs.sparkSession.sparkContext.broadcast(sieve(spans, F.col("doc")))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, removed, kept = [], [], []
        for t, starts, masks in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = t.as_py().encode().split()
            stays = words
            if starts:
                gone = removed_words(len(words), starts, masks, length)
                stays = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            counts.append(len(words))
            removed.append(len(words) - len(stays))
            kept.append(b" ".join(stays).decode())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["keys", "n_words", "n_removed", "kept"])

    def sift(batch: pa.RecordBatch) -> pa.RecordBatch:
        may = passes(bits.value, batch.column(4).to_numpy())
        return batch.filter(pa.array(may)).select(["doc", "check", "text", "keys"])

    def untouched(batch: pa.RecordBatch) -> pa.RecordBatch:
        rest = batch.filter(pa.array(~passes(bits.value, batch.column(4).to_numpy())))
        none = [pa.nulls(rest.num_rows, pa.list_(pa.int32())), pa.nulls(rest.num_rows, pa.list_(pa.int64()))]
        return each(pa.RecordBatch.from_arrays([rest.column(3), rest.column(2), *none], names=["keys", "text", "starts", "masks"]))

    # Only the rows that may lose words are shuffled with their texts.
    kinds = rows.schema["keys"].dataType.simpleString()
    out = f"keys {kinds}, n_words long, n_removed long, kept string"
    slotted = rows.withColumn("slot", slot(F.col("doc")))
    some = map_arrow(slotted, sift, f"doc long, check long, text string, keys {kinds}")
    joined = some.join(spans.withColumnsRenamed({"doc": "__doc", "check": "__check"}), F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("check") == F.col("__check")), "left")
    return map_arrow(slotted, untouched, out).unionByName(map_arrow(joined.select("keys", "text", "starts", "masks"), each, out))


def remove_repeated(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts; texts that lose nothing are as
    they were, all other columns too."""
    found = _kept(docs, [F.struct(*docs.columns).alias("row")], doc, text, length)
    return found.select(*[F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(f"keys.row.`{c}`")).alias(c) if c == text else F.col(f"keys.row.`{c}`") for c in docs.columns])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = _kept(docs, [F.col("doc_id")], "doc_id", "text", LENGTH)
    return found.select("keys.doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM words WHERE len(w) >= 35),
windows AS (SELECT r, p, md5(array_to_string(w[p : p + 34], ' ')) AS g FROM starts),
again AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM windows JOIN again USING (g)),
each_word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS q FROM words),
kept AS (
  SELECT e.r, count(*) AS n_kept, string_agg(e.x, ' ' ORDER BY e.q) AS t
  FROM each_word e LEFT JOIN gone ON gone.r = e.r AND gone.q = e.q
  WHERE gone.q IS NULL GROUP BY e.r
)
SELECT words.doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON kept.r = words.r
"""

