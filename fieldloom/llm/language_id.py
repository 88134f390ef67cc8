"""Language identification by hyperdimensional profiles.

Method: every letter has a random vector of +1 and -1. A trigram is the product (binding) of its
letters' vectors, rotated by two, one and no places (permutation). A document is the sum (bundle)
of its trigrams; a language's prototype is the bundle of its training documents. A document gets
the language whose prototype has the highest cosine with it.

Letters are lower-cased and all other characters are blanks, which have a vector too; no trigram
spans two words. A batch of documents is a count matrix times the matrix of its trigrams'
vectors, a bounded block of trigrams at a time. Training sends one vector per language and task to an exact sum by language and place;
the prototypes (languages x ``DIMENSIONS`` numbers) are all that reaches the driver.

Results in odd cases: null texts and texts without a letter are ``und`` with score 0, as is
everything if there is nothing to learn from; equal cosines go to the language that comes first
in code point order; texts of any length are bundled whole; repeated rows are judged each; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import crc_bucket, map_arrow, read, ship

DIMENSIONS = 1024
#: Characters that are counted at once, and documents; trigrams whose vectors are made at once.
GROUP, GROUP_TEXTS, BLOCK = 1 << 18, 512, 8192
_SEED = 977


class Letters:
    """Random vectors of letters, made from their code points when they are first met."""

    def __init__(self) -> None:
        self.alpha = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
        self.number = np.zeros(0x110000, np.int32)  # 0: the blank
        self.vectors = np.empty((0, DIMENSIONS), np.int8)
        self._add([32])

    def _add(self, points: list[int]) -> None:
        made = [np.random.default_rng((_SEED, p)).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1 for p in points]
        self.number[points] = np.arange(len(self.vectors), len(self.vectors) + len(points))
        self.vectors = np.concatenate([self.vectors, np.array(made, np.int8)])
        self.turned = [self.vectors, np.roll(self.vectors, 1, axis=1), np.roll(self.vectors, 2, axis=1)]

    def numbers(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each character, whether it is a letter)."""
        letter = self.alpha[points]
        found = np.where(letter, self.number[points], 0)
        new = letter & (found == 0)
        if new.any():
            self._add(np.unique(points[new]).tolist())
            found = np.where(letter, self.number[points], 0)
        return found, letter

    def bind(self, trigrams: np.ndarray) -> np.ndarray:
        """The vectors of trigrams given by three rows of letter numbers."""
        a, b, c = trigrams
        return (self.turned[2][a] * self.turned[1][b] * self.turned[0][c]).astype(np.float32)


_LETTERS: list[Letters] = []


def letters() -> Letters:
    if not _LETTERS:
        _LETTERS.append(Letters())
    return _LETTERS[0]


def groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= GROUP and stop - at < GROUP_TEXTS):
            size += len(texts[stop] or "")
            stop += 1
        yield at, stop
        at = stop


def bundles(texts: list[str | None], rows: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(the sum of the trigrams' vectors of the texts of each of ``n`` rows, whether a row has any).

    A trigram is a letter and what stands beside it, so a long text is taken in windows of ``GROUP``
    characters, and of a window ``BLOCK`` different trigrams at once: memory is bounded whatever
    the text's length and the number of its letters. All sums are whole numbers and exact.
    """
    table, out, seen = letters(), np.zeros((n, DIMENSIONS)), np.zeros(n, bool)
    low = [(t or "").lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in low])
    joined, row_of = " " + " ".join(low) + " ", np.array(rows, np.int64)
    for at in range(1, len(joined) - 1, GROUP):
        points = np.frombuffer(joined[at - 1 : at + GROUP + 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        number, letter = table.numbers(points)
        middle = np.flatnonzero(letter[1:-1]) + 1
        if not len(middle):
            continue
        owner = row_of[np.searchsorted(ends, middle + (at - 2), "right")]
        size = len(table.vectors)
        codes = (number[middle - 1].astype(np.int64) * size + number[middle]) * size + number[middle + 1]
        known, which = np.unique(codes, return_inverse=True)
        order = np.argsort(which)
        owner, which = owner[order], which[order]
        cuts = np.searchsorted(which, np.arange(0, len(known) + BLOCK, BLOCK))
        for k, (p, q) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            block = known[k * BLOCK : (k + 1) * BLOCK]
            counts = np.bincount(owner[p:q] * len(block) + which[p:q] - k * BLOCK, minlength=n * len(block)).reshape(n, len(block))
            out += counts.astype(np.float32) @ table.bind((block // (size * size), block // size % size, block % size))
        seen[owner] = True
    return out, seen


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages in order, a unit vector for each) from rows with a language. The driver gets a
    vector a language: the column holds names of languages, not free text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, stop in groups(texts):
                names = sorted(set(langs[at:stop]))
                found, _ = bundles(texts[at:stop], [names.index(x) for x in langs[at:stop]], len(names))
                for name, bundle in zip(names, found, strict=True):
                    sums[name] = sums.get(name, 0) + bundle
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "bundle"])

    ship(docs.sparkSession)
    learned = docs.where(F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string"))
    parts = learned.mapInArrow(run, "lang string, bundle array<double>").select("lang", F.posexplode("bundle").alias("place", "x"))
    found = parts.groupBy("lang", "place").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v"))
    rows = sorted((r.lang, [p.x for p in r.v]) for r in found.collect())
    rows = [r for r in rows if any(r[1])]
    matrix = np.array([v for _, v in rows]).reshape(len(rows), DIMENSIONS)
    return [name for name, _ in rows], (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).astype(np.float32) if rows else matrix.astype(np.float32)


def identify(docs: DataFrame, names: list[str], profiles: np.ndarray, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, lang_pred, score) of each row; score: the cosine, 0 where it is negative."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(len(keys)).to_pylist()
        langs, scores = [], []
        for at, stop in groups(texts):
            found, seen = bundles(texts[at:stop], list(range(stop - at)), stop - at)
            lengths = np.linalg.norm(found, axis=1)
            cosines = found @ profiles.T / np.maximum(lengths, 1e-9)[:, None]
            for k in range(stop - at):
                if not names or not seen[k]:
                    langs.append("und")
                    scores.append(0.0)
                else:
                    best = int(np.argmax(cosines[k]))
                    langs.append(names[best])
                    scores.append(float(min(1.0, max(0.0, cosines[k, best]))))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keys, "lang_pred", "score"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return map_arrow(docs.select(*keys, F.col(text).cast("string").alias("__text")), each, f"{kinds}, lang_pred string, score double")


def held_out(doc: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(crc_bucket(doc, modulus) == remainder, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    names, profiles = prototypes(docs.where(~F.col("held_out")))
    return identify(docs, names, profiles, ["doc_id", "held_out"])
