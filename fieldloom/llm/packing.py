"""Packing by concatenate and cut.

Method: every document is tokenized once and its ids are written, partition by partition, to the
shared folder. The first pass sums the tokens of each partition; a prefix sum over these totals
(one number a partition reaches the driver) gives each partition its global offset. The second
pass walks each partition from its offset and cuts at multiples of ``length``: a document that
crosses a boundary gives one record on each side. Every sequence is full but the last, so padding
is less than one sequence in the whole corpus. No shuffle.

Tokenizing goes word by word through a bounded cache where the tokenizer drops white space, ignores
case and never joins what white space parts: a text's ids are then those of its words in a row.
Probe texts decide that when its file is read; any other tokenizer takes whole texts.

Results in odd cases: null and empty texts are just the end id; a document of any length is cut
whole; repeated rows are packed each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, read, ship

#: Words in the cache of one task, in each of two generations.
CACHE_WORDS = 150_000
#: Texts by which a tokenizer is tried: word for word it must give the ids of the whole.
PROBES = (
    "One  two\tTHREE\nfour.", " lead and trail ", "don't stop, re-do it! (a_b) 12,345.67%", "Stra\u00dfe \u00c9t\u00e9 \u65e5\u672c \u0130 \u01c5",
    "x\u00a0y\u2003z \x1c q", "mixedCase ABCdef end;", "a<b>c </s> [INST]",
)
#: How byte-level tokenizers write bytes: printable ones as themselves, the rest from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHER = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_LEVEL = "".join(chr(b if b in _PRINTABLE else 256 + _OTHER.index(b)) for b in range(256))
#: Marks that no rule of a tokenizer joins with a letter before them.
_MARKS = b'!"#$%&()*+,-./:;=?@[\\]^_`{|}~'


class WordEncoder(dict):
    """The ids of texts by a tokenizer: a cache from word to packed ids where words can be taken alone."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.older: dict[bytes, bytes] = {}
        self.by_word = all(self._by_words(t) == self._plain(t) for t in PROBES)

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def __missing__(self, word: bytes) -> bytes:
        """Letters go to the tokenizer's model directly. A letter or digit and the marks that end a
        word are taken apart, since the tokenizer parts them too."""
        known = self.older.get(word)
        if known is not None:
            self[word] = known
            return known
        low = word.lower()  # of ASCII letters
        if low != word and low.isascii():
            found = self[low]
        elif word.isalpha():
            found = self._packed(word.decode())
        elif (head := word.rstrip(_MARKS)) and head != word and head.decode()[-1].isalnum():
            found = self[head] + self[word[len(head) :]]
        else:
            text = word.decode()
            folded = text.lower()
            if text.isalpha() and max(folded) < "\u02b0" and len(folded) == len(text):  # composed, lower case one to one
                found = self._packed(folded.encode().decode("latin-1").translate(_BYTE_LEVEL))
            else:
                found = self._plain(text)
        self[word] = found
        return found

    def _plain(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _packed(self, letters: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _by_words(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))  # at ASCII white space

    def encode(self, text: str | None) -> bytes:
        """The text's ids as integers of ``kind``."""
        if len(self) > CACHE_WORDS:  # words of the last generation that come again are taken over
            self.older = dict(self)
            self.clear()
        return self._by_words(text or "") if self.by_word else self._plain(text or "")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One tokenizer for each path and Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _tokenized(docs: DataFrame, doc: str, text: str, path: str, end_id: int) -> DataFrame:
    """(doc, ids): the packed ids of each document with its end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        end = np.array([end_id], words.kind).tobytes()
        try:
            for batch in batches:
                ids = [words.encode(x.as_py()) + end for x in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc", "ids"])
        finally:
            words.forget()  # the worker may go on with other work

    ship(docs.sparkSession)
    kind = docs.schema[doc].dataType.simpleString()
    return docs.select(F.col(doc).alias("doc"), F.col(text)).mapInArrow(run, f"doc {kind}, ids binary")


def cuts(offset: int, tokens: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(sequence, place in it, start in the document, tokens) of the pieces of a document whose
    first token is the corpus's token number ``offset``."""
    start = 0
    while start < tokens:
        place = (offset + start) % length
        take = min(length - place, tokens - start)
        yield (offset + start) // length, place, start, take
        start += take


def _pieces(
    docs: DataFrame, tokenizer: str, end_id: int, length: int, doc: str, text: str, name: str, spark_kind: str,
    content: Callable[[list[np.ndarray]], pa.Array],
) -> DataFrame:
    """The pieces, what they hold told by ``content`` as the column ``name``."""
    rows = cut(_tokenized(docs, doc, text, tokenizer, end_id))
    width = encoder(tokenizer).kind.itemsize
    kind = np.dtype(f"<u{width}")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(int(b.column(0).to_numpy().sum()) for b in batches)
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "n": pa.array([n], pa.int64())})

    sizes = rows.select(F.octet_length("ids").cast("long").alias("bytes")).mapInArrow(total, "part int, n long").collect()
    before, offsets = 0, {}
    for row in sorted(sizes, key=lambda r: r.part):
        offsets[row.part] = before
        before += row.n // width

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = offsets[TaskContext.get().partitionId()]
        for batch in batches:
            source, starts, lengths, tokens, sequences, places, pieces = [], [], [], [], [], [], []
            for k, data in enumerate(batch.column(1)):
                ids = np.frombuffer(data.as_buffer(), kind)
                for sequence, place, start, take in cuts(at, len(ids), length):
                    source.append(k)
                    starts.append(start)
                    lengths.append(take)
                    tokens.append(len(ids))
                    sequences.append(sequence)
                    places.append(place)
                    pieces.append(ids[start : start + take])
                at += len(ids)
            numbers = [pa.array(x, pa.int64()) for x in (starts, lengths)], [pa.array(x, pa.int64()) for x in (tokens, sequences, places)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), *numbers[0], content(pieces), *numbers[1]],
                names=["doc", "start", "length", name, "doc_tokens", "sequence_id", "offset"],
            )

    doc_kind = docs.schema[doc].dataType.simpleString()
    return rows.mapInArrow(cut_up, f"doc {doc_kind}, start long, length long, {name} {spark_kind}, doc_tokens long, sequence_id long, offset long")


def _whole(pieces: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, np.concatenate(pieces).astype(np.int32)) if pieces else pa.array([], pa.list_(pa.int32()))


def _summed(pieces: list[np.ndarray]) -> pa.Array:
    return pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64())


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 4096, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, start, length, ids, doc_tokens, sequence_id, offset): a row for each piece, ``ids`` as
    an array of ints. Sequence ``s`` is its pieces by ``offset``; only the last may be short, to be
    padded to ``length`` unless it ends at a power of two."""
    return _pieces(docs, tokenizer, end_id, length, doc, text, "ids", "array<int>", _whole)


def pack_digests(docs: DataFrame, tokenizer: str, end_id: int, length: int = 4096, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``pack`` with ``ids_crc32``, the crc32 of a piece's ids as little-endian unsigned
    32-bit numbers, instead of the ids: what was cut is summed where it lies."""
    return _pieces(docs, tokenizer, end_id, length, doc, text, "ids_crc32", "long", _summed)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, its ids as their crc32."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_digests(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2).withColumnRenamed("doc", "doc_id")
