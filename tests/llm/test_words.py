import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import words as W
from fieldloom.llm.shared import map_arrow

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b\x85\xa0z09-ß日", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, size):
    for table, pattern in ((W.BETWEEN_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        found, hashes = [], {}
        for first, stop, words, data in W.chunks(pa.array(texts, pa.string()), table, W.FOLDED, size):
            for p, q in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                found.append([bytes(data[s:e]).decode() for s, e in zip(words.starts[p:q], words.ends[p:q], strict=True)])
                for w, h in zip(found[-1], words.hashes[p:q].tolist(), strict=True):
                    low = "".join(c.lower() if c.isascii() else c for c in w)
                    assert hashes.setdefault(low, h) == h
        assert found == [re.findall(pattern, t or "") for t in texts]
        assert len(set(hashes.values())) == len(hashes)


def test_rolling_and_prefix_hashes():
    text = "abcd abcde xabcd abcd abcde xabcd é"
    (first, stop, words, data), = W.chunks(pa.array([text]), W.BETWEEN_SPACE, W.EXACT)
    runs = W.rolling(words.hashes, 3)
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 4
    assert len(W.rolling(words.hashes[:2], 3)) == 0
    hashes, which = W.prefix_hashes(data, words, W.EXACT, 4)
    assert which.tolist() == [0, 1, 2, 3, 4, 5]
    assert hashes[0] == hashes[1] == hashes[3] != hashes[2]
    assert not set(hashes.tolist()) & set(words.hashes.tolist())
    assert np.array_equal(W.text_bytes(pa.array([None, "ab"]))[1], [0, 0, 2])


def test_batches_to_python_are_bounded(spark):
    """6,000 rows of 2 kB in one partition come in batches of a few MB, or as the session says."""
    rows = spark.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("t"))

    def each(batch):
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    def sizes():
        found = map_arrow(rows, each, "n long, size long").collect()
        assert sum(r.n for r in found) == 6000
        return max(r.size for r in found)

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    assert sizes() < 6e6
    spark.conf.set(key, "1m")
    try:
        assert sizes() < 2e6
    finally:
        spark.conf.unset(key)
