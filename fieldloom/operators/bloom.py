"""A Bloom filter of key columns, for key sets too large to broadcast.

Keys set bits of one array of fixed size; words of it are OR-merged by partial aggregates, so a
task sends at most one row a word, and the array (at most 16 MB) reaches the tasks as a
scalar subquery.  Rows whose keys are certainly not among the set leave before their shuffle; an
exact join must follow, since others may pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.schema import col

HASHES = 5
BITS_PER_KEY = 10
MIN_BITS, MAX_BITS = 1 << 16, 1 << 27
# With fewer bits a key than this about half of all other keys would pass.
FEWEST_BITS_PER_KEY = 2.5


def filter_bits(n_keys: int) -> int | None:
    """The filter's size, a power of two; None where it would let too much pass."""
    if n_keys * FEWEST_BITS_PER_KEY > MAX_BITS:
        return None
    bits = MIN_BITS
    while bits < min(n_keys * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    return bits


def _positions(keys: Sequence[str], bits: int) -> list[Column]:
    """The bits of a key, by double hashing."""
    h = F.xxhash64(*[col(k) for k in keys])
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + high * i).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def bloom_filter(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """One row: the filter's words as an array of longs.  Keys with a null part are left out."""
    held = df.select(*[col(k) for k in keys]).na.drop()
    at = held.select(F.explode(F.array(*_positions(keys, bits))).alias("at"))
    set_bits = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("v"))
    empty = df.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("v"))
    words = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("v").alias("v"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "v"))).alias("w")).select(F.col("w.v").alias("words"))


def might_contain(words: Column, keys: Sequence[str], bits: int) -> Column:
    """Whether keys may be in the filter; false where a part is null."""
    out = F.lit(True)
    for k in keys:
        out = out & col(k).isNotNull()
    for at in _positions(keys, bits):
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        out = out & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def comparable(left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str]) -> bool:
    """Whether equal keys of both sides have equal hashes: like types, none of them floating."""
    types = [[f.dataType for f in df.select(*[col(k) for k in keys]).schema.fields] for df, keys in ((left, left_keys), (right, right_keys))]
    return types[0] == types[1] and not any(isinstance(t, T.FloatType | T.DoubleType) for t in types[0])


def maybe_among(df: DataFrame, keys: Sequence[str], among: DataFrame, among_keys: Sequence[str], n_keys: int) -> DataFrame:
    """The rows of ``df`` whose keys may be among those of ``among``, which has been made once and
    holds ``n_keys`` keys: all that are, and few others.  ``df`` itself where no filter would help."""
    bits = filter_bits(n_keys)
    if bits is None or not comparable(df, keys, among, among_keys):
        return df
    return df.where(might_contain(bloom_filter(among, among_keys, bits).scalar(), keys, bits))
