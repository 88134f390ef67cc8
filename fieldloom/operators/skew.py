"""Equi-joins that spread hot keys over several tasks."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.schema import col

# A key with more rows than this is split.
HOT_ROWS = 1_000_000
# Most sub-keys one key is split into.
MAX_SALTS = 1024
# Most hot keys that reach the driver: the hottest ones.
REPORTED_KEYS = 10_000

SALTED_TYPES = ("inner", "left", "semi", "anti")


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, rows: str | None = None
) -> list[tuple[int, int]]:
    """(key hash, rows) of keys with more than ``hot_rows`` rows, the hottest first.

    Counted exactly, by partial sums that are shuffled by key; only hot keys leave that
    step, and a table of n rows has no more than n / ``hot_rows`` of them.  ``df`` may have been
    counted already: then ``rows`` is the column with the rows of its key.
    """
    h = F.xxhash64(*[col(k) for k in keys]).alias("h")
    if rows is None:
        counted = df.select(h).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    else:
        counted = df.where(col(rows) > hot_rows).select(h, col(rows).alias("n"))
    top = counted.orderBy(F.col("n").desc(), "h").limit(REPORTED_KEYS)
    return [(r["h"], r["n"]) for r in top.collect()]


def _key_types(df: DataFrame, keys: Sequence[str]) -> list[T.DataType]:
    return [f.dataType for f in df.select(*[col(k) for k in keys]).schema.fields]


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row and its input partition.

    The partition makes identical rows differ; a retried task, which may see its rows
    in another order, still computes the same values.
    """
    fields = [
        f.name for f in df.schema.fields
        if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
    return F.xxhash64(*[col(c) for c in fields], F.spark_partition_id())


def skew_join(
    fact: DataFrame,
    dimension: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    keys_from: DataFrame | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Join on (fact, dimension) column pairs with the fact's hot keys split.

    Hot keys are counted on ``fact``, or on ``keys_from``: a narrower table that holds the
    same key columns in like proportion, so that costly plans of ``fact`` run once; with
    ``rows`` it holds each key once, beside the number of its rows.

    Rows of a hot key are dealt over several sub-keys, and only the dimension rows of
    those keys are repeated, once per sub-key.  Without hot keys this is a plain join.
    Column names of the two sides must differ.
    """
    if how not in SALTED_TYPES:
        raise ValueError(f"skew_join supports {SALTED_TYPES}, not {how!r}")
    if hot_rows < 1:
        raise ValueError("hot_rows must be at least 1")
    fact_keys, dimension_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    condition = reduce(and_, [col(a) == col(b) for a, b in pairs])

    key_types = _key_types(fact, fact_keys)
    # Hashes agree with equality only for like types; Spark's own skew handling remains.
    comparable = key_types == _key_types(dimension, dimension_keys) and not any(
        isinstance(t, T.FloatType | T.DoubleType) for t in key_types
    )
    hot = hot_keys(fact if keys_from is None else keys_from, fact_keys, hot_rows, rows) if comparable else []
    if not hot:
        return fact.join(dimension, condition, how)

    # At most REPORTED_KEYS rows of two numbers, so broadcasting them is safe.
    splits = F.broadcast(
        fact.sparkSession.createDataFrame(
            [(h, min(MAX_SALTS, math.ceil(n / hot_rows))) for h, n in hot],
            "__hot long, __salts int",
        )
    )

    def with_splits(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.join(splits, F.xxhash64(*[col(k) for k in keys]) == F.col("__hot"), "left")

    is_hot = F.col("__salts").isNotNull()
    salt = F.when(is_hot, F.pmod(_row_hash(fact), F.col("__salts")).cast("int")).otherwise(0)
    salted = with_splits(fact, fact_keys).select(
        *[col(c) for c in fact.columns], salt.alias("__salt")
    )
    sub_keys = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    repeated = with_splits(dimension, dimension_keys).select(
        *[col(c) for c in dimension.columns], F.explode(sub_keys).alias("__sub_key")
    )
    return salted.join(
        repeated, condition & (F.col("__salt") == F.col("__sub_key")), how
    ).drop("__salt", "__sub_key")
