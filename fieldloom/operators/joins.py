"""Join chains driven by specs, size-checked lookups and small-from-large updates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.bloom import maybe_among
from fieldloom.operators.pivots import Aggregate, pivot_wide
from fieldloom.operators.schema import col, folding, has_column, restore_schema
from fieldloom.operators.sizing import fits_broadcast, measure, settled, spark_broadcasts
from fieldloom.operators.skew import HOT_ROWS, SALTED_TYPES, skew_join

# Names Spark accepts for a join type, each with the form used below.
JOIN_TYPES = {
    "inner": "inner",
    "cross": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "outer": "full",
    "full": "full",
    "fullouter": "full",
    "semi": "semi",
    "leftsemi": "semi",
    "anti": "anti",
    "leftanti": "anti",
}

DEFAULT_JOIN_COLUMN = "default"
STRATEGIES = ("plain", "lookup", "split")


def join_type(name: str | None) -> str:
    """Normalise a join type name; every join here carries an equality condition."""
    how = JOIN_TYPES.get((name or "inner").lower().replace("_", ""))
    if how is None:
        raise ValueError(f"unknown join type: {name!r}")
    return how


@dataclass(frozen=True)
class JoinSpec:
    """How one table is optionally pivoted and then joined to the running result.

    ``columns`` are right-hand columns that must *all* equal the one base column,
    or ``(left, right)`` pairs for a composite key.  ``lookup`` marks a side
    expected to be small and unique on its key: it is broadcast when its measured
    size allows and joined on a salted key otherwise.
    """

    table: DataFrame
    columns: Sequence[str | tuple[str, str]] = ()
    how: str | None = "inner"
    group_by: Sequence[str] = ()
    pivot: str | None = None
    value: str | None = None
    agg: Aggregate | str | None = None
    values: Sequence[str | None] | None = None
    order_by: str | None = None
    matched_only: bool = False
    prefix: str = ""
    max_values: int | None = None
    strategy: str = "plain"

    def prepared(self) -> DataFrame:
        if self.table is None:
            raise ValueError("a join spec needs a table")
        if not (self.pivot and self.value):
            return self.table
        if not self.group_by:
            raise ValueError(f"group_by cannot be empty for a pivot on {self.pivot!r}")
        return pivot_wide(
            self.table,
            self.group_by,
            self.pivot,
            self.value,
            values=self.values,
            agg=self.agg,
            order_by=self.order_by,
            matched_only=self.matched_only,
            prefix=self.prefix,
            max_values=self.max_values,
        )


def _key_pairs(spec: JoinSpec, on: str | None) -> list[tuple[str, str]]:
    pairs = []
    for entry in spec.columns or (DEFAULT_JOIN_COLUMN,):
        if isinstance(entry, tuple):
            pairs.append(entry)
        elif on is None:
            raise ValueError("a base join column is required unless pairs are given")
        else:
            pairs.append((on, entry))
    return pairs


def join_on_pairs(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str | None = "inner",
    strategy: str = "plain",
    limit_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
    size_bytes: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on (left, right) column pairs, keeping one column per shared key name.

    The last four arguments are those of ``lookup_join``.
    """
    fold, how = folding(left.sparkSession), join_type(how)
    for side, names in ((left, [p[0] for p in pairs]), (right, [p[1] for p in pairs])):
        missing = [n for n in names if not has_column(side, n)]
        if missing:
            raise ValueError(f"join columns {missing} not found among {side.columns}")

    left_names = {fold(c): c for c in left.columns}
    same_key = {fold(r) for k, r in pairs if fold(k) == fold(r)}
    shared = [c for c in right.columns if fold(c) in left_names]
    clashes = [c for c in shared if fold(c) not in same_key]
    if clashes and how not in ("semi", "anti"):
        raise ValueError(f"columns on both sides would be ambiguous: {clashes}")

    # Shared key names travel under a temporary name so the condition is unambiguous.
    temporary = {c: f"__right_{c}" for c in shared}
    right = right.withColumnsRenamed(temporary)
    by_fold = {fold(c): t for c, t in temporary.items()}
    renamed = [(lk, by_fold.get(fold(rk), rk)) for lk, rk in pairs]

    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy == "plain" or how not in SALTED_TYPES:
        joined = left.join(right, _condition(renamed), how)
    else:
        limit_bytes = 0 if strategy == "split" else limit_bytes
        joined = _lookup(left, right, renamed, how, limit_bytes, hot_rows, size_bytes, keys_from)

    if how in ("semi", "anti"):
        return joined
    if how in ("right", "full"):
        joined = joined.withColumns(
            {
                left_names[fold(c)]: F.coalesce(col(left_names[fold(c)]), col(t))
                for c, t in temporary.items()
            }
        )
    return joined.drop(*temporary.values())


def _condition(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(and_, [col(a) == col(b) for a, b in pairs])


def _lookup(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    limit_bytes: int | None,
    hot_rows: int,
    size_bytes: int | None,
    keys_from: DataFrame | None,
) -> DataFrame:
    if how in ("semi", "anti"):
        right = right.select(*[col(r) for _, r in pairs])
    if limit_bytes is None and size_bytes is None and spark_broadcasts(right):
        return left.join(right, _condition(pairs), how)
    if fits_broadcast(right, limit_bytes, size_bytes):
        return left.join(F.broadcast(right), _condition(pairs), how)
    return skew_join(left, right, pairs, how, hot_rows, keys_from)


def lookup_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "left",
    limit_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
    size_bytes: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Attach a dimension by ``key``, which both sides have, without a hot-key task.

    Up to ``limit_bytes`` (0: never) the dimension is broadcast and the fact side not
    shuffled at all; beyond it, keys of the fact side with more than ``hot_rows`` rows
    are split.  The dimension is measured unless ``size_bytes`` is given.  Hot keys are
    counted on ``keys_from``, a narrow table with the key column, where there is one.
    """
    how = join_type(how)
    if how not in SALTED_TYPES:
        raise ValueError(f"lookup_join supports {SALTED_TYPES}, not {how!r}")
    return join_on_pairs(
        fact, dimension, [(key, key)], how, "lookup", limit_bytes, hot_rows, size_bytes, keys_from
    )


def join_chain(base: DataFrame, specs: Sequence[JoinSpec], on: str | None = None) -> DataFrame:
    """Fold the specs over ``base``: pivot where asked, then equi-join."""
    return reduce(
        lambda left, spec: join_on_pairs(
            left, spec.prepared(), _key_pairs(spec, on), spec.how, spec.strategy
        ),
        specs,
        base,
    )


def update_from(
    small: DataFrame,
    large: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    latest_by: str | None = None,
    limit_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, list[str]]:
    """Refresh ``columns`` of ``small`` from ``large``; also returns the names skipped.

    Each updated column is the large side's value, or the small side's where that is
    null or absent.  A column that either side lacks is skipped.  The result has small's
    schema and rows.  ``large`` must hold one row per key of ``small``; with ``latest_by``
    the row with the greatest value of that column is used instead.

    Rows of ``large`` that cannot match leave before any shuffle: by a broadcast of
    small's keys, or beyond ``limit_bytes`` by a Bloom filter of them.
    """
    if not keys:
        raise ValueError("join columns required")
    found = [c for c in columns if has_column(large, c) and has_column(small, c)]
    skipped = [c for c in columns if c not in found]
    if not found:
        return small, skipped

    # The keys of small, each with its rows, are made once: their size, the filter and the hot
    # keys all come from them.
    counted = settled(small.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n")))
    n_keys, size = measure(counted)
    small_keys = counted.select(*[col(k) for k in keys])
    # Only rows that can match are kept before anything is shuffled on the key.
    needed = large.select(*[col(c) for c in dict.fromkeys([*keys, *found, *filter(None, [latest_by])])])
    if fits_broadcast(small_keys, limit_bytes, size):
        needed = needed.join(F.broadcast(small_keys), list(keys), "left_semi")
    else:
        needed = maybe_among(needed, list(keys), small_keys, list(keys), n_keys)

    incoming = F.struct(*[col(c).alias(f"v{i}") for i, c in enumerate(found)])
    fresh = needed.groupBy(*[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        (F.max_by(incoming, col(latest_by)) if latest_by else F.first(incoming)).alias("__new"),
        (F.lit(1) if latest_by else F.count(F.lit(1))).alias("__rows"),
    )
    # One row per key on this side, so only a hot key of small could overload a task.
    pairs = [(k, f"__key_{i}") for i, k in enumerate(keys)]
    joined = skew_join(small, fresh, pairs, "left", hot_rows, keys_from=counted, rows="__n")
    repeated = F.raise_error(F.lit("update_from: the large side repeats a key"))
    new = F.when(F.col("__rows") > 1, repeated).otherwise(F.col("__new"))
    fold = folding(small.sparkSession)
    by_name = {fold(c): c for c in small.columns}
    updates = {
        by_name[fold(c)]: F.coalesce(new.getField(f"v{i}"), col(by_name[fold(c)]))
        for i, c in enumerate(found)
    }
    return restore_schema(joined.withColumns(updates), small), skipped
