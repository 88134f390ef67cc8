"""Long-to-wide pivots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.schema import col
from fieldloom.operators.sizing import settled

Aggregate = Callable[[Column], Column]

# Aggregates that ignore nulls, so a conditional aggregate equals one over the matching rows.
NULL_IGNORING: dict[str, Aggregate] = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def pivot_values(df: DataFrame, name: str) -> DataFrame:
    """The distinct values of the pivot column, null included."""
    return df.select(col(name)).distinct()


def discover_values(df: DataFrame, name: str, limit: int | None = None) -> list:
    """Sorted pivot values on the driver, nulls first; refuses more than ``limit``, by default
    the session's ``spark.sql.pivotMaxValues``."""
    if limit is None:
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = pivot_values(df, name).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct values in pivot column {name!r}")
    found = [r[0] for r in rows]
    return [None] * (None in found) + sorted(v for v in found if v is not None)


def _label(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return "null" if value is None else str(value)


def pivot_wide(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    values: Sequence | None = None,
    agg: Aggregate | str | None = None,
    order_by: str | None = None,
    matched_only: bool = False,
    prefix: str = "",
    max_values: int | None = None,
) -> DataFrame:
    """One row per key, one column per value of ``name``, cells aggregated from ``value``.

    The default aggregate is the first non-null value, which is single-valued when
    (keys, name) is unique; give ``order_by`` to make it the value with the smallest
    ``order_by`` otherwise.  ``agg`` replaces it: a name in ``NULL_IGNORING`` or any
    aggregate, which then sees the rows of its cell alone, as in Spark's own pivot; a
    cell with no input rows is null.  The form never depends on the number of columns.
    Passing ``values`` avoids the job that looks them up (at most ``max_values``).
    ``matched_only`` drops rows, and so keys, outside ``values`` before the shuffle,
    which loses nothing when the result is the right side of a left join.
    """
    if not keys:
        raise ValueError(f"keys cannot be empty for a pivot on {name!r}")
    wanted = discover_values(df, name, max_values) if values is None else list(dict.fromkeys(values))
    known = [v for v in wanted if v is not None]
    if matched_only:
        matches = col(name).isin(known) if known else F.lit(False)
        df = df.where(matches | col(name).isNull() if None in wanted else matches)

    grouped = df.groupBy(*[col(k) for k in keys])
    labels = [prefix + _label(v) for v in wanted]
    if not wanted:
        return grouped.agg(F.count(F.lit(1)).alias("__n")).drop("__n")
    if isinstance(agg, str) and agg not in NULL_IGNORING:
        raise ValueError(f"aggregates by name are {sorted(NULL_IGNORING)}, not {agg!r}")
    whole = _aggregate(col(value), order_by, agg)
    # Spark pivots variable-width results in one step, fixed-width ones in two with a shuffle
    # each; a conditional aggregate takes one step for both, where it means the same.
    if callable(agg) or isinstance(
        grouped.agg(whole.alias("v")).schema["v"].dataType,
        T.StringType | T.BinaryType | T.ArrayType | T.MapType | T.StructType,
    ):
        return grouped.pivot(name, wanted).agg(whole).toDF(*keys, *labels)

    def cell(v) -> Column:
        here = col(name).isNull() if v is None else col(name) == F.lit(v)
        result = _aggregate(F.when(here, col(value)), order_by, agg)
        # A count over no rows is not null on its own.
        return result if agg is None else F.when(F.bool_or(here), result)

    return grouped.agg(*[cell(v).alias(label) for v, label in zip(wanted, labels)])


def pivot_one_pass(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    prefix: str = "",
    max_values: int | None = None,
) -> DataFrame:
    """``pivot_wide`` without values given, and without reading ``df`` twice to find them.

    First non-null values are aggregated per key and name, then gathered in one map a key, which
    is made once: the names are its keys, and the columns a projection.  A group holds
    an entry for each name, however many rows it has.  Suits some hundred names; for
    thousands, look the values up first, since a map is searched entry by entry.
    """
    if not keys:
        raise ValueError(f"keys cannot be empty for a pivot on {name!r}")
    named = [col(k) for k in keys]
    cells = df.groupBy(*named, col(name).alias("__name")).agg(F.first(col(value), ignorenulls=True).alias("__cell"))
    # Map keys cannot be null, so names are wrapped.
    entry = F.struct(F.struct("__name").alias("k"), F.col("__cell").alias("v"))
    rows = settled(cells.groupBy(*named).agg(F.map_from_entries(F.collect_list(entry)).alias("__cells")))
    held = rows.select(F.explode(F.map_keys("__cells")).alias("k")).select("k.__name")
    wanted = discover_values(held, "__name", max_values)

    def cell(v) -> Column:
        wrapped = F.struct(F.lit(v).cast(df.schema[name].dataType).alias("__name"))
        return F.try_element_at(F.col("__cells"), wrapped).alias(prefix + _label(v))

    return rows.select(*named, *[cell(v) for v in wanted])


def _aggregate(cell: Column, order_by: str | None, agg: Aggregate | str | None) -> Column:
    if agg is not None:
        return (NULL_IGNORING[agg] if isinstance(agg, str) else agg)(cell)
    if order_by is not None:
        return F.min_by(cell, F.when(cell.isNotNull(), col(order_by)))
    return F.first(cell, ignorenulls=True)
