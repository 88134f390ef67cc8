"""Upsert and append on lake tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fieldloom.operators.schema import col
from fieldloom.operators.sizing import fits_broadcast, settled


LOSS_DDL = "column_name string, n_lost long"
ON_LOSS = ("fail", "warn", "keep")
# Marks a column of a source row whose stored value stays.
KEPT = "__kept_"


def dedupe(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], descending: bool = True
) -> DataFrame:
    """One row per key: the one that comes first by ``order_by``, then by the other columns
    that can be ordered, so that ties are decided alike in every branch of a plan.

    Aggregates map-side before the shuffle, so a hot key costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    orderable = [
        f.name for f in df.schema.fields
        if f.name in rest and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
    order = F.struct(*[col(c) for c in dict.fromkeys([*order_by, *orderable])])
    pick = F.max_by if descending else F.min_by
    return (
        df.groupBy(*[col(k) for k in keys])
        .agg(pick(F.struct(*[col(c) for c in rest]), order).alias("__row"))
        .select(*[col(k) for k in keys], "__row.*")
        .select(*[col(c) for c in df.columns])
    )


def _once(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``incoming`` with a column that fails the job at a key of several rows.

    Counted by the key, which is how the merge that follows needs the rows anyway.
    """
    named = [F.col(k) for k in keys]
    rest = [c for c in incoming.columns if c not in keys]
    row = F.first(F.struct(*[col(c) for c in rest])) if rest else F.lit(None)
    counted = incoming.groupBy(*named).agg(row.alias("__row"), F.count(F.lit(1)).alias("__n"))
    message = F.concat(F.lit("the source repeats keys, e.g. "), F.to_json(F.struct(*named)))
    once = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.select(*named, *[F.col("__row").getField(c).alias(c) for c in rest], once.alias("__incoming"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
    unique: str = "check",
    small_source: bool = False,
    limit_bytes: int | None = None,
) -> DataFrame:
    """``target`` after inserting source's new keys and overwriting known ones.

    ``columns`` (default: all the source has) are written, also with null; other
    target columns keep their value, and on insert get ``defaults`` or null.  Values
    are cast to target's types.  Source keys must be unique: with ``unique="check"`` the job
    that reads the result fails otherwise, ``"assume"`` trusts the caller (see ``dedupe``).  With
    ``small_source`` the source is measured and, if it fits, broadcast, so the target
    is not shuffled at all.
    """
    if not keys:
        raise ValueError("key columns required")
    if unique not in ("check", "assume"):
        raise ValueError(f"unique must be 'check' or 'assume', not {unique!r}")
    marks = [c for c in source.columns if c.startswith(KEPT)]
    written = [c for c in columns or source.columns if c not in keys and c not in marks]
    unknown = [c for c in [*keys, *written] if c not in target.columns]
    absent = [c for c in [*keys, *written] if c not in source.columns]
    if unknown or absent:
        raise ValueError(f"columns not in target: {unknown}, not in source: {absent}")
    defaults = defaults or {}
    types = {f.name: f.dataType for f in target.schema.fields}
    incoming = source.select(
        *[col(k).cast(types[k]).alias(f"__key_{i}") for i, k in enumerate(keys)],
        *[col(c).cast(types[c]).alias(f"__new_{i}") for i, c in enumerate(written)],
        *[col(c) for c in marks],
    )
    named = [f"__key_{i}" for i in range(len(keys))]
    incoming = _once(incoming, named) if unique == "check" else incoming.withColumn("__incoming", F.lit(True))
    same_key = reduce(and_, [col(k) == F.col(f"__key_{i}") for i, k in enumerate(keys)])
    position = {c: i for i, c in enumerate(written)}

    def merged(c: str, inserting: Column, arriving: Column) -> Column:
        if c in keys:
            value = F.when(inserting, F.col(f"__key_{list(keys).index(c)}")).otherwise(col(c))
        elif c in position:
            writes = arriving & ~F.coalesce(F.col(KEPT + c), F.lit(False)) if KEPT + c in marks else arriving
            value = F.when(writes, F.col(f"__new_{position[c]}")).otherwise(col(c))
        elif c in defaults:
            value = F.when(inserting, F.lit(defaults[c]).cast(types[c])).otherwise(col(c))
        else:
            value = col(c)
        return value.alias(c)

    arriving = F.col("__incoming").isNotNull()
    if small_source and fits_broadcast(incoming, limit_bytes):
        incoming = settled(incoming)  # read by three branches of the plan
        updated = target.join(F.broadcast(incoming), same_key, "left").select(
            *[merged(c, F.lit(False), arriving) for c in target.columns]
        )
        # The keys of target that the source updates are no more than the source's.
        source_keys = incoming.select(*[f"__key_{i}" for i in range(len(keys))])
        hit = target.select(*[col(k) for k in keys]).join(
            F.broadcast(source_keys), same_key, "left_semi"
        ).distinct()
        inserted = incoming.where("__incoming").join(hit, same_key, "left_anti").select(
            *[
                (F.col(f"__key_{list(keys).index(c)}") if c in keys
                 else F.col(f"__new_{position[c]}") if c in position
                 else F.lit(defaults.get(c)).cast(types[c])).alias(c)
                for c in target.columns
            ]
        )
        return updated.unionByName(inserted)

    existing = target.withColumn("__existing", F.lit(True))
    return existing.join(incoming, same_key, "full").select(
        *[merged(c, F.col("__existing").isNull(), arriving) for c in target.columns]
    )


def _lossy_casts(source: DataFrame, target: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType for f in target.schema.fields}
    return {
        f.name: col(f.name).try_cast(types[f.name]) for f in source.schema.fields
        if f.name in types and f.dataType != types[f.name]
    }


def cast_losses(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source with shared columns cast to target's types, and per column what that lost.

    A value that cannot be cast becomes null; the report counts those.
    """
    casts = _lossy_casts(source, target)
    if not casts:
        return source, source.sparkSession.createDataFrame([], LOSS_DDL)
    losses = source.agg(
        *[F.count_if(col(c).isNotNull() & casts[c].isNull()).alias(c) for c in casts]
    )
    entries = [F.struct(F.lit(c).alias("column_name"), col(c).alias("n_lost")) for c in casts]
    report = losses.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    return source.withColumns(casts), report


def cast_checked(
    source: DataFrame, target: DataFrame, on_loss: str = "fail"
) -> tuple[DataFrame, Observation | None]:
    """Source in target's types, with a policy for values that do not fit theirs.

    ``fail`` stops the job that writes the rows at the first such value; ``warn`` makes it
    null; ``keep`` marks the row's column so that ``upsert`` leaves the stored value: column
    ``__kept_<name>`` is true there.  The last two count per column, in the pass that writes:
    read the observation after the action.
    """
    if on_loss not in ON_LOSS:
        raise ValueError(f"on_loss must be one of {ON_LOSS}, not {on_loss!r}")
    casts = _lossy_casts(source, target)
    if not casts:
        return source, None
    lost = {c: col(c).isNotNull() & casts[c].isNull() for c in casts}
    if on_loss == "fail":
        shown = {
            c: F.concat(F.lit(f"a value of {c} does not fit its type: "), F.substring(col(c).cast("string"), 1, 80))
            for c in casts
        }
        return source.withColumns({c: F.when(lost[c], F.raise_error(shown[c])).otherwise(casts[c]) for c in casts}), None
    counted = Observation()
    marked = source.observe(counted, *[F.count_if(lost[c]).alias(c) for c in casts])
    kept = {KEPT + c: lost[c] for c in casts} if on_loss == "keep" else {}
    return marked.withColumns(kept).withColumns(casts), counted


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` followed by ``source``, matched by name, in target's types."""
    types = {f.name: f.dataType for f in target.schema.fields}
    extra = [c for c in source.columns if c not in types]
    if extra:
        raise ValueError(f"columns not in target: {extra}")
    aligned = source.select(*[col(c).cast(types[c]).alias(c) for c in source.columns])
    return target.unionByName(aligned, allowMissingColumns=True)


def append(source: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to a stored table without reading it."""
    source.write.format(fmt).mode("append").save(path)


def merge_into(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> None:
    """Upsert through the catalog's own MERGE, where the table's format supports it."""
    written = [c for c in columns or source.columns if c not in keys]
    source = source.alias("s")
    values = {c: F.col(f"s.{c}") for c in [*keys, *written]}
    on = reduce(and_, [F.col(f"{table}.{k}") == F.col(f"s.{k}") for k in keys])
    merge = source.mergeInto(table, on)
    if written:
        merge = merge.whenMatched().update({c: values[c] for c in written})
    fill = {c: F.lit(v) for c, v in (defaults or {}).items() if c not in values}
    merge.whenNotMatched().insert(values | fill).merge()
