"""Incremental enrichment: only items whose rules or data have changed are computed again.

A run leaves fingerprints behind: one per category, of its rules, and one per item, of all that its
result is made from (its row, its links to categories, its attributes and custom fields).  The next
run compares them with its own and restricts every table to the items affected before anything is
pivoted; all other items keep the row of the run before.  The result is that of a full run.

Fingerprints are sums of hashes, so the order of rows never matters and they are made by
one aggregation with partial sums; two different inputs share one with a chance of about 2^-62.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.applying import current_rules
from fieldloom.operators.bloom import maybe_among
from fieldloom.operators.joins import lookup_join
from fieldloom.operators.schema import col
from fieldloom.operators.sizing import fits_broadcast, measure, settled
from fieldloom.plans.pipeline import eav, enriched_rows
from fieldloom.sinks.tables import upsert


class RunState(NamedTuple):
    """What a run is compared by.  The category null stands for the options of the run."""

    categories: DataFrame  # category_id, fingerprint
    items: DataFrame  # item_id, fingerprint


def _hash(*columns: Column) -> Column:
    """A hash that tells which columns are null."""
    return F.xxhash64(*[part for c in columns for part in (c.isNull(), c)])


def _fingerprint(hashed: Column) -> Column:
    """The number of hashes and the sums of their halves, as a text."""
    low = F.sum(hashed.bitwiseAND(F.lit(0x7FFFFFFF)))
    high = F.sum(F.shiftrightunsigned(hashed, 33))
    return F.concat_ws("-", F.count(F.lit(1)), low, high)


def category_fingerprints(
    formulas: DataFrame, options: Mapping[str, object] | None = None, version: str = "formula_id"
) -> DataFrame:
    """(category_id, fingerprint) of the rules that count, and of ``options`` for category null."""
    rules = current_rules(formulas, version)
    by_category = rules.groupBy("category_id").agg(
        _fingerprint(_hash(F.col("field_name"), F.col("formula"))).alias("fingerprint")
    )
    said = repr(sorted((k, repr(v)) for k, v in (options or {}).items()))
    of_run = formulas.sparkSession.range(1).select(
        F.lit(None).cast(rules.schema["category_id"].dataType).alias("category_id"), F.lit(said).alias("fingerprint")
    )
    return by_category.unionByName(of_run)


def item_fingerprints(tables: Mapping[str, DataFrame], target: DataFrame | None = None, key: str = "id") -> DataFrame:
    """(item_id, fingerprint) of all that an item's result is made from.

    ``target`` is the stored item table, where it has more columns than ``tables["item"]``.
    """
    items = tables["item"].withColumnRenamed("item_id", key) if target is None else target
    kinds = (
        ("item", items, key),
        ("category", tables["item_category"], "category_item_id"),
        ("attribute", eav(tables["item_attribute_value"], tables["attribute"], "attribute_id"), "attribute_item_id"),
        ("custom_field", eav(tables["item_custom_field_value"], tables["custom_field"], "custom_field_id"), "custom_field_item_id"),
    )
    hashed = None
    for kind, rows, item in kinds:
        columns = [col(c) for c in sorted(rows.columns)]
        part = rows.select(col(item).alias("item_id"), _hash(F.lit(kind), *columns).alias("h"))
        hashed = part if hashed is None else hashed.unionByName(part)
    return hashed.groupBy("item_id").agg(_fingerprint(F.col("h")).alias("fingerprint"))


def run_state(
    tables: Mapping[str, DataFrame],
    formulas: DataFrame,
    target: DataFrame | None = None,
    options: Mapping[str, object] | None = None,
    version: str = "formula_id",
) -> RunState:
    return RunState(category_fingerprints(formulas, options, version), item_fingerprints(tables, target))


def save_state(state: RunState, path: str) -> None:
    for name, rows in state._asdict().items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def load_state(spark: SparkSession, path: str) -> RunState:
    return RunState(*[spark.read.parquet(f"{path}/{name}") for name in RunState._fields])


def _changed(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, or with another fingerprint."""
    old = before.select(F.col(key).alias("__key"), F.col("fingerprint").alias("__old"))
    both = now.join(old, F.col(key).eqNullSafe(F.col("__key")), "full")
    differs = ~F.col("fingerprint").eqNullSafe(F.col("__old"))
    return both.where(differs).select(F.coalesce(F.col(key), F.col("__key")).alias(key))


def affected_items(before: RunState, now: RunState, item_category: DataFrame) -> DataFrame:
    """(item_id): items with other inputs than before, gone ones included, and items of
    categories with other rules; all items where the options of the run differ."""
    categories = settled(_changed(before.categories, now.categories, "category_id"))
    items = _changed(before.items, now.items, "item_id")
    if not categories.where(F.col("category_id").isNull()).isEmpty():
        return items.unionByName(now.items.select("item_id")).where(F.col("item_id").isNotNull()).distinct()
    of_categories = lookup_join(item_category, categories, "category_id", "semi")
    ids = items.unionByName(of_categories.select(F.col("category_item_id").alias("item_id")))
    return ids.where(F.col("item_id").isNotNull()).distinct()


class _Restriction:
    """Keeps or drops the rows of some items: the ids are broadcast if their measured size
    allows; else rows that cannot match leave by a Bloom filter before the shuffle."""

    def __init__(self, ids: DataFrame, limit_bytes: int | None = None):
        self.ids, (self.n, size) = ids, measure(ids)
        self.small = fits_broadcast(ids, limit_bytes, size)

    def _joined(self, df: DataFrame, key: str, how: str) -> DataFrame:
        ids = self.ids.select(F.col("item_id").alias("__item"))
        return df.join(F.broadcast(ids) if self.small else ids, col(key) == F.col("__item"), how)

    def only(self, df: DataFrame, key: str) -> DataFrame:
        if not self.small:
            df = maybe_among(df, [key], self.ids, ["item_id"], self.n)
        return self._joined(df, key, "left_semi")

    def without(self, df: DataFrame, key: str) -> DataFrame:
        return self._joined(df, key, "left_anti")


def restrict(tables: Mapping[str, DataFrame], ids: DataFrame, limit_bytes: int | None = None) -> dict[str, DataFrame]:
    """The catalogue of the items ``ids`` alone."""
    return _restricted(tables, _Restriction(ids, limit_bytes))


def _restricted(tables: Mapping[str, DataFrame], to: _Restriction) -> dict[str, DataFrame]:
    keys = {
        "item": "item_id",
        "item_category": "category_item_id",
        "item_attribute_value": "attribute_item_id",
        "item_custom_field_value": "custom_field_item_id",
    }
    return {name: to.only(t, keys[name]) if name in keys else t for name, t in tables.items()}


def enrich_changed(
    tables: Mapping[str, DataFrame],
    formulas: DataFrame,
    target: DataFrame,
    previous: DataFrame,
    before: RunState,
    now: RunState,
    limit_bytes: int | None = None,
    **options,
) -> DataFrame:
    """The item table that a full run over ``target`` would give, from that of the run before.

    ``target`` is the stored item table, ``previous`` what the run with the state ``before``
    made of it; ``options`` go to ``enriched_rows``, and must be those ``now`` was made with.
    """
    ids = settled(affected_items(before, now, tables["item_category"]))
    to = _Restriction(ids, limit_bytes)
    rows, _ = enriched_rows(_restricted(tables, to), formulas, **options)
    fresh = upsert(to.only(target, "id"), rows, ["id"], unique="assume")
    return to.without(previous, "id").unionByName(fresh)
