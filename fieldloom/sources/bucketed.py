"""The catalogue as bucketed, sorted tables.

Every table that is joined or grouped on the item's id is stored in as many buckets of it.
The pivots, the joins on the item and the upsert then need no shuffle: each task reads one
bucket of each table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators.schema import apply_aliases
from fieldloom.sources.catalogue import Reader

# The item's id in each table that has one; the others are small and stay plain.
ITEM_KEYS = {"item": "id", "item_category": "item_id", "item_attribute_value": "item_id", "item_custom_field_value": "item_id"}


def write_catalogue(
    tables: Mapping[str, DataFrame], prefix: str, buckets: int, folder: str | None = None
) -> None:
    """Save stored (unaliased) entities as tables ``<prefix><entity>``.

    One shuffle each, once; later runs have none.  Choose so many buckets that one of the largest
    table is a few hundred megabytes.  Without a ``folder`` the tables lie in the warehouse.
    """
    for entity, df in tables.items():
        key = ITEM_KEYS.get(entity)
        # Dealt as the buckets are, so that each is one file.
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key) if key else df.coalesce(1).write
        if folder is not None:
            writer = writer.option("path", f"{folder}/{entity}")
        writer.mode("errorifexists").saveAsTable(f"{prefix}{entity}")


def table_reader(spark: SparkSession, prefix: str) -> Reader:
    """Read entity tables by name, as ``load_catalogue`` takes it."""
    return lambda entity, aliases: apply_aliases(spark.table(f"{prefix}{entity}"), aliases)


def drop_catalogue(spark: SparkSession, entities, prefix: str) -> None:
    for entity in entities:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{entity}")
