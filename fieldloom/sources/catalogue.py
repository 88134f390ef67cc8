"""The six catalogue entities and the aliases under which a job reads them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldloom.sources.jdbc import read_jdbc_even, read_jdbc_partitioned
from fieldloom.sources.scan import scan_aliased

# The item columns read, all but the key under their own name.
ITEM_COLUMNS = (
    "part_number", "brand_name", "mfr_part_number", "my_part_number", "upc", "country_of_origin",
    "country_of_sale", "gtin", "short_description", "long_description", "feature_bullets",
    "invoice_description", "qty_available", "package_length", "package_height", "package_weight",
    "package_width", "volume", "standard_approval", "status", "warranty", "enriched_indicator",
    "manufacturer_status",
)

# Item columns read but not written back.
ITEM_READ_ONLY = ("status", "enriched_indicator", "manufacturer_status")

# Table column → alias, per entity.
ALIASES: dict[str, dict[str, str]] = {
    "item": {"id": "item_id"} | {c: c for c in ITEM_COLUMNS},
    "item_category": {
        "id": "item_category_id",
        "category_id": "category_id",
        "item_id": "category_item_id",
        "default_category": "default_category",
    },
    "attribute": {"id": "attribute_id", "attribute_name": "attribute_name"},
    "item_attribute_value": {
        "id": "item_attribute_id",
        "attribute_value": "attribute_value",
        "attribute_id": "attribute_id",
        "item_id": "attribute_item_id",
    },
    "custom_field": {"id": "custom_field_id", "field_name": "custom_field_name"},
    "item_custom_field_value": {
        "id": "item_custom_field_id",
        "custom_field_value": "custom_field_value",
        "custom_field_id": "custom_field_id",
        "item_id": "custom_field_item_id",
    },
}

Reader = Callable[[str, Mapping[str, str]], DataFrame]


def load_catalogue(
    reader: Reader, aliases: Mapping[str, Mapping[str, str]] = ALIASES
) -> dict[str, DataFrame]:
    """Entity → aliased DataFrame, each through ``reader(entity, aliases)``."""
    return {entity: reader(entity, columns) for entity, columns in aliases.items()}


def parquet_reader(spark: SparkSession, root: str) -> Reader:
    """Read entity tables from ``root``/<entity>.parquet."""
    return lambda entity, aliases: scan_aliased(spark, f"{root}/{entity}.parquet", aliases)


def jdbc_reader(
    spark: SparkSession,
    url: str,
    schema: str = "",
    properties: Mapping[str, str] | None = None,
    partitions: int = 10,
    even: bool = False,
) -> Reader:
    """Read entity tables over JDBC in parallel ranges of their ``id``: of equal width, or,
    with ``even``, of about as many rows (ids are read once more for that)."""
    by_range = read_jdbc_even if even else read_jdbc_partitioned

    def read(entity: str, aliases: Mapping[str, str]) -> DataFrame:
        table = f"{schema}.{entity}" if schema else entity
        return by_range(
            spark, url, table, aliases, aliases["id"], properties, partitions=partitions
        )

    return read
