"""JDBC reads: projection as a pushed-down subquery, parallel by key range."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldloom.sources.ranges import even_bounds, predicates


def aliased_query(table: str, aliases: Mapping[str, str]) -> str:
    """The table expression that makes the database project and rename."""
    columns = ", ".join(f"{column} AS {alias}" for column, alias in aliases.items())
    return f"(SELECT {columns} FROM {table}) {table.replace('.', '_')}_alias"


# Rows a database sends at a time: without it, some drivers fetch a task's whole range at once.
FETCH_SIZE = 10_000


def _options(properties: Mapping[str, str] | None, fetch_size: int | None) -> dict[str, str]:
    given = dict(properties or {})
    if fetch_size:
        given.setdefault("fetchsize", str(fetch_size))
    return given


def bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds_alias"


def read_jdbc_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    aliases: Mapping[str, str],
    partition_alias: str,
    properties: Mapping[str, str] | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 10,
    fetch_size: int | None = FETCH_SIZE,
) -> DataFrame:
    """Aliased scan of a database table in ``partitions`` parallel key ranges.

    ``partition_alias`` is one of the aliases.  Bounds only set the strides; left out,
    they are the smallest and greatest key, so the ranges cover the keys in use.
    """
    column = {alias: c for c, alias in aliases.items()}.get(partition_alias)
    if column is None:
        raise ValueError(f"{partition_alias!r} is not one of the aliases")
    properties = _options(properties, fetch_size)
    lower, upper = _bounds(spark, url, table, column, properties, lower, upper)
    return spark.read.jdbc(
        url,
        aliased_query(table, aliases),
        column=partition_alias,
        lowerBound=lower,
        upperBound=max(lower, upper),
        numPartitions=partitions,
        properties=properties,
    )


def read_jdbc_even(
    spark: SparkSession,
    url: str,
    table: str,
    aliases: Mapping[str, str],
    partition_alias: str,
    properties: Mapping[str, str] | None = None,
    partitions: int = 10,
    fetch_size: int | None = FETCH_SIZE,
) -> DataFrame:
    """Aliased scan of a database table in key ranges of about equal numbers of rows.

    The key column alone is read first, in equal strides, and sketched; where ids cluster, the
    strides of ``read_jdbc_partitioned`` would give one task most of the rows.
    """
    only_key = {c: a for c, a in aliases.items() if a == partition_alias}
    keys = read_jdbc_partitioned(
        spark, url, table, only_key, partition_alias, properties, partitions=partitions, fetch_size=fetch_size
    )
    where = predicates(partition_alias, even_bounds(keys, partition_alias, partitions))
    return spark.read.jdbc(
        url, aliased_query(table, aliases), predicates=where, properties=_options(properties, fetch_size)
    )


def _bounds(spark, url, table, column, properties, lower, upper) -> tuple[int, int]:
    """The bounds given, or the smallest and greatest key."""
    if lower is None or upper is None:
        found = spark.read.jdbc(url, bounds_query(table, column), properties=properties).first()
        lower = lower if lower is not None else (found[0] or 0)
        upper = upper if upper is not None else (found[1] or 0)
    return lower, upper


def metadata_query(category_field: str, formula: str, field_names: str) -> str:
    """The formula metadata join, run inside the database."""
    return (
        "(SELECT cf.category_id AS category_id, fn.field_name AS field_name, "
        "f.formula_definition AS formula, f.id AS formula_id "
        f"FROM {formula} f "
        f"INNER JOIN {category_field} cf ON cf.id = f.category_field_id "
        f"INNER JOIN {field_names} fn ON fn.id = f.field_id) formula_data"
    )


def read_metadata(
    spark: SparkSession,
    url: str,
    category_field: str = "category_field",
    formula: str = "formula",
    field_names: str = "lu_field_name",
    properties: Mapping[str, str] | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int | None = FETCH_SIZE,
) -> DataFrame:
    """Formula metadata over JDBC, optionally in parallel ranges of category_id; bounds left
    out are looked up in ``category_field``."""
    query = metadata_query(category_field, formula, field_names)
    properties = _options(properties, fetch_size)
    if partitions is None:
        return spark.read.jdbc(url, query, properties=properties)
    lower, upper = _bounds(spark, url, category_field, "category_id", properties, lower, upper)
    return spark.read.jdbc(
        url,
        query,
        column="category_id",
        lowerBound=lower,
        upperBound=max(lower, upper),
        numPartitions=partitions,
        properties=properties,
    )
