"""Column naming and schema alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Back-tick a column name so dots, spaces and back-ticks in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def is_case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def folding(spark: SparkSession) -> Callable[[str], str]:
    """Gives the form of a name that Spark compares when it resolves columns."""
    return str if is_case_sensitive(spark) else str.lower


def has_column(df: DataFrame, name: str) -> bool:
    """Whether Spark would resolve ``name``, by the session's rule on case."""
    fold = folding(df.sparkSession)
    return fold(name) in {fold(c) for c in df.columns}


def apply_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns, each under its alias, in mapping order."""
    return df.select(*[col(source).alias(alias) for source, alias in aliases.items()])


def invert_aliases(
    aliases: Mapping[str, str],
    drop: Iterable[str] = (),
    override: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Alias → table column, for writing back what an aliased scan read.

    ``drop`` removes table columns from the result and ``override`` names another
    DataFrame column as the source of a table column.
    """
    dropped = set(drop)
    kept = {c: a for c, a in aliases.items() if c not in dropped}
    kept.update(override or {})
    return {alias: column for column, alias in kept.items()}


def rename_to_target(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename source → target for each pair that differs and whose source exists."""
    present = set(df.columns)
    return df.withColumnsRenamed(
        {s: t for s, t in mapping.items() if s != t and s in present}
    )


def select_existing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Requested columns that exist, in requested order, and the names skipped."""
    present = set(df.columns)
    kept = [c for c in columns if c in present]
    if not kept:
        raise ValueError(f"none of the requested columns exist: {list(columns)}")
    return df.select(*[col(c) for c in kept]), [c for c in columns if c not in present]


def restore_schema(df: DataFrame, like: DataFrame) -> DataFrame:
    """Project back to exactly the columns of ``like``, in its order."""
    return df.select(*[col(c) for c in like.columns])
