"""Copy-on-write upsert: a table partitioned by key bucket, of which an upsert rewrites few.

The bucket of a row is a hash of its key, kept as a partition column.  An upsert finds the
buckets its source touches, reads and merges only those, and replaces their files by a dynamic
partition overwrite; files of other buckets are neither read nor written.  New files are complete in
a staging folder before old ones go, and an upsert that was interrupted can be run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.schema import col
from fieldloom.operators.sizing import settled
from fieldloom.sinks.tables import upsert

BUCKET = "key_bucket"
# Spark's readers skip names that begin with an underscore.
LAYOUT = "_layout"
LAYOUT_DDL = "keys array<string>, buckets int"


def bucket_of(keys: Sequence[str], types: Mapping[str, T.DataType], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[col(k).cast(types[k]) for k in keys]), F.lit(buckets)).cast("int")


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a new table with one file for each of ``buckets`` key buckets.

    Choose so many that a bucket is a few hundred megabytes: then it is one task's work.
    """
    if not keys or buckets < 1:
        raise ValueError("a bucketed table needs keys and at least one bucket")
    if BUCKET in df.columns:
        raise ValueError(f"{BUCKET!r} is the name of the partition column")
    spark = df.sparkSession
    _written(df.withColumn(BUCKET, bucket_of(keys, _types(df), buckets)), path, "errorifexists", buckets)
    spark.createDataFrame([(list(keys), buckets)], LAYOUT_DDL).coalesce(1).write.json(f"{path}/{LAYOUT}")


def _written(df: DataFrame, path: str, mode: str, tasks: int) -> None:
    writer = df.repartition(tasks, BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)


def layout(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """(key columns, number of buckets) the table was written with."""
    row = spark.read.schema(LAYOUT_DDL).json(f"{path}/{LAYOUT}").first()
    return list(row["keys"]), row["buckets"]


def read_buckets(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The table, or of it the files of some buckets."""
    df = spark.read.parquet(path)
    df = df if only is None else df.where(F.col(BUCKET).isin(list(only)))
    return df.drop(BUCKET)


def upsert_touched(
    path: str,
    source: DataFrame,
    columns: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
    unique: str = "check",
) -> list[int]:
    """Upsert ``source`` into the table at ``path``; returns the buckets that were rewritten.

    Arguments and meaning are those of ``upsert``, on the table's own keys.
    """
    spark = source.sparkSession
    keys, buckets = layout(spark, path)
    target = spark.read.parquet(path)
    absent = [k for k in keys if k not in source.columns]
    if absent:
        raise ValueError(f"columns not in source: {absent}")
    # Made once: its buckets are looked up and its rows merged.
    incoming = settled(source.withColumn(BUCKET, bucket_of(keys, _types(target), buckets)))
    touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())
    if not touched:
        return []
    held = target.where(F.col(BUCKET).isin(touched))
    written = None if columns is None else [c for c in columns if c != BUCKET]
    merged = upsert(held, incoming, [BUCKET, *keys], written, defaults, unique)
    _written(merged, path, "overwrite", len(touched))
    return touched
