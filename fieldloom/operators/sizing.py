"""Measured size checks that decide whether a side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.schema import col

# A broadcast side is held once per executor and built on the driver.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32
FIELD_OVERHEAD_BYTES = 16


def _field_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        payload = F.octet_length(col(field.name))
    elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
        payload = F.aggregate(
            col(field.name), F.lit(0), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + FIELD_OVERHEAD_BYTES
        )
    elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        payload = F.octet_length(F.to_json(F.struct(col(field.name))))
    else:
        return F.lit(FIELD_OVERHEAD_BYTES)
    return F.coalesce(payload, F.lit(0)) + F.lit(FIELD_OVERHEAD_BYTES)


def measure(df: DataFrame) -> tuple[int, int]:
    """Row count and in-memory size in bytes, from one distributed aggregate."""
    width = reduce(add, [_field_bytes(f) for f in df.schema.fields], F.lit(ROW_OVERHEAD_BYTES))
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("size")
    ).first()
    return row["n"], row["size"] or 0


def spark_broadcasts(df: DataFrame) -> bool:
    """Whether Spark's own statistics make it broadcast ``df`` without being told."""
    limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit > 0 and int(str(size)) <= limit


def fits_broadcast(
    df: DataFrame, limit_bytes: int | None = None, size_bytes: int | None = None
) -> bool:
    """Whether ``df``, of ``size_bytes`` if known and measured if not, is small enough."""
    limit = BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes
    if limit <= 0:
        return False
    return (measure(df)[1] if size_bytes is None else size_bytes) <= limit


def shared_root(spark: SparkSession) -> str | None:
    """The folder that driver and executors share, where the session or its context names one."""
    context = spark.sparkContext
    return context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new name below the shared folder.  Without one, a session on one machine gets a
    temporary folder; on a cluster executors would each write to a folder of their own."""
    root = shared_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="fieldloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, made once.

    For a small table that several jobs read: they all see the same rows, and do not
    repeat the work behind them.  They are written to the shared checkpoint folder where
    the session names one (``spark.cleaner.referenceTracking.cleanCheckpoints`` lets Spark remove
    them once nothing refers to them), and cached otherwise; a cache lasts until
    ``spark.catalog.clearCache()`` or memory is needed.
    """
    folder = shared_root(df.sparkSession)
    if not folder:
        return df.persist()
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
