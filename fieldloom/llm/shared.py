"""The shared folder, lineage cuts, Arrow helpers and small table helpers of the operators."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldloom.operators.bloom import bloom_filter, filter_bits, might_contain

_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch on its way to Python, unless the session names a size. Spark's own limit of
#: 10,000 rows takes 20 MB of usual texts, which each task holds several times: outside the executor's heap and in Python.
BATCH_BYTES = "4m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each application, and batches of a bounded size."""
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        root = Path(__file__).resolve().parents[1]
        held = tempfile.mkdtemp(prefix="llm-code-")  # the driver's; Spark sends it on
        spark.sparkContext.addPyFile(shutil.make_archive(f"{held}/{root.name}", "zip", root.parent, root.name))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where neither the session nor its context names one and Spark runs on one machine
    (tests), a temporary folder is made and set as the context's checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written once to the shared folder; later plans start there.

    A lost executor costs nothing of what was written, and partitions stay as they were.
    """
    spark = df.sparkSession
    shared_dir(spark)
    ship(spark)
    out = df.checkpoint()
    del df  # else its plan, and with it the plan's shuffles, would outlive the release
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results are written.

    The cleaner acts on plans that the driver has collected as garbage; without a hint that
    may come long after a large shuffle has served its purpose.
    """
    gc.collect()
    spark._jvm.System.gc()


def own_folder(spark: SparkSession, purpose: str) -> str:
    """A new name below the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def map_arrow(
    df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """``df.mapInArrow`` by a function of one batch; ``None`` gives no rows."""

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = each(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


#: Bits of a sieve: 1 MB, whatever the number of ids.
SIEVE_BITS = 23


def slot(key: Column) -> Column:
    """The bit of an id in a sieve."""
    return F.pmod(F.xxhash64(key), F.lit(1 << SIEVE_BITS)).cast("int")


def sieve(df: DataFrame, key: Column) -> np.ndarray:
    """Which slots the ids of ``df`` take. It only saves work: an id that is not among them may
    share a slot, so what passes is joined exactly; the more ids, the more others pass."""
    words = df.select(slot(key).alias("s")).select(F.expr("s >> 6").alias("w"), F.expr("shiftleft(1L, s & 63)").alias("b"))
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    bits[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64)
    return bits


def passes(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 6] >> (slots & 63)) & 1 == 1


def parted(docs: DataFrame, key: str, ids: DataFrame, id_: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose ``key`` may be among ``ids``, all others): only the first need to be shuffled to
    be joined with ``ids``, which have been made once. No second part where so many ids are
    there that a filter of fixed size would hold nothing back."""
    bits = filter_bits(ids.count())
    if bits is None:
        return docs, None
    might = might_contain(bloom_filter(ids, [id_], bits).scalar(), [key], bits)
    return docs.where(might), docs.where(~might)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_bucket(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``: a split that any engine can repeat."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
