"""Exactly-once staging: rows carry the task attempt that wrote them, and a list says which count.

A sink without a commit protocol of its own (a database that commits per connection, a folder
that tasks append to) keeps what an attempt wrote even if Spark then repeats the task: the executor
may be lost after the commit, or a second attempt may have run for safety.  Spark accepts one
attempt of each task.  Its number reaches the driver as an observed metric, which is merged
only from accepted attempts; readers of the staged rows filter by the list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: The column that names the attempt; unique within an application.
ATTEMPT = "staged_by"


def tag_attempts(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with the attempt of each row, to be written in this very stage, and the observation
    that ``accepted_attempts`` reads once it has been written.

    Write it as it is: after a further shuffle rows would name attempts that wrote nothing.
    The list has an entry a partition.
    """
    if ATTEMPT in df.columns:
        raise ValueError(f"{ATTEMPT!r} is the name of the attempt column")

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            column = pa.array([attempt], pa.int64()).take(pa.array([0] * batch.num_rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ATTEMPT])

    observed = Observation()
    tagged = df.mapInArrow(tag, StructType([*df.schema, StructField(ATTEMPT, LongType())]))
    return tagged.observe(observed, F.collect_set(ATTEMPT).alias("attempts")), observed


def accepted_attempts(observed: Observation) -> list[int]:
    """The attempts whose rows count, after the write."""
    return sorted(observed.get["attempts"])


def staged_rows(staged: DataFrame, attempts: Sequence[int]) -> DataFrame:
    """Of staged rows those that count."""
    return staged.where(is_accepted(attempts)).drop(ATTEMPT)


def is_accepted(attempts: Sequence[int]) -> Column:
    return F.col(ATTEMPT).isin(list(attempts)) if attempts else F.lit(False)


def attempt_condition(attempts: Sequence[int]) -> str:
    """The same as SQL."""
    return f"{ATTEMPT} IN ({', '.join(str(int(a)) for a in attempts)})" if attempts else "1 = 0"
