"""Staged rows when tasks are repeated after they have written."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import ROOT, rows

from fieldloom.sinks import jdbc, staging

# A sink without a commit protocol: each task leaves its file even if it then fails.  Runs in a session
# of its own, where tasks may be repeated.
SCRIPT = """
import json, os, sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from fieldloom.sinks.staging import accepted_attempts, staged_rows, tag_attempts

FOLDER = {folder!r}

class Leaves(DataSource):
    @classmethod
    def name(cls):
        return "leaves"
    def writer(self, schema, overwrite):
        return Writer()

class Writer(DataSourceWriter):
    def write(self, rows):
        context = TaskContext.get()
        with open(f"{{FOLDER}}/{{context.taskAttemptId()}}.json", "w") as f:
            for r in rows:
                f.write(json.dumps(r.asDict()) + chr(10))
        if context.partitionId() % 2 == 0 and context.attemptNumber() < 2:
            raise RuntimeError("lost after writing")
        return WriterCommitMessage()

spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "5").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
spark.dataSource.register(Leaves)
tagged, observed = tag_attempts(spark.range(1000).selectExpr("id", "concat('v', id) AS v").repartition(5))
tagged.write.format("leaves").mode("append").save()
attempts = accepted_attempts(observed)
staged = spark.read.schema(tagged.schema).json(FOLDER)
counted = staged_rows(staged, attempts)
print(json.dumps([staged.count(), counted.count(), counted.distinct().count(), len(attempts), len(os.listdir(FOLDER))]))
"""


def test_repeated_tasks_stage_once(tmp_path):
    folder = tmp_path / "staged"
    folder.mkdir()
    script = tmp_path / "script.py"
    script.write_text(SCRIPT.format(root=str(ROOT), folder=str(folder)))
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert out.returncode == 0, out.stderr[-2000:]
    staged, counted, distinct, attempts, files = __import__("json").loads(out.stdout.strip().splitlines()[-1])
    assert staged > 1000 and (counted, distinct) == (1000, 1000)
    assert attempts == 5 and files == 5 + 2 * 3


def test_one_attempt_a_partition(spark, tmp_path):
    tagged, observed = staging.tag_attempts(spark.range(100).repartition(3))
    tagged.write.parquet(f"{tmp_path}/t")
    attempts = staging.accepted_attempts(observed)
    staged = spark.read.parquet(f"{tmp_path}/t")
    assert len(attempts) == 3 and {r[0] for r in staged.select(staging.ATTEMPT).distinct().collect()} == set(attempts)
    assert rows(staging.staged_rows(staged, attempts)) == rows(spark.range(100))
    assert staging.staged_rows(staged, attempts[:1]).count() < 100 and staging.staged_rows(staged, []).count() == 0


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "id long")
    for k, df in enumerate((spark.range(0), empty, empty.repartition(3), spark.range(9).where("id > 10").repartition(2), empty.groupBy("id").count())):
        tagged, observed = staging.tag_attempts(df)
        tagged.write.parquet(f"{tmp_path}/t{k}")
        assert staging.accepted_attempts(observed) == []


def test_the_name_is_taken(spark):
    with pytest.raises(ValueError, match="attempt column"):
        staging.tag_attempts(spark.range(1).withColumnRenamed("id", staging.ATTEMPT))


def test_statements_read_accepted_attempts_only():
    assert jdbc.upsert_statement("t", "s", ["id", "a"], ["id"], attempts=[3, 7]) == (
        "MERGE INTO t t USING (SELECT id, a FROM s WHERE staged_by IN (3, 7)) s ON t.id = s.id "
        "WHEN MATCHED THEN UPDATE SET a = s.a WHEN NOT MATCHED THEN INSERT (id, a) VALUES (s.id, s.a)"
    )
    assert jdbc.upsert_statement("t", "s", ["id"], ["id"], "on_conflict", []) == (
        "INSERT INTO t (id) SELECT id FROM s WHERE 1 = 0 ON CONFLICT (id) DO NOTHING"
    )
    assert jdbc.repeated_query("s", ["a"], [1]) == "(SELECT a FROM s WHERE staged_by IN (1) GROUP BY a HAVING COUNT(*) > 1) repeated_keys"


@pytest.mark.parametrize("write", ["append", "upsert"])
def test_the_input_runs_once(spark, monkeypatch, write):
    """Jobs of a write that aggregates first: none before the writer's own."""
    noop = lambda df, *a: df.write.format("noop").mode("overwrite").save()
    monkeypatch.setattr(jdbc, "_write", noop)
    monkeypatch.setattr(jdbc, "execute", lambda *a: None)
    monkeypatch.setattr(jdbc, "_repeated", lambda spark, *a: spark.range(0))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(count, "id long").groupBy("id").count()
    if write == "append":
        jdbc.append_jdbc(df, "jdbc:x", "t", connections=2)
    else:
        jdbc.jdbc_upsert(df, "jdbc:x", "t", ["id", "count"], ["id"], connections=2)
    assert seen.value == 1000


def test_no_rdd_in_the_sinks():
    assert not [p for p in Path(ROOT, "fieldloom").rglob("*.py") if ".rdd." in p.read_text()]
