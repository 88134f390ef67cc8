import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '4')}]")
        .appName("fieldloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getConf().get("spark.checkpoint.dir"):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, in a stable order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def above(plan, marker):
    """The lines of the operators above the first one with ``marker``, the nearest first."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            found.append(line.lstrip(" :+-"))
            now = depth(line)
    return found
