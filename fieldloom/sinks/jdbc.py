"""JDBC sinks: distributed batched staging write, then one set-based upsert of what counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators.schema import rename_to_target, select_existing
from fieldloom.sinks.staging import accepted_attempts, attempt_condition, tag_attempts

BATCH_SIZE = 5000
# A database takes fewer writers than a cluster has tasks.
CONNECTIONS = 32
DIALECTS = ("merge", "on_conflict")


def upsert_statement(
    table: str,
    staging: str,
    columns: Sequence[str],
    keys: Sequence[str],
    dialect: str = "merge",
    attempts: Sequence[int] | None = None,
) -> str:
    """The statement that moves staged rows into the table.

    ``merge`` is standard MERGE, ``on_conflict`` the INSERT form of PostgreSQL and
    SQLite.  With key columns only, existing rows are left alone.  With ``attempts`` only what
    those task attempts staged is moved.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}, not {dialect!r}")
    missing = [k for k in keys if k not in columns]
    if missing or not keys:
        raise ValueError(f"key columns missing from the write: {missing or 'all'}")
    names = ", ".join(columns)
    updated = [c for c in columns if c not in keys]
    if dialect == "on_conflict":
        action = (
            "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in updated)
            if updated
            else "DO NOTHING"
        )
        where = "" if attempts is None else f"WHERE {attempt_condition(attempts)} "
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} {where}"
            f"ON CONFLICT ({', '.join(keys)}) {action}"
        )
    condition = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    update = (
        "WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{c} = s.{c}" for c in updated) + " "
        if updated
        else ""
    )
    if attempts is not None:
        staging = f"(SELECT {names} FROM {staging} WHERE {attempt_condition(attempts)})"
    return (
        f"MERGE INTO {table} t USING {staging} s ON {condition} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "append",
    connections: int = CONNECTIONS,
) -> None:
    """Batched, distributed write over ``connections`` connections.

    Rows are dealt to that many partitions first: left to the writer more would be merged
    without a shuffle, and all work since the last one would run in as few tasks.
    """
    _write(df.repartition(connections), url, table, properties, mode, connections)


def _write(df, url, table, properties, mode, connections) -> None:
    writer = df.write.option("batchsize", BATCH_SIZE).option("numPartitions", connections)
    writer.jdbc(url, table, mode=mode, properties=dict(properties or {}))


def jdbc_upsert(
    df: DataFrame,
    url: str,
    table: str,
    columns: Sequence[str],
    keys: Sequence[str],
    mapping: Mapping[str, str] | None = None,
    staging: str | None = None,
    properties: Mapping[str, str] | None = None,
    dialect: str = "merge",
    connections: int = CONNECTIONS,
) -> list[str]:
    """Upsert the DataFrame into a database table; returns the column names skipped.

    Executors fill a staging table in parallel, replacing what an earlier run left; then the
    driver issues one statement, so the target changes atomically.  Each staged row carries the
    task attempt that wrote it, and only attempts whose success Spark has accepted count: a
    task that is repeated after its rows were committed leaves rows that nothing reads.
    """
    staging = staging or f"{table}_staging"
    rows, skipped = select_existing(rename_to_target(df, mapping or {}), columns)
    names = rows.columns
    upsert_statement(table, staging, names, keys, dialect)  # wrong keys are found before any work
    tagged, observed = tag_attempts(rows.repartition(connections))
    _write(tagged, url, staging, properties, "overwrite", connections)
    attempts = accepted_attempts(observed)
    # Checked on what was staged, inside the database: only a few repeated keys come back.
    repeated = _repeated(df.sparkSession, url, staging, keys, properties, attempts).limit(5).collect()
    if repeated:
        raise ValueError(f"the staged rows repeat keys, e.g. {[r.asDict() for r in repeated]}")
    execute(df, url, upsert_statement(table, staging, names, keys, dialect, attempts), properties)
    return skipped


def repeated_query(table: str, keys: Sequence[str], attempts: Sequence[int] | None = None) -> str:
    names = ", ".join(keys)
    where = "" if attempts is None else f"WHERE {attempt_condition(attempts)} "
    return f"(SELECT {names} FROM {table} {where}GROUP BY {names} HAVING COUNT(*) > 1) repeated_keys"


def _repeated(
    spark: SparkSession, url: str, table: str, keys: Sequence[str], properties: Mapping[str, str] | None,
    attempts: Sequence[int],
) -> DataFrame:
    return spark.read.jdbc(url, repeated_query(table, keys, attempts), properties=dict(properties or {}))


def execute(
    df: DataFrame, url: str, statement: str, properties: Mapping[str, str] | None = None
) -> None:
    """Run one statement on the driver's connection."""
    jvm = df.sparkSession._jvm
    connection_properties = jvm.java.util.Properties()
    for key, value in (properties or {}).items():
        connection_properties.setProperty(key, value)
    if "driver" in (properties or {}):
        jvm.java.lang.Class.forName(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, connection_properties)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()
