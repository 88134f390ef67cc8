import pytest
from conftest import physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.sinks import jdbc
from fieldloom.sinks.tables import append, append_rows, cast_losses, dedupe, merge_into, upsert

DDL = "id long, v string, status string"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "old1", "keep"), (2, "old2", "keep")], DDL)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, None), (3, "n3")], "id long, v string")


EXPECTED = [(1, "old1", "keep"), (2, None, "keep"), (3, "n3", "INACTIVE")]


@pytest.mark.parametrize("options", [{}, {"small_source": True}, {"small_source": True, "limit_bytes": 0}])
def test_upsert(target, source, options):
    merged = upsert(target, source, ["id"], ["v"], {"status": "INACTIVE"}, **options)
    assert merged.schema.names == target.schema.names and merged.dtypes == target.dtypes
    assert rows(merged) == EXPECTED
    again = upsert(merged, source, ["id"], ["v"], {"status": "INACTIVE"}, **options)
    assert rows(again) == EXPECTED


def test_a_small_source_does_not_shuffle_the_target(spark, source):
    target = spark.range(1000).selectExpr("id", "'t' v", "'s' status")
    plan = physical_plan(upsert(target, source, ["id"], small_source=True, unique="assume"))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan


KEYS = st.integers(0, 12)
TABLE = st.dictionaries(KEYS, st.sampled_from(["x", "y", None]), max_size=10)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE, TABLE, st.booleans())
def test_upsert_laws(spark, before, incoming, small):
    target = spark.createDataFrame([(k, v, "t") for k, v in before.items()], DDL)
    source = spark.createDataFrame(list(incoming.items()), "id long, v string")
    expected = {k: (v, "t") for k, v in before.items()}
    for k, v in incoming.items():
        expected[k] = (v, expected[k][1] if k in expected else None)
    merged = upsert(target, source, ["id"], small_source=small)
    assert {r["id"]: (r["v"], r["status"]) for r in merged.collect()} == expected


def test_composite_keys_and_key_only_writes(spark):
    target = spark.createDataFrame([(1, "a", "t")], "id long, k string, v string")
    source = spark.createDataFrame([(1, "a"), (1, "b")], "id long, k string")
    assert rows(upsert(target, source, ["id", "k"])) == [(1, "a", "t"), (1, "b", None)]


def test_upsert_arguments(spark, target, source):
    for options in ({}, {"small_source": True}, {"small_source": True, "limit_bytes": 0}):
        with pytest.raises(Exception, match=r'repeats keys, e.g. \{"__key_0":'):
            upsert(target, source.union(source), ["id"], **options).collect()
    with pytest.raises(ValueError, match="key columns"):
        upsert(target, source, [])
    with pytest.raises(ValueError, match="not in target"):
        upsert(target, source.withColumn("extra", F.lit(1)), ["id"])
    with pytest.raises(ValueError, match="unique"):
        upsert(target, source, ["id"], unique="maybe")


def test_uniqueness_takes_no_run_of_its_own(spark, target):
    source = spark.range(100).selectExpr("id", "'n' AS v")
    spark.sparkContext.setJobGroup("unique", "unique")
    try:
        merged = upsert(target, source, ["id"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("unique")) == 0
    assert merged.count() == 101 - 0 - 1 and physical_plan(merged).count("Exchange hashpartitioning") == 2


def test_null_keys_are_kept_apart_from_others(spark, target):
    source = spark.createDataFrame([(None, "x")], "id long, v string")
    assert rows(upsert(target, source, ["id"])) == rows(target.union(spark.createDataFrame([(None, "x", None)], DDL)))
    with pytest.raises(Exception, match="repeats keys"):
        upsert(target, source.union(source), ["id"]).collect()


def test_values_take_the_types_of_the_target(spark, target):
    source = spark.createDataFrame([(3, 5)], "id int, v int")
    assert rows(upsert(target, source, ["id"]).where("id = 3")) == [(3, "5", None)]


def test_dedupe(spark):
    df = spark.createDataFrame(
        [(1, False, 10, "a"), (1, True, 11, "b"), (1, True, 12, "c"), (2, False, 1, "d")],
        "id long, main boolean, link long, v string",
    )
    assert rows(dedupe(df, ["id"], ["main", "link"])) == [(1, True, 12, "c"), (2, False, 1, "d")]
    assert rows(dedupe(df, ["id"], ["link"], descending=False).select("v")) == [("a",), ("d",)]


def test_append(spark, target, tmp_path):
    extra = spark.createDataFrame([("s", 9)], "status string, id int")
    assert rows(append_rows(target, extra))[-1] == (9, None, "s")
    with pytest.raises(ValueError):
        append_rows(target, extra.withColumn("x", F.lit(1)))
    path = str(tmp_path / "t")
    append(target, path)
    append(target, path)
    assert spark.read.parquet(path).count() == 4


def test_cast_losses(spark):
    target = spark.createDataFrame([], "id long, qty int")
    source = spark.createDataFrame([(1, "5"), (2, "abc"), (3, None)], "id long, qty string")
    cast, report = cast_losses(source, target)
    assert rows(cast) == [(1, 5), (2, None), (3, None)]
    assert rows(report) == [("qty", 1)]
    same, none = cast_losses(target, target)
    assert rows(none) == [] and same.dtypes == target.dtypes


def test_merge_needs_a_catalog_that_can(spark, source):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW not_mergeable AS SELECT 1L id, 'a' v")
    with pytest.raises(Exception, match="(?i)merge|not.*support|view"):
        merge_into(source, "not_mergeable", ["id"])


def test_upsert_statements():
    assert jdbc.upsert_statement("t", "s", ["id", "a", "b"], ["id"]) == (
        "MERGE INTO t t USING s s ON t.id = s.id WHEN MATCHED THEN UPDATE SET a = s.a, b = s.b "
        "WHEN NOT MATCHED THEN INSERT (id, a, b) VALUES (s.id, s.a, s.b)"
    )
    assert jdbc.upsert_statement("t", "s", ["id", "k"], ["id", "k"]) == (
        "MERGE INTO t t USING s s ON t.id = s.id AND t.k = s.k "
        "WHEN NOT MATCHED THEN INSERT (id, k) VALUES (s.id, s.k)"
    )
    assert jdbc.upsert_statement("t", "s", ["id", "a"], ["id"], "on_conflict") == (
        "INSERT INTO t (id, a) SELECT id, a FROM s ON CONFLICT (id) DO UPDATE SET a = EXCLUDED.a"
    )
    assert jdbc.upsert_statement("t", "s", ["id"], ["id"], "on_conflict").endswith("DO NOTHING")
    for bad in ((["a"], ["id"]), (["a"], [])):
        with pytest.raises(ValueError):
            jdbc.upsert_statement("t", "s", *bad)
    with pytest.raises(ValueError):
        jdbc.upsert_statement("t", "s", ["id"], ["id"], "other")


def test_jdbc_upsert_stages_then_merges(spark, source, monkeypatch):
    """The steps, without a database: what is staged, checked and executed."""
    staged, executed, checked = {}, [], []

    def stage(df, url, table, properties, mode, connections):
        df.write.format("noop").mode("overwrite").save()
        staged[table] = (rows(df.drop("staged_by")), df.columns, mode)

    def repeated(found):
        return lambda spark, url, table, keys, properties, attempts: checked.append(attempts) or found

    monkeypatch.setattr(jdbc, "_write", stage)
    monkeypatch.setattr(jdbc, "execute", lambda df, url, sql, properties: executed.append(sql))
    monkeypatch.setattr(jdbc, "_repeated", repeated(source.limit(0)))
    skipped = jdbc.jdbc_upsert(
        source.withColumnRenamed("id", "item_id"), "jdbc:x", "prod.item", ["id", "v", "gone"],
        ["id"], {"item_id": "id"},
    )
    assert skipped == ["gone"]
    assert staged == {"prod.item_staging": ([(2, None), (3, "n3")], ["id", "v", "staged_by"], "overwrite")}
    assert executed == [jdbc.upsert_statement("prod.item", "prod.item_staging", ["id", "v"], ["id"], attempts=checked[0])]
    assert len(checked[0]) in (1, 2)
    monkeypatch.setattr(jdbc, "_repeated", repeated(source))
    with pytest.raises(ValueError, match="repeat keys"):
        jdbc.jdbc_upsert(source, "jdbc:x", "t", ["id", "v"], ["id"])
    assert jdbc.repeated_query("s", ["a", "b"]) == (
        "(SELECT a, b FROM s GROUP BY a, b HAVING COUNT(*) > 1) repeated_keys"
    )
