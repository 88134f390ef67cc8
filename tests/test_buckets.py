from pathlib import Path

import pytest
from conftest import physical_plan, rows

from fieldloom.plans import pipeline
from fieldloom.plans import testbed as tb
from fieldloom.sinks import buckets
from fieldloom.sinks.tables import upsert
from fieldloom.sources import bucketed
from fieldloom.sources.catalogue import load_catalogue

DDL = "id long, part string, v string, w int"


def files(path):
    return {(p.parent.name, p.name): p.stat().st_mtime_ns for p in Path(path).rglob("key_bucket=*/part-*")}


@pytest.fixture
def stored(spark, tmp_path):
    df = spark.range(400).selectExpr("id", "concat('p', id % 3) AS part", "'old' AS v", "1 AS w")
    path = f"{tmp_path}/t"
    buckets.write_buckets(df, path, ["id", "part"], 32)
    return df, path


def test_one_file_a_bucket(spark, stored):
    df, path = stored
    assert len(files(path)) == 32 and buckets.layout(spark, path) == (["id", "part"], 32)
    assert rows(buckets.read_buckets(spark, path)) == rows(df)


def test_untouched_buckets_stay(spark, stored):
    df, path = stored
    before = files(path)
    source = spark.createDataFrame([(3, "p0", "new"), (4, "p0", None), (1000, "p1", "in")], "id int, part string, v string")
    touched = buckets.upsert_touched(path, source, defaults={"w": 7})
    after = files(path)
    assert 0 < len(touched) <= 3
    kept = {k: v for k, v in before.items() if int(k[0].split("=")[1]) not in touched}
    assert kept.items() <= after.items() and len(after) == 32 and len(after.keys() - before.keys()) == len(touched)
    assert rows(buckets.read_buckets(spark, path)) == rows(upsert(df, source, ["id", "part"], defaults={"w": 7}))
    plan = physical_plan(buckets.read_buckets(spark, path, touched))
    assert "PartitionFilters: [isnotnull(key_bucket" in plan or "PartitionFilters: [key_bucket" in plan


def test_again_changes_nothing(spark, stored):
    _, path = stored
    source = spark.createDataFrame([(3, "p0", "new")], "id long, part string, v string")
    assert buckets.upsert_touched(path, source) == buckets.upsert_touched(path, source)
    assert buckets.read_buckets(spark, path).where("v = 'new'").count() == 1


def test_columns_nulls_and_empty_sources(spark, stored):
    df, path = stored
    before = files(path)
    none = spark.createDataFrame([], DDL)
    assert buckets.upsert_touched(path, none) == [] and files(path) == before
    source = spark.createDataFrame([(None, "p", "x", 2), (5, "p2", "x", None)], DDL)
    buckets.upsert_touched(path, source, columns=["w"])
    assert rows(buckets.read_buckets(spark, path)) == rows(upsert(df, source, ["id", "part"], ["w"]))


def test_wrong_tables_are_refused(spark, stored, tmp_path):
    df, path = stored
    with pytest.raises(ValueError, match="not in source"):
        buckets.upsert_touched(path, df.drop("part"))
    with pytest.raises(ValueError, match="keys"):
        buckets.write_buckets(df, f"{tmp_path}/x", [], 4)
    with pytest.raises(ValueError, match="partition column"):
        buckets.write_buckets(df.withColumn("key_bucket", df["w"]), f"{tmp_path}/x", ["id"], 4)
    twice = df.limit(1).unionByName(df.limit(1))
    with pytest.raises(Exception, match="repeats keys"):
        buckets.upsert_touched(path, twice)


# --- the bucketed catalogue ----------------------------------------------------


SF_DIR = "/root/testdata/sf0.001"


def test_no_shuffle_from_the_pivots_to_the_upsert(spark, tmp_path):
    stored = tb.stored_catalogue(spark, SF_DIR)
    bucketed.write_catalogue(stored, "bucketed_test_", 4, f"file://{tmp_path}/c")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rules = tb.rules(spark, tb.WIDE_RULES)

        def run(tables, target):
            found, _ = pipeline.enriched_rows(tables, rules, aliases=tb.ITEM_ALIASES, read_only=["status"])
            return upsert(target, found, ["id"], unique="assume")

        tables = load_catalogue(bucketed.table_reader(spark, "bucketed_test_"), tb.ENTITY_ALIASES)
        found = run(tables, spark.table("bucketed_test_item"))
        plan = physical_plan(found)
        assert plan.count("SortMergeJoin") >= 4 and "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan
        plain = run(tb.catalogue(spark, SF_DIR, stored), stored["item"])
        assert "Exchange hashpartitioning" in physical_plan(plain)
        assert rows(found) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        bucketed.drop_catalogue(spark, stored, "bucketed_test_")
