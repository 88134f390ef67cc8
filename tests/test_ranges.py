import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.sources import jdbc, ranges


def counts(df, where):
    return [df.where(p).count() for p in where]


def test_clustered_ids_are_cut_evenly(spark):
    near, far = spark.range(0, 30_000), spark.range(10**9, 10**9 + 2_000)
    df = near.unionByName(far).unionByName(spark.range(10**12, 10**12 + 3))
    where = ranges.predicates("id", ranges.even_bounds(df, "id", 8))
    found = counts(df, where)
    assert len(found) == 8 and sum(found) == 32_003 and max(found) < 1.05 * 32_003 / 8
    strides = ranges.predicates("id", [10**12 * i // 8 for i in range(1, 8)])
    assert max(counts(df, strides)) > 31_000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=30), st.integers(1, 6))
def test_every_row_is_in_one_range(spark, ids, n):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    where = ranges.predicates("id", ranges.even_bounds(df, "id", n))
    assert 1 <= len(where) <= n
    hits = df.select(sum((F.expr(f"CASE WHEN {p} THEN 1 ELSE 0 END") for p in where), F.lit(0)).alias("n"))
    assert all(r[0] == 1 for r in hits.collect()) and hits.count() == len(ids)


def test_one_value_of_most_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("id"))
    bounds = ranges.even_bounds(df, "id", 5)
    assert bounds == sorted(set(bounds)) and len(bounds) <= 4
    assert sum(counts(df, ranges.predicates("id", bounds))) == 1000
    with pytest.raises(ValueError):
        ranges.even_bounds(df, "id", 0)


def test_predicates_go_to_the_reader(spark, monkeypatch):
    """The key alone is read first; then one partition a predicate."""
    calls = []
    keys = spark.range(0, 1000).selectExpr("id AS item_id")

    class Reader:
        def jdbc(self, url, table, **options):
            calls.append((table, options))
            if "MIN(" in table:
                return spark.createDataFrame([(0, 999)], "low long, high long")
            return keys

    class Session:
        read = Reader()

    found = jdbc.read_jdbc_even(Session(), "jdbc:x", "prod.item", {"id": "item_id", "upc": "upc"}, "item_id", partitions=4)
    assert rows(found) == rows(keys)
    (_, first), (narrow, second), (wide, third) = calls
    assert narrow == "(SELECT id AS item_id FROM prod.item) prod_item_alias" and second["numPartitions"] == 4
    assert "upc AS upc" in wide and len(third["predicates"]) == 4 and third["predicates"][0].endswith("OR item_id IS NULL")
    assert first["properties"]["fetchsize"] == third["properties"]["fetchsize"]
