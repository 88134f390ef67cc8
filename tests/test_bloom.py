import pytest
from conftest import above, optimized_plan, rows

from fieldloom.operators import bloom
from fieldloom.operators.joins import update_from


def test_filter_keeps_all_keys_and_few_others(spark):
    held = spark.range(0, 40_000, 2).selectExpr("id AS k", "concat('v', id % 100) AS t")
    others = spark.range(0, 40_000).selectExpr("id AS k", "concat('v', id % 100) AS t")
    kept = bloom.maybe_among(others, ["k", "t"], held, ["k", "t"], 20_000)
    assert kept.where("k % 2 = 0").count() == 20_000
    assert kept.where("k % 2 = 1").count() < 400  # 1 % or so


def test_null_keys_never_match(spark):
    held = spark.createDataFrame([(None, 1), (2, None), (3, 3)], "a int, b int")
    assert rows(bloom.maybe_among(held, ["a", "b"], held, ["a", "b"], 3)) == [(3, 3)]
    assert rows(bloom.maybe_among(held, ["a", "b"], held.limit(0), ["a", "b"], 0)) == []


def test_no_filter_where_it_would_not_help_or_would_be_wrong(spark):
    longs, ints, doubles = (spark.range(5).selectExpr(f"cast(id AS {t}) AS k") for t in ("long", "int", "double"))
    assert bloom.maybe_among(longs, ["k"], ints, ["k"], 5) is longs
    assert bloom.maybe_among(doubles, ["k"], doubles, ["k"], 5) is doubles
    assert bloom.maybe_among(longs, ["k"], longs, ["k"], bloom.MAX_BITS) is longs
    assert [bloom.filter_bits(n) for n in (0, 6_000, 7_000, 20_000_000, 60_000_000)] == [1 << 16, 1 << 16, 1 << 17, 1 << 27, None]


@pytest.mark.parametrize("latest_by", [None, "at"])
def test_update_drops_what_cannot_match_before_the_shuffle(spark, latest_by):
    small = spark.range(0, 2_000).selectExpr("id", "'s' AS v")
    large = spark.range(0, 200_000).selectExpr("id * 3 AS id", "concat('L', id) AS v", "id AS at")
    updated, _ = update_from(small, large, ["id"], ["v"], latest_by=latest_by, limit_bytes=0)
    assert updated.where("v <> 's'").count() == 667 and updated.count() == 2_000
    over = above(optimized_plan(updated), "Range (0, 200000")
    kinds = [line.split()[0] for line in over]
    assert kinds.index("Filter") < kinds.index("Aggregate") and "getbit" in over[kinds.index("Filter")]


def test_update_makes_the_keys_once(spark):
    """One job makes them, one measures, one looks for hot ones; the plan itself has not run."""
    tracker = spark.sparkContext.statusTracker()
    small, large = spark.range(100).selectExpr("id", "'s' AS v"), spark.range(1000).selectExpr("id", "'l' AS v")
    spark.sparkContext.setJobGroup("update", "update")
    try:
        update_from(small, large, ["id"], ["v"], limit_bytes=0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("update")) <= 5
