import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from fieldloom.operators.pivots import discover_values, pivot_one_pass, pivot_values, pivot_wide


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(
        [(1, "len", None), (1, "len", "v2"), (2, "br", None), (3, None, "q")],
        "k long, name string, value string",
    ).coalesce(1)


def test_first_non_null(long):
    wide = pivot_wide(long, ["k"], "name", "value")
    assert wide.columns == ["k", "null", "br", "len"]
    assert rows(wide) == [(1, None, None, "v2"), (2, None, None, None), (3, "q", None, None)]


def test_given_values(long):
    wide = pivot_wide(long, ["k"], "name", "value", values=["len", "absent"], prefix="p_")
    assert wide.columns == ["k", "p_len", "p_absent"]
    assert rows(wide) == [(1, "v2", None), (2, None, None), (3, None, None)]
    matched = pivot_wide(long, ["k"], "name", "value", values=["len"], matched_only=True)
    assert rows(matched) == [(1, "v2")]
    with_null = pivot_wide(long, ["k"], "name", "value", values=[None, "br"], matched_only=True)
    assert rows(with_null) == [(2, None, None), (3, "q", None)]
    assert rows(pivot_wide(long, ["k"], "name", "value", values=[])) == [(1,), (2,), (3,)]


def test_values(long):
    assert rows(pivot_values(long, "name")) == [(None,), ("br",), ("len",)]
    assert discover_values(long, "name") == [None, "br", "len"]
    with pytest.raises(ValueError):
        discover_values(long, "name", limit=2)
    with pytest.raises(ValueError):
        pivot_wide(long, [], "name", "value")


@pytest.mark.parametrize("count", [3, 40])
def test_custom_aggregates_match_spark(spark, count):
    df = spark.range(2000).selectExpr(
        "id % 50 k", f"cast((id * 7) % {count} as int) name",
        "case when id % 5 > 0 then id end value",
    )
    values = list(range(count + 1))  # one without rows
    for agg in (F.count, F.sum, F.max, F.min):
        native = df.groupBy("k").pivot("name", values).agg(agg("value"))
        for given in (agg, agg.__name__):
            ours = pivot_wide(df, ["k"], "name", "value", values=values, agg=given)
            assert ours.columns == native.columns
            assert rows(ours) == rows(native)


@pytest.mark.parametrize("count", [3, 40])
def test_aggregates_that_see_nulls_match_spark(spark, count):
    df = spark.createDataFrame([(1, 0, 10), (1, 1, 20), (2, 0, None), (2, 0, None), (3, 2, 5)], "k int, name int, value int")
    values = list(range(count))
    for agg in (F.first, F.last, F.any_value, lambda c: F.count(F.lit(1)), F.collect_list):
        native = df.groupBy("k").pivot("name", values).agg(agg(F.col("value")))
        ours = pivot_wide(df, ["k"], "name", "value", values=values, agg=agg)
        assert rows(ours) == rows(native)
    with pytest.raises(ValueError):
        pivot_wide(df, ["k"], "name", "value", values=values, agg="first_value")


def test_few_numeric_columns_take_one_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 k", "cast(id % 3 as int) name", "id value")
    plan = physical_plan(pivot_wide(df, ["k"], "name", "value", values=[0, 1, 2], agg="sum"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_text_takes_one_shuffle(long):
    wide = pivot_wide(long.repartition(2), ["k"], "name", "value", values=["len", "br"])
    plan = physical_plan(wide)
    assert plan.count("Exchange hashpartitioning") == 1


def test_ordered_first(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 0), (1, "a", "second", 2), (1, "a", "first", 1), (1, "b", "x", 9)],
        "k long, name string, value string, at int",
    )
    wide = pivot_wide(df, ["k"], "name", "value", values=["a", "b"], order_by="at")
    assert rows(wide) == [(1, "first", "x")]
    numeric = df.withColumn("value", F.length("value"))
    wide = pivot_wide(numeric, ["k"], "name", "value", values=["a", "b"], order_by="at")
    assert rows(wide) == [(1, 5, 1)]


def test_multiple_keys_and_odd_names(spark):
    df = spark.createDataFrame([(1, "x", "a.b", 1), (1, "x", "c`d", 2)], "k1 int, k2 string, `n m` string, v int")
    wide = pivot_wide(df, ["k1", "k2"], "n m", "v")
    assert wide.columns == ["k1", "k2", "a.b", "c`d"]
    assert rows(wide) == [(1, "x", 1, 2)]


def test_one_pass_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    data = [(1, "a", None), (1, "a", "x"), (1, "b", "y"), (2, None, "z"), (2, "a", None), (3, "c.d", "w"), (None, "b", "n")]
    df = spark.createDataFrame(data, "k long, n string, v string")
    found = pivot_one_pass(df.mapInArrow(count, df.schema), ["k"], "n", "v", prefix="p_")
    assert rows(found) == rows(pivot_wide(df, ["k"], "n", "v", prefix="p_")) and found.columns == ["k", "p_null", "p_a", "p_b", "p_c.d"]
    assert seen.value == len(data)


def test_one_pass_of_numbers_and_few_or_many_names(spark):
    df = spark.range(600).selectExpr("id % 7 AS k", "id % 40 AS n", "CASE WHEN id % 3 > 0 THEN cast(id % 40 AS double) END AS v")
    assert rows(pivot_one_pass(df, ["k"], "n", "v")) == rows(pivot_wide(df, ["k"], "n", "v"))
    assert rows(pivot_one_pass(df.where("n < 0"), ["k"], "n", "v")) == []
    with pytest.raises(ValueError, match="more than 39"):
        pivot_one_pass(df, ["k"], "n", "v", max_values=39)
    with pytest.raises(ValueError, match="keys"):
        pivot_one_pass(df, [], "n", "v")
