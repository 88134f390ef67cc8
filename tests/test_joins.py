from collections import Counter

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from fieldloom.operators.joins import (
    JoinSpec, join_chain, join_on_pairs, join_type, lookup_join, update_from,
)
from fieldloom.operators.skew import hot_keys, skew_join


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k long, v string")


@pytest.fixture(scope="module")
def other(spark):
    return spark.createDataFrame([(2, "x"), (2, "y"), (4, "z"), (None, "w")], "r long, w string")


EXPECTED = {
    "inner": [(2, "b", 2, "x"), (2, "b", 2, "y")],
    "left": [(None, "n", None, None), (1, "a", None, None), (2, "b", 2, "x"), (2, "b", 2, "y"), (3, "c", None, None)],
    "semi": [(2, "b")],
    "anti": [(None, "n"), (1, "a"), (3, "c")],
    "right": [(None, None, None, "w"), (None, None, 4, "z"), (2, "b", 2, "x"), (2, "b", 2, "y")],
}
NAMES = {
    "inner": ["inner", "cross", None], "left": ["left", "left_outer", "leftouter"],
    "semi": ["semi", "left_semi", "LEFTSEMI"], "anti": ["anti", "left_anti"],
    "right": ["right", "right_outer"],
}


@pytest.mark.parametrize("kind", sorted(EXPECTED))
def test_join_types(base, other, kind):
    for how in NAMES[kind]:
        joined = join_chain(base, [JoinSpec(other, ["r"], how)], on="k")
        assert rows(joined) == EXPECTED[kind]


def test_full(base, other):
    joined = join_chain(base, [JoinSpec(other, ["r"], "full_outer")], on="k")
    assert joined.count() == 7


@pytest.mark.parametrize("kind", ["inner", "left", "semi", "anti"])
@pytest.mark.parametrize("strategy", ["lookup", "split"])
def test_strategies_give_the_same_rows(base, other, kind, strategy):
    joined = join_chain(base, [JoinSpec(other, ["r"], kind, strategy=strategy)], on="k")
    assert rows(joined) == EXPECTED[kind]


def test_unknown_names(base, other):
    with pytest.raises(ValueError):
        join_type("sideways")
    with pytest.raises(ValueError):
        join_chain(base, [JoinSpec(other, ["nope"])], on="k")
    with pytest.raises(ValueError):
        join_chain(base, [JoinSpec(other, ["r"], strategy="magic")], on="k")
    with pytest.raises(ValueError):
        join_chain(base, [JoinSpec(None, ["r"])], on="k")
    with pytest.raises(ValueError):
        join_chain(base, [JoinSpec(other, ["r"])])


def test_default_join_column(base, other):
    renamed = other.withColumnRenamed("r", "default")
    assert join_chain(base, [JoinSpec(renamed)], on="k").count() == 2
    with pytest.raises(ValueError, match="default"):
        join_chain(base, [JoinSpec(other)], on="k")


def test_every_listed_column_must_equal_the_base_column(spark, base):
    right = spark.createDataFrame([(1, 1, "yes"), (1, 2, "no")], "c1 long, c2 long, w string")
    joined = join_chain(base, [JoinSpec(right, ["c1", "c2"])], on="k")
    assert rows(joined.select("k", "w")) == [(1, "yes")]


def test_composite_keys_and_shared_names(spark):
    left = spark.createDataFrame([(1, 1, "l"), (1, 2, "m")], "a long, b long, v string")
    right = spark.createDataFrame([(1, 2, "r"), (5, 5, "s")], "a long, b long, w string")
    keys = [("a", "a"), ("b", "b")]
    assert rows(join_chain(left, [JoinSpec(right, keys)])) == [(1, 2, "m", "r")]
    full = join_chain(left, [JoinSpec(right, keys, "full")])
    assert full.columns == ["a", "b", "v", "w"]
    assert rows(full) == [(1, 1, "l", None), (1, 2, "m", "r"), (5, 5, None, "s")]
    with pytest.raises(ValueError, match="ambiguous"):
        join_chain(left, [JoinSpec(right.withColumnRenamed("w", "v"), keys)])


def test_chain_with_pivots(spark, base):
    long = spark.createDataFrame(
        [(1, "p", "1p"), (1, "q", "1q"), (2, "q", None)], "e long, name string, value string"
    )
    spec = JoinSpec(long, ["e"], "left", group_by=["e"], pivot="name", value="value")
    joined = join_chain(base, [spec], on="k")
    assert rows(joined.select("k", "p", "q")) == [
        (None, None, None), (1, "1p", "1q"), (2, None, None), (3, None, None),
    ]
    with pytest.raises(ValueError, match="group_by"):
        join_chain(base, [JoinSpec(long, ["e"], pivot="name", value="value")], on="k")


# --- hot keys -----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are identical copies, a tenth have a null key."""
    i = F.col("id")
    return spark.range(3000).select(
        F.when(i % 3 == 0, 7).when(i % 10 == 1, None).otherwise(i % 500).cast("long").alias("k"),
        F.when(i % 3 == 0, 0).otherwise(i).alias("payload"),
    )


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(0, 400).selectExpr("id r", "concat('d', id) name")


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_splitting_changes_no_rows(skewed, dimension, how):
    facts = [tuple(r) for r in skewed.collect()]
    names = {r["r"]: r["name"] for r in dimension.collect()}
    expected = Counter(
        {
            "inner": lambda: ((k, p, k, names[k]) for k, p in facts if k in names),
            "left": lambda: ((k, p, k if k in names else None, names.get(k)) for k, p in facts),
            "semi": lambda: ((k, p) for k, p in facts if k in names),
            "anti": lambda: ((k, p) for k, p in facts if k not in names),
        }[how]()
    )
    for hot_rows in (1, 50, 10**6):
        joined = skew_join(skewed, dimension, [("k", "r")], how, hot_rows=hot_rows)
        assert Counter(tuple(r) for r in joined.collect()) == expected


def test_hot_keys_are_found(skewed):
    found = hot_keys(skewed, ["k"], 150)
    assert sorted(n for _, n in found)[-1] >= 1000
    assert len(found) == 2  # the copies and the null key


def test_copies_of_a_hot_row_are_spread(spark):
    copies = spark.range(4000).repartition(8).select(F.lit(7).cast("long").alias("k"))
    dimension = spark.createDataFrame([(7, "d")], "r long, name string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew_join(copies, dimension, [("k", "r")], "inner", hot_rows=100)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 4000
        assert len(sizes) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_hot_key_is_a_plain_join(skewed, dimension):
    assert "__salt" not in physical_plan(skew_join(skewed, dimension, [("k", "r")]))
    with pytest.raises(ValueError):
        skew_join(skewed, dimension, [("k", "r")], "full")
    with pytest.raises(ValueError):
        skew_join(skewed, dimension, [("k", "r")], hot_rows=0)


def test_unlike_key_types(spark, skewed, dimension):
    as_int = dimension.select(F.col("r").cast("int"), "name")
    joined = skew_join(skewed, as_int, [("k", "r")], "inner", hot_rows=10)
    assert joined.count() == skewed.join(dimension, F.col("k") == F.col("r")).count()


def test_map_columns_can_be_carried(spark, skewed, dimension):
    mapped = skewed.withColumn("m", F.create_map(F.lit("p"), "payload"))
    joined = skew_join(mapped, dimension, [("k", "r")], "left", hot_rows=10)
    assert joined.count() == 3000


def test_lookup_is_broadcast_only_when_it_fits(skewed, dimension):
    small = lookup_join(skewed, dimension.withColumnRenamed("r", "k"), "k", "inner")
    assert "BroadcastHashJoin" in physical_plan(small) and small.columns == ["k", "payload", "name"]
    large = lookup_join(skewed, dimension.withColumnRenamed("r", "k"), "k", "inner", limit_bytes=100)
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))


# --- update from --------------------------------------------------------------


@pytest.mark.parametrize("limit_bytes", [None, 0])
def test_update_from(spark, limit_bytes):
    small = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c2")], "id long, v string")
    large = spark.createDataFrame(
        [(1, "L1", 0), (3, None, 0), (9, "L9", 1), (9, "L9b", 2)], "id long, V string, extra int"
    )
    updated, skipped = update_from(small, large, ["id"], ["v", "gone"], limit_bytes=limit_bytes)
    assert updated.columns == small.columns and skipped == ["gone"]
    assert rows(updated) == [(1, "L1"), (2, "b"), (3, "c"), (3, "c2")]


def test_update_from_repeated_keys(spark):
    small = spark.createDataFrame([(1, "a")], "id long, v string")
    large = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id long, v string, at int")
    with pytest.raises(Exception, match="repeats a key"):
        update_from(small, large, ["id"], ["v"])[0].collect()
    assert rows(update_from(small, large, ["id"], ["v"], latest_by="at")[0]) == [(1, "y")]
    with pytest.raises(ValueError, match="join columns required"):
        update_from(small, large, [], ["v"])


def test_update_from_does_not_shuffle_what_cannot_match(spark):
    small = spark.range(10).selectExpr("id", "'s' v")
    large = spark.range(100_000).selectExpr("id", "concat('L', id) v")
    plan = physical_plan(update_from(small, large, ["id"], ["v"])[0])
    assert "BroadcastHashJoin [id#" in plan and "LeftSemi" in plan


def test_lookup_pairs_with_shared_names(spark):
    fact = spark.createDataFrame([(1, "f"), (2, "g")], "id long, v string")
    dim = spark.createDataFrame([(1, "d")], "id long, w string")
    for strategy in ("plain", "lookup", "split"):
        joined = join_on_pairs(fact, dim, [("id", "id")], "left", strategy)
        assert joined.columns == ["id", "v", "w"]
        assert rows(joined) == [(1, "f", "d"), (2, "g", None)]


def test_a_key_named_like_another_column_is_refused(spark):
    left = spark.createDataFrame([(1, 5, "l")], "item_id long, id long, v string")
    right = spark.createDataFrame([(1, "r")], "id long, w string")
    with pytest.raises(ValueError, match="ambiguous"):
        join_on_pairs(left, right, [("item_id", "id")], "full")
    assert rows(join_on_pairs(left, right, [("item_id", "id")], "semi")) == [(1, 5, "l")]
    with pytest.raises(ValueError, match="ambiguous"):
        lookup_join(left, right.withColumnRenamed("w", "v"), "id")
