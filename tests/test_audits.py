from conftest import rows
from pyspark.sql import functions as F

from fieldloom.operators import audits


def test_duplicate_keys(spark):
    df = spark.createDataFrame(
        [(1, True), (1, False), (2, True), (2, True), (None, True), (None, True)],
        "item long, main boolean",
    )
    assert rows(audits.duplicate_keys(df, ["item"])) == [(1, 2), (2, 2)]
    assert rows(audits.duplicate_keys(df, ["item"], F.col("main"))) == [(2, 2)]
    equal = audits.duplicate_keys(df, ["item"], F.col("main"), nulls="equal")
    assert rows(equal) == [(None, 2), (2, 2)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(audits.orphans(child, parent, [("fk", "id")])) == [(9, 2)]
    assert rows(audits.orphans(child, parent.toDF("fk"), [("fk", "fk")])) == [(9, 2)]


def test_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert rows(audits.nulls(df, ["a", "b"])) == [("a", 2, 0), ("b", 2, 1)]


def test_domain(spark):
    df = spark.createDataFrame([("INT",), ("CHAR",), ("TEXT",), ("TEXT",), (None,)], "t string")
    assert rows(audits.domain(df, "t", ["INT", "DECIMAL", "CHAR"])) == [("TEXT", 2)]


def test_lengths_and_decimals(spark):
    df = spark.createDataFrame([("abcd", 1.0), ("ab", 123456789.5), (None, None)], "s string, n double")
    assert rows(audits.lengths(df, {"s": 3})) == [("s", 3, 1, 4)]
    assert rows(audits.decimals(df, {"n": (10, 2)})) == [("n", 3, 1)]


def test_unresolved(spark):
    formulas = spark.createDataFrame([("[a]&[a_len]&[gone]",), ("[gone]",), ("x",)], "formula string")
    names = spark.createDataFrame([("a",), ("len",)], "name string")
    assert rows(audits.unresolved(formulas, names)) == [("gone", 2)]


def test_suite_in_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    data = [(1, "a", True, 1.5, None), (1, "a", False, 1000.0, "x"), (2, "b", True, None, "toolong"), (None, "b", True, 2.0, "y"), (None, "b", None, 3.0, "y")]
    df = spark.createDataFrame(data, "id long, k string, flag boolean, price double, note string")
    spark.sparkContext.setJobGroup("suite", "suite")
    try:
        found = audits.suite(
            df.mapInArrow(count, df.schema), keys=[["id"], ["id", "k"], ["k", "flag"], ["note"]], not_null=["id", "k"],
            domains={"k": ["a"], "flag": [True]}, lengths={"note": 3}, decimals={"price": (4, 1)},
        )
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in found.collect()] == [
        ("key", "id", 5, 2), ("key", "id, k", 5, 2), ("key", "k, flag", 5, 2), ("key", "note", 5, 2),
        ("not null", "id", 5, 2), ("not null", "k", 5, 0), ("domain", "k", 5, 3), ("domain", "flag", 5, 1),
        ("length", "note", 5, 1), ("decimal", "price", 5, 1),
    ]
    assert seen.value == 5


def test_suite_agrees_with_single_audits(spark):
    df = spark.range(500).selectExpr("id % 60 AS a", "id % 7 AS b", "CASE WHEN id % 5 > 0 THEN id % 11 END AS c")
    keys = [["a"], ["a", "b"], ["b", "c"], ["a", "b", "c"]]
    want = [audits.duplicate_keys(df, k).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for k in keys]
    assert [r["n_bad"] for r in audits.suite(df, keys).collect()] == want


def test_suite_of_sound_tables(spark):
    df = spark.range(50).selectExpr("id", "cast(id AS string) AS t")
    assert [r["n_bad"] for r in audits.suite(df, [["id"], ["t"]], ["id"], lengths={"t": 1}).collect()] == [0, 0, 0, 40]


def test_suite_without_keys_or_rows(spark):
    df = spark.createDataFrame([], "a long, b string")
    assert [tuple(r) for r in audits.suite(df, [["a"]], ["b"]).collect()] == [("key", "a", 0, 0), ("not null", "b", 0, 0)]
    assert [tuple(r) for r in audits.suite(df, not_null=["b"]).collect()] == [("not null", "b", 0, 0)]
