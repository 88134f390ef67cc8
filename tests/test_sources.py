import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F
from seed import catalogue

from fieldloom.operators import schema
from fieldloom.sources import jdbc
from fieldloom.sources.catalogue import ALIASES, jdbc_reader, load_catalogue, parquet_reader
from fieldloom.sources.scan import scan_aliased


def test_aliased_scan_reads_only_its_columns(spark):
    df = scan_aliased(
        spark, "/root/testdata/sf0.001/part.parquet", {"p_partkey": "item_id", "p_name": "name"}
    )
    assert df.columns == ["item_id", "name"]
    schema_read = physical_plan(df).split("ReadSchema: ")[1]
    assert schema_read.startswith("struct<p_partkey:bigint,p_name:string>")


def test_jdbc_queries():
    assert jdbc.aliased_query("prod.item", {"id": "item_id", "upc": "upc"}) == (
        "(SELECT id AS item_id, upc AS upc FROM prod.item) prod_item_alias"
    )
    assert "MIN(id)" in jdbc.bounds_query("t", "id")
    assert jdbc.metadata_query("cf", "f", "fn").count("INNER JOIN") == 2


class Recorder:
    """Stands in for a session: records what would be read over JDBC."""

    def __init__(self, bounds=(3, 90)):
        self.calls, self.bounds, self.read = [], bounds, self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.bounds


def test_partitioned_read_options():
    session = Recorder()
    jdbc.read_jdbc_partitioned(session, "u", "t", {"id": "item_id"}, "item_id", {"user": "x"}, 1, 50, 5)
    assert session.calls == [
        ("(SELECT id AS item_id FROM t) t_alias",
         {"column": "item_id", "lowerBound": 1, "upperBound": 50, "numPartitions": 5,
          "properties": {"user": "x", "fetchsize": "10000"}}),
    ]
    derived = Recorder()
    jdbc.read_jdbc_partitioned(derived, "u", "t", {"id": "item_id"}, "item_id")
    assert (derived.calls[1][1]["lowerBound"], derived.calls[1][1]["upperBound"]) == (3, 90)
    empty = Recorder((None, None))
    jdbc.read_jdbc_partitioned(empty, "u", "t", {"id": "item_id"}, "item_id")
    assert empty.calls[1][1]["upperBound"] == 0
    with pytest.raises(ValueError):
        jdbc.read_jdbc_partitioned(session, "u", "t", {"id": "item_id"}, "id")


def test_metadata_read():
    plain, ranged = Recorder(), Recorder()
    jdbc.read_metadata(plain, "u")
    assert set(plain.calls[0][1]) == {"properties"}
    jdbc.read_metadata(ranged, "u", lower=1, upper=10_000, partitions=8)
    assert ranged.calls[0][1]["numPartitions"] == 8
    derived = Recorder((4, 40))
    jdbc.read_metadata(derived, "u", partitions=3, fetch_size=None)
    assert derived.calls[0][0] == jdbc.bounds_query("category_field", "category_id")
    assert (derived.calls[1][1]["lowerBound"], derived.calls[1][1]["upperBound"]) == (4, 40)
    assert derived.calls[1][1]["properties"] == {}


def test_catalogue_readers(spark, tmp_path):
    for entity, aliases in ALIASES.items():
        source = catalogue(spark)[entity].withColumnsRenamed({a: c for c, a in aliases.items()})
        source.withColumn("unread", F.lit(1)).write.parquet(str(tmp_path / f"{entity}.parquet"))
    loaded = load_catalogue(parquet_reader(spark, str(tmp_path)))
    assert {e: df.columns for e, df in loaded.items()} == {
        e: list(a.values()) for e, a in ALIASES.items()
    }
    session = Recorder()
    load_catalogue(jdbc_reader(session, "u", "stock"))
    assert len(session.calls) == 12
    assert session.calls[1][0].endswith("FROM stock.item) stock_item_alias")


def test_alias_maps():
    assert len(ALIASES["item"]) == 24
    inverted = schema.invert_aliases(
        {"id": "item_id", "a": "a", "status": "status"}, ["status"], {"id": "category_item_id"}
    )
    assert inverted == {"category_item_id": "id", "a": "a"}


def test_schema_alignment(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, d int")
    renamed = schema.rename_to_target(df, {"a": "x", "nope": "y", "d": "d"})
    assert renamed.columns == ["x", "b.c", "d"]
    kept, skipped = schema.select_existing(renamed, ["d", "gone", "b.c"])
    assert kept.columns == ["d", "b.c"] and skipped == ["gone"]
    assert rows(schema.restore_schema(kept, df.select("`b.c`"))) == [(2,)]
    assert schema.has_column(df, "A") and not schema.has_column(df, "z")
    with pytest.raises(ValueError):
        schema.select_existing(df, ["none"])
