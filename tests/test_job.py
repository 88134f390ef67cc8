import pytest
from conftest import rows
from seed import TABLES, catalogue, formulas, table

from fieldloom.functions.metadata import from_map
from fieldloom.plans import job
from fieldloom.plans.pipeline import enrich
from fieldloom.sinks import jdbc
from fieldloom.sinks.tables import upsert


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalogue")
    for name in TABLES:
        table(spark, name).write.parquet(str(root / f"{name}.parquet"))
    return root


def test_parquet_job(spark, stored):
    output = str(stored / "item_new.parquet")
    job.main(["--tables", str(stored), "--output", output])
    written = spark.read.parquet(output)
    assert written.dtypes == table(spark, "item").dtypes
    assert rows(written.select("id", "short_description", "long_description", "status")) == [
        (10001, "mega_itemPartNo001custom_desc", "this is long description", "INACTIVE"),
        (10002, None, "retro", "ACTIVE"),
    ]


LOSSY = {10001: {"qty_available": "[part_number]"}, 10002: {"qty_available": '"7"'}}


def test_a_value_that_does_not_fit_stops_the_job(spark):
    found, _ = job.enriched_rows(catalogue(spark), from_map(spark, LOSSY))
    with pytest.raises(Exception, match="qty_available does not fit its type: PartNo001"):
        found.collect()


@pytest.mark.parametrize("on_loss, stored", [("warn", None), ("keep", 10000)])
def test_values_that_do_not_fit_are_counted(spark, caplog, on_loss, stored):
    found, counted = job.enriched_rows(catalogue(spark), from_map(spark, LOSSY), on_loss)
    target = table(spark, "item")
    merged = upsert(target, found, ["id"], unique="assume")
    assert merged.columns == target.columns
    assert rows(merged.select("id", "qty_available")) == sorted([(10001, stored), (10002, 7)])
    job._warn(counted, on_loss)
    assert "1 values of qty_available" in caplog.text


def test_names_on_both_sides_are_refused_or_prefixed(spark):
    tables = catalogue(spark)
    tables["attribute"] = tables["attribute"].replace("length", "upc", "attribute_name")
    rules = from_map(spark, {10001: {"short_description": "[upc]"}})
    with pytest.raises(ValueError, match="ambiguous"):
        enrich(tables, rules)
    prefixed = from_map(spark, {10001: {"short_description": "[upc]&[attr_upc]"}})
    for referenced_only in (True, False):
        found = enrich(
            tables, prefixed, referenced_only=referenced_only, prefix={"attribute": "attr_"}
        )
        assert rows(found.select("short_description"))[-1] == ("upc 123lenValue",)


def test_the_source_is_not_overwritten(spark, stored):
    with pytest.raises(ValueError):
        job.run_parquet(spark, str(stored), f"{stored}/item.parquet")


@pytest.mark.parametrize("arguments", [[], ["--tables", "x"], ["--tables", "x", "--url", "y"]])
def test_arguments(arguments):
    with pytest.raises(SystemExit):
        job.main(arguments)


def test_an_item_in_two_categories_is_written_once(spark):
    tables = catalogue(spark)
    second = spark.createDataFrame([(9003, 10002, 10001, False)], tables["item_category"].schema)
    tables["item_category"] = tables["item_category"].union(second)
    found, _ = job.enriched_rows(tables, formulas(spark))
    assert rows(found.select("id", "long_description")) == [
        (10001, "this is long description"), (10002, "retro"),
    ]


def test_jdbc_job_reads_and_writes_by_table_name(spark, monkeypatch):
    """The wiring, without a database."""
    seen = {}

    def reader(spark, url, schema, properties, partitions, even):
        seen["read"] = (url, schema, partitions)
        return lambda entity, aliases: catalogue(spark)[entity]

    def metadata(spark, url, *names):
        seen["metadata"] = names[:3]
        return formulas(spark)

    def write(df, url, table, columns, keys, properties=None, dialect=None):
        seen["write"] = (table, len(columns), keys, df.count())

    monkeypatch.setattr(job, "jdbc_reader", reader)
    monkeypatch.setattr(job, "read_metadata", metadata)
    monkeypatch.setattr(job, "jdbc_upsert", write)
    job.run_jdbc(spark, "jdbc:x", "prod")
    assert seen == {
        "read": ("jdbc:x", "prod", 10),
        "metadata": ("prod.category_field", "prod.formula", "prod.lu_field_name"),
        "write": ("prod.item", 21, ["id"], 2),
    }
    assert jdbc.BATCH_SIZE == 5000


@pytest.mark.parametrize("form, most", [("auto", 7), ("lookup", 11)])
def test_few_jobs_before_any_action(spark, form, most):
    from fieldloom.plans import testbed as tb

    tables, rules = tb.catalogue(spark, "/root/testdata/sf0.001"), tb.rules(spark, tb.WIDE_RULES)
    spark.sparkContext.setJobGroup(f"eager {form}", form)
    try:
        enrich(tables, rules, form=form)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"eager {form}")
    assert len(jobs) <= most
