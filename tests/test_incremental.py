import pytest
from conftest import above, optimized_plan, rows

from fieldloom.functions.metadata import from_map
from fieldloom.plans import incremental, job
from fieldloom.plans import testbed as tb
from fieldloom.sinks.tables import upsert

SF_DIR = "/root/testdata/sf0.001"
OPTIONS = {"aliases": tb.ITEM_ALIASES, "read_only": ["status"]}


def full_run(tables, rules, target, **options):
    found, _ = incremental.enriched_rows(tables, rules, **OPTIONS, **options)
    return upsert(target, found, ["id"], unique="assume")


@pytest.fixture(scope="module")
def runs(spark):
    """An earlier run with its state, and what there is now."""
    stored = tb.earlier_catalogue(spark, SF_DIR)
    tables, rules = tb.catalogue(spark, SF_DIR, stored), tb.rules(spark, tb.EARLIER_WIDE_RULES)
    before = incremental.run_state(tables, rules, stored["item"], OPTIONS)
    previous = full_run(tables, rules, stored["item"]).cache()
    now_stored = tb.stored_catalogue(spark, SF_DIR)
    return before, previous, tb.catalogue(spark, SF_DIR, now_stored), now_stored["item"]


def test_fingerprints_do_not_depend_on_order(spark):
    rules = from_map(spark, {1: {"a": "x", "b": "y"}, 2: {"a": "x"}, 3: {"b": "x"}})
    found = {r[0]: r[1] for r in incremental.category_fingerprints(rules).collect()}
    turned = {r[0]: r[1] for r in incremental.category_fingerprints(rules.orderBy("formula", ascending=False).repartition(3)).collect()}
    assert found == turned and len(set(found.values())) == 4


@pytest.mark.parametrize("change", [{"a": "x", "b": "z"}, {"a": "y", "b": "x"}, {"a": "x"}, {"a": "x", "b": ""}, {"a": "x", "b": "y", "c": "z"}])
def test_a_changed_category_is_seen(spark, change):
    kept = {2: {"a": "x"}}
    before, now = (incremental.category_fingerprints(from_map(spark, kept | {1: r})) for r in ({"a": "x", "b": "y"}, change))
    assert [r[0] for r in incremental._changed(before, now, "category_id").collect()] == [1]


def test_what_does_not_count_changes_nothing(spark):
    before = from_map(spark, {1: {"a": "x"}})
    now = spark.createDataFrame([(1, "A", "old", 0), (1, "a", "x", 5), (1, "b", "", 6), (None, "c", "x", 7)], before.schema)
    assert incremental._changed(*map(incremental.category_fingerprints, (before, now)), "category_id").count() == 0


def test_nulls_and_neighbours_are_told_apart(spark):
    target = spark.createDataFrame([(1, None, "x"), (2, "x", None), (3, "", "x"), (4, "x", "x")], "id long, p string, q string")
    tables = {k: t.limit(0) for k, t in tb.catalogue(spark, SF_DIR).items()}
    found = incremental.item_fingerprints(tables, target.withColumn("id", target["id"] * 0))
    assert found.count() == 1
    one_by_one = {incremental.item_fingerprints(tables, target.where(f"id = {i}").selectExpr("0L AS id", "p", "q")).first()[1] for i in (1, 2, 3, 4)}
    assert len(one_by_one) == 4


def test_changed_items_and_categories(spark, runs):
    before, previous, tables, target = runs
    rules = tb.rules(spark, tb.WIDE_RULES)
    now = incremental.run_state(tables, rules, target, OPTIONS)
    ids = incremental.affected_items(before, now, tables["item_category"])
    n, everything = ids.count(), target.count()
    assert 0 < n < everything
    for limit in (None, 0):
        found = incremental.enrich_changed(tables, rules, target, previous, before, now, limit_bytes=limit, **OPTIONS)
        assert rows(found) == rows(full_run(tables, rules, target))


def test_nothing_changed(spark, runs):
    _, _, tables, target = runs
    rules = tb.rules(spark, tb.WIDE_RULES)
    state = incremental.run_state(tables, rules, target, OPTIONS)
    assert incremental.affected_items(state, state, tables["item_category"]).count() == 0
    previous = full_run(tables, rules, target)
    assert rows(incremental.enrich_changed(tables, rules, target, previous, state, state, **OPTIONS)) == rows(previous)


def test_other_options_affect_every_item(spark, runs):
    _, _, tables, target = runs
    rules = tb.rules(spark, tb.WIDE_RULES)
    before, now = (incremental.run_state(tables, rules, target, {"syntax": s}) for s in ("lenient", "strict"))
    assert incremental.affected_items(before, now, tables["item_category"]).count() == target.count()


def test_unchanged_items_are_not_pivoted(spark, runs):
    before, previous, tables, target = runs
    rules = tb.rules(spark, tb.WIDE_RULES)
    now = incremental.run_state(tables, rules, target, OPTIONS)
    ids = incremental.affected_items(before, now, tables["item_category"]).cache()
    some = incremental.restrict(tables, ids)
    n = some["item_attribute_value"].count()
    assert n == tables["item_attribute_value"].join(ids.withColumnRenamed("item_id", "attribute_item_id"), "attribute_item_id").count()
    assert n < tables["item_attribute_value"].count()
    found = incremental.enrich_changed(tables, rules, target, previous, before, now, **OPTIONS)
    plan = optimized_plan(found)
    for key in ("attribute_item_id", "custom_field_item_id"):
        over = [line.split()[0] for line in above(plan[plan.index(f"Aggregate [{key}") :], "Relation")]
        assert "LeftSemi" in plan and over[-1] == "Aggregate" and "Join" in over[:-1]


def test_items_that_went_and_came(spark, runs):
    _, _, tables, target = runs
    rules = tb.rules(spark, tb.WIDE_RULES)
    gone = target.where("id <= 5")
    earlier = target.where("id > 5").unionByName(target.limit(1).selectExpr("-7L AS id", *target.columns[1:]))
    earlier_tables = tables | {"item": earlier.withColumnRenamed("id", "item_id")}
    before = incremental.run_state(earlier_tables, rules, earlier, OPTIONS)
    now = incremental.run_state(tables, rules, target, OPTIONS)
    ids = {r[0] for r in incremental.affected_items(before, now, tables["item_category"]).collect()}
    assert ids == {-7} | {r[0] for r in gone.select("id").collect()}
    previous = full_run(earlier_tables, rules, earlier)
    found = incremental.enrich_changed(tables, rules, target, previous, before, now, **OPTIONS)
    assert rows(found) == rows(full_run(tables, rules, target))


def test_job_keeps_and_uses_its_state(spark, tmp_path):
    from seed import TABLES, table

    for name in TABLES:
        table(spark, name).write.parquet(f"{tmp_path}/{name}.parquet")
    job.main(["--tables", str(tmp_path), "--output", f"{tmp_path}/one", "--state", f"{tmp_path}/s1"])
    job.main(["--tables", str(tmp_path), "--output", f"{tmp_path}/two", "--state", f"{tmp_path}/s2", "--previous", f"{tmp_path}/one", "--previous-state", f"{tmp_path}/s1"])
    assert rows(spark.read.parquet(f"{tmp_path}/two")) == rows(spark.read.parquet(f"{tmp_path}/one"))
    with pytest.raises(SystemExit):
        job.main(["--tables", str(tmp_path), "--output", f"{tmp_path}/x", "--previous", f"{tmp_path}/one"])
