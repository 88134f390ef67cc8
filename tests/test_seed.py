import pytest
from conftest import rows
from seed import ITEMS, catalogue, formulas, table

from fieldloom.functions.metadata import formula_map, targets
from fieldloom.plans import pipeline
from fieldloom.sinks.tables import upsert

TARGETS = ["item_name", "skew", "short_description", "long_description"]

SNAPSHOT = [
    (10001, "this is invoice description", "retro", "mega_itemPartNo001custom_desc",
     "this is long description"),
    (10002, "mega_item", "mypart002", None, "retro"),
]
SEQUENTIAL = [
    (10001, "this is invoice description", "retro",
     "this is invoice descriptionPartNo001custom_desc", "this is long description"),
    (10002, "mega_item", "mypart002", None, "mypart002"),
]


@pytest.mark.parametrize("form", ["compiled", "lookup"])
@pytest.mark.parametrize("mode,expected", [("snapshot", SNAPSHOT), ("sequential", SEQUENTIAL)])
@pytest.mark.parametrize("limit_bytes", [None, 0])
def test_enrichment(spark, form, mode, expected, limit_bytes):
    result = pipeline.enrich(
        catalogue(spark), formulas(spark), mode=mode, order=TARGETS, form=form,
        limit_bytes=limit_bytes,
    )
    assert rows(result.select("category_item_id", *TARGETS)) == expected


def test_all_attributes_are_pivoted_on_request(spark):
    result = pipeline.enrich(catalogue(spark), formulas(spark), referenced_only=False)
    assert rows(result.select("category_item_id", "breadth", "length")) == [
        (10001, None, "lenValue"), (10002, None, None),
    ]


def test_metadata(spark):
    found = {r["category_id"]: r["formulas"] for r in formula_map(formulas(spark)).collect()}
    assert found == {
        10001: {
            "item_name": "[invoice_description]",
            "short_description": '[item_name]&[part_number]&"custom_desc"',
        },
        10002: {"skew": "[my_part_number]", "long_description": "[skew]"},
    }
    assert rows(targets(formulas(spark))) == sorted((t,) for t in TARGETS)


def test_write_back_touches_the_item_columns_only(spark):
    enriched = pipeline.enrich(catalogue(spark), formulas(spark))
    written, skipped = pipeline.write_back(enriched)
    assert skipped == []
    assert len(written.columns) == 21 and "id" in written.columns
    assert not {"item_name", "skew", "status"} & set(written.columns)

    stored = upsert(table(spark, "item"), written, ["id"])
    found = {r["id"]: r for r in stored.collect()}
    assert found[10001]["short_description"] == "mega_itemPartNo001custom_desc"
    assert found[10002]["long_description"] == "retro"
    for item in ITEMS:
        for column in ("status", "qty_available", "package_length", "upc"):
            assert found[item["id"]][column] == item[column]
