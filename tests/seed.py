"""The two-item catalogue used as a golden input.

Fixed values: the rows below must equal the published seed rows for the golden results to hold.
"""

from decimal import Decimal

from fieldloom.functions.metadata import load_metadata
from fieldloom.sources.catalogue import ALIASES, ITEM_COLUMNS, load_catalogue
from fieldloom.operators.schema import apply_aliases

ITEM_DDL = ", ".join(
    ["id bigint"]
    + [
        f"{c} int" if c == "qty_available"
        else f"{c} decimal(10,2)" if c.startswith("package_") or c == "volume"
        else f"{c} string"
        for c in ITEM_COLUMNS
    ]
)

ITEMS = [
    {
        "id": 10001, "part_number": "PartNo001", "brand_name": "viru@",
        "mfr_part_number": "p1manf01", "my_part_number": "mypart001", "upc": "upc 123",
        "country_of_origin": "IN", "country_of_sale": "US", "gtin": "1312312343",
        "short_description": "this is short description",
        "long_description": "this is long description",
        "feature_bullets": "new feature and old feature",
        "invoice_description": "this is invoice description", "qty_available": 10000,
        "package_length": Decimal("10.00"), "package_height": Decimal("23.00"),
        "status": "INACTIVE", "enriched_indicator": "ENRICHED", "manufacturer_status": "ACTIVE",
    },
    {
        "id": 10002, "part_number": "PartNo002", "brand_name": "audi@",
        "mfr_part_number": "p1manf02", "my_part_number": "mypart002", "upc": "1234",
        "country_of_origin": "IN", "country_of_sale": "US", "gtin": "131231234343",
        "short_description": None, "long_description": "this is long description",
        "feature_bullets": "new feature and old feature",
        "invoice_description": "this is invoice description", "qty_available": 10000,
        "package_length": Decimal("100.00"), "package_height": Decimal("25.00"),
        "status": "ACTIVE", "enriched_indicator": "ENRICHED", "manufacturer_status": "INACTIVE",
    },
]

TABLES = {
    "item": (ITEM_DDL, [tuple(i.get(c) for c in ["id", *ITEM_COLUMNS]) for i in ITEMS]),
    "item_category": (
        "id bigint, category_id bigint, item_id bigint, default_category boolean",
        [(10001, 10001, 10001, True), (10002, 10002, 10002, True)],
    ),
    "attribute": (
        "id bigint, attribute_name string, is_multivalue boolean",
        [(10001, "length", False), (10002, "breadth", True)],
    ),
    "item_attribute_value": (
        "id bigint, attribute_value string, attribute_id bigint, item_id bigint, attribute_uom string",
        [(10001, "lenValue", 10001, 10001, "cm"), (10002, None, 10002, 10002, None)],
    ),
    "custom_field": (
        "id bigint, field_name string",
        [(10001, "item_name"), (10004, "skew")],
    ),
    "item_custom_field_value": (
        "id bigint, custom_field_value string, custom_field_id bigint, item_id bigint",
        [
            (10001, "mega_item", 10001, 10001), (10002, "retro", 10004, 10001),
            (10003, "mega_item", 10001, 10002), (10004, "retro", 10004, 10002),
        ],
    ),
    "lu_field_name": (
        "id bigint, field_name string",
        [(10001, "item_name"), (10002, "skew"), (10003, "short_description"), (10004, "long_description")],
    ),
    "category_field": ("id bigint, category_id bigint", [(10001, 10001), (10002, 10002)]),
    "formula": (
        "id bigint, category_field_id bigint, field_id bigint, formula_definition string",
        [
            (10001, 10001, 10001, "[invoice_description]"),
            (10002, 10001, 10003, '[item_name]&[part_number]&"custom_desc"'),
            (10003, 10002, 10002, "[my_part_number]"),
            (10004, 10002, 10004, "[skew]"),
        ],
    ),
}


def table(spark, name):
    ddl, rows = TABLES[name]
    return spark.createDataFrame(rows, ddl)


def catalogue(spark):
    return load_catalogue(lambda entity, aliases: apply_aliases(table(spark, entity), aliases), ALIASES)


def formulas(spark):
    return load_metadata(
        table(spark, "category_field"), table(spark, "formula"), table(spark, "lu_field_name")
    )
