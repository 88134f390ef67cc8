"""Catalogue-shaped relations derived from the TPC-H-like test tables.

Items come from ``part``, attribute values from ``lineitem``, per-customer rules from
``customer`` (they grow with the data) and draft formulas from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.metadata import FORMULA_SCHEMA, load_metadata
from fieldloom.operators.schema import apply_aliases
from fieldloom.sources.catalogue import ALIASES, load_catalogue

# Part types that are catalogue categories; items of other types are uncategorised.
CATEGORIES = {"ECONOMY": 10001, "MEDIUM": 10002, "STANDARD": 10003, "SMALL": 10004, "LARGE": 10005}

FLAGS = ("A", "N", "R")
LINES = tuple(range(1, 8))
ATTRIBUTE_NAMES = tuple(f"{flag}{line}" for flag in FLAGS for line in LINES)

# Rules over plain item columns: (category, field, formula).
BASIC_RULES = (
    (10001, "short_description", '[brand_name]&" "&[part_number]&"-custom"'),
    (10001, "long_description", "[short_description]"),
    (10002, "brand_name", "[a_my_part_number]"),
    (10002, "long_description", '[long_description]&"/"&[qty_available]&" @ "&[price]'),
    (10003, "short_description", '[short_description] & bare & "x&y"'),
    (10003, "qty_available", '[qty_available]&" pcs"'),
    (10003, "brand_name", '"x&y"&[brand_name]'),
    (10004, "short_description", '""'),
    (10004, "long_description", ""),
    (10005, "qty_available", "abc"),
    (10005, "brand_name", "[brand_name]&[long_description]"),
    (10005, "short_description", "&"),
)

# Rules over widened items, reading and writing attributes and custom fields.
WIDE_RULES = (
    (10001, "item_name", "[invoice_description]"),
    (10001, "short_description", '[item_name]&" no. "&[part_number]'),
    (10002, "skew", "[my_part_number]"),
    (10002, "long_description", '[skew]&"/"&[a_A1]'),
    (10003, "long_description", '[a_N2]&"-"&[a_R3]&[long_description]'),
    (10004, "short_description", '[a_R7]&" "&[price]'),
    (10005, "item_name", '[item_name]&" x "&[qty_available]'),
)

# The same before some changes: another literal, a rule that came later, one that has gone.
EARLIER_WIDE_RULES = (
    (10001, "item_name", "[invoice_description]"),
    (10001, "short_description", '[item_name]&" number "&[part_number]'),
    (10002, "skew", "[my_part_number]"),
    (10002, "long_description", '[skew]&"/"&[a_A1]'),
    (10003, "long_description", '[a_N2]&"-"&[a_R3]&[long_description]'),
    (10003, "short_description", '"gone"'),
    (10004, "short_description", '[a_R7]&" "&[price]'),
)

# Rules over order lines, one category per line number.
LINE_RULES = tuple(
    (line, field, formula)
    for line in LINES
    for field, formula in (
        ("label", f'"L{line}-"&[l_orderkey]&"/"&[l_partkey]&"/"&[l_suppkey]'),
        ("price_text", "[price]" if line % 2 else '[l_returnflag]&[l_linestatus]&" "&[price]'),
    )
    if (line, field) != (7, "label")
)

SQL_RULES = (
    (10001, "price", "price - (price * qty_available / 100)"),
    (10001, "short_description", "concat(brand_name, ' ', my_part_number)"),
    (10002, "price", "price - 5"),
    (10003, "short_description", "concat(short_description, ' ', coalesce(long_description, '?'))"),
)

ITEM_ALIASES = {"id": "item_id"} | {
    c: c
    for c in (
        "part_number brand_name my_part_number short_description long_description "
        "invoice_description qty_available price status"
    ).split()
}
ENTITY_ALIASES = ALIASES | {"item": ITEM_ALIASES}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def category_of(part_type: Column) -> Column:
    result = F.lit(None).cast("long")
    for name, category in CATEGORIES.items():
        result = F.when(part_type == name, F.lit(category).cast("long")).otherwise(result)
    return result


def item(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return read(spark, sf_dir, "part").select(
        key.alias("id"),
        F.concat(F.lit("P"), key).alias("part_number"),
        F.col("p_brand").alias("brand_name"),
        F.concat("p_type", F.lit("-"), size).alias("my_part_number"),
        F.col("p_name").alias("short_description"),
        F.when(size >= 10, F.col("p_type")).alias("long_description"),
        F.concat("p_brand", F.lit(" "), "p_name").alias("invoice_description"),
        size.alias("qty_available"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.when(size >= 25, "ACTIVE").otherwise("INACTIVE").alias("status"),
    )


def item_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item in its type's category by default, large sizes also in the first one."""
    key, category = F.col("p_partkey"), category_of(F.col("p_type"))
    also = (F.col("p_size") >= 40) & (F.col("p_type") != "ECONOMY")

    def link(suffix: int, category: Column, default: bool) -> Column:
        return F.struct(
            (key * 10 + suffix).alias("id"),
            category.alias("category_id"),
            key.alias("item_id"),
            F.lit(default).alias("default_category"),
        )

    links = F.array_compact(
        F.array(
            F.when(category.isNotNull(), link(0, category, True)),
            F.when(also, link(1, F.lit(CATEGORIES["ECONOMY"]).cast("long"), False)),
        )
    )
    return read(spark, sf_dir, "part").select(F.explode(links).alias("l")).select("l.*")


def attribute(spark: SparkSession) -> DataFrame:
    """One attribute per return flag and line number, ids by position."""
    names = F.array(*[F.lit(n) for n in ATTRIBUTE_NAMES])
    return spark.range(1, len(ATTRIBUTE_NAMES) + 1).select(
        "id", F.element_at(names, F.col("id").cast("int")).alias("attribute_name")
    )


def item_attribute_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest well-discounted quantity per part, flag and line; null where none is."""
    flag = F.array_position(F.array(*[F.lit(f) for f in FLAGS]), F.col("l_returnflag"))
    attribute_id = (flag - 1) * len(LINES) + F.col("l_linenumber")
    quantity = F.when(F.col("l_discount") >= 0.03, F.col("l_quantity"))
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", attribute_id.alias("attribute_id"))
        .agg(F.max(quantity).cast("long").cast("string").alias("attribute_value"))
        .select(
            (F.col("l_partkey") * 100 + F.col("attribute_id")).alias("id"),
            "attribute_value",
            "attribute_id",
            F.col("l_partkey").alias("item_id"),
        )
    )


def custom_field(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "item_name"), (2, "skew")], "id bigint, field_name string")


def item_custom_field_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_name is null for small sizes, skew is absent for uncategorised types."""
    key = F.col("p_partkey")

    def value(field: int, text: Column) -> Column:
        return F.struct(
            (key * 10 + field).alias("id"),
            text.alias("custom_field_value"),
            F.lit(field).cast("long").alias("custom_field_id"),
            key.alias("item_id"),
        )

    values = F.array_compact(
        F.array(
            value(1, F.when(F.col("p_size") > 5, F.col("p_name"))),
            F.when(F.col("p_type") != "PROMO", value(2, F.col("p_brand"))),
        )
    )
    return read(spark, sf_dir, "part").select(F.explode(values).alias("v")).select("v.*")


def stored_catalogue(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six entities as they are stored."""
    return {
        "item": item(spark, sf_dir),
        "item_category": item_category(spark, sf_dir),
        "attribute": attribute(spark),
        "item_attribute_value": item_attribute_value(spark, sf_dir),
        "custom_field": custom_field(spark),
        "item_custom_field_value": item_custom_field_value(spark, sf_dir),
    }


def earlier_catalogue(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same entities before some changes: small items had other names, top values of one
    attribute another unit, sizes above 48 no second category, and MEDIUM items no ``skew``."""
    now = stored_catalogue(spark, sf_dir)
    small, large = F.col("qty_available") <= 2, F.col("qty_available") > 48
    ids = now["item"].where(large).select(F.col("id").alias("item_id"))
    medium = now["item"].where(F.col("my_part_number").startswith("MEDIUM")).select(F.col("id").alias("item_id"))
    links, values = now["item_category"], now["item_custom_field_value"]
    second = F.col("default_category")
    return now | {
        "item": now["item"].withColumn("short_description", F.when(small, F.upper("short_description")).otherwise(F.col("short_description"))),
        "item_category": links.where(second).unionByName(links.where(~second).join(ids, "item_id", "left_anti")),
        "item_attribute_value": now["item_attribute_value"].withColumn(
            "attribute_value",
            F.when((F.col("attribute_id") == 1) & (F.col("attribute_value") == "50"), "fifty").otherwise(F.col("attribute_value")),
        ),
        "item_custom_field_value": values.where(F.col("custom_field_id") == 1).unionByName(
            values.where(F.col("custom_field_id") == 2).join(medium, "item_id", "left_anti")
        ),
    }


def catalogue(spark: SparkSession, sf_dir: str, stored: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The six entities under their aliases."""
    stored = stored or stored_catalogue(spark, sf_dir)
    return load_catalogue(
        lambda entity, aliases: apply_aliases(stored[entity], aliases), ENTITY_ALIASES
    )


def rules(spark: SparkSession, table) -> DataFrame:
    """A literal rule set in the shape of loaded formula metadata."""
    return spark.createDataFrame(
        [(category, field, text, i) for i, (category, field, text) in enumerate(table)],
        FORMULA_SCHEMA,
    )


def customer_rule_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Formula metadata with one category per customer, in its three stored tables."""
    customer = read(spark, sf_dir, "customer")
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    note = (
        F.when(segment == "HOUSEHOLD", '[order_note] & checked & "x&y"')
        .when(segment == "MACHINERY", F.concat(F.lit('"'), "c_name", F.lit('"&[a_o_orderpriority]')))
        .when(segment == "FURNITURE", "")
        .when(segment == "AUTOMOBILE", "[a_order_label]&[total]")
        .otherwise('""')
    )
    code = (
        F.when(nation < 8, "[priority_code]")
        .when(nation < 16, '"N"&[priority_code]')
        .otherwise("fixed")
    )

    def rule(k: int, field: int, text: Column) -> Column:
        return F.struct(
            (key * 10 + k).alias("id"),
            (key * 2 + 1).alias("category_field_id"),
            F.lit(field).cast("long").alias("field_id"),
            text.alias("formula_definition"),
        )

    label = F.concat(F.lit('[o_orderstatus]&"-"&[o_orderkey]&"@'), "c_name", F.lit('"'))
    revised = F.when(F.col("c_acctbal") < 0, rule(4, 1, F.lit('"hold "&[o_orderkey]')))
    all_rules = F.array_compact(
        F.array(rule(1, 1, label), rule(2, 2, note), rule(3, 3, code), revised)
    )
    return {
        "category_field": customer.select((key * 2 + 1).alias("id"), key.alias("category_id")),
        "formula": customer.select(F.explode(all_rules).alias("r")).select("r.*"),
        "lu_field_name": spark.createDataFrame(
            [(1, "order_label"), (2, "order_note"), (3, "priority_code")],
            "id bigint, field_name string",
        ),
    }


def customer_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = customer_rule_tables(spark, sf_dir)
    return load_metadata(tables["category_field"], tables["formula"], tables["lu_field_name"])


def chained_rules(spark: SparkSession, sf_dir: str, circles: bool = False) -> DataFrame:
    """One category per customer whose fields read each other, in another direction by nation;
    with ``circles`` later versions make some of them depend on each other."""
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")

    def of_nation(one: Column | str, two: Column | str, three: str) -> Column:
        return F.when(nation < 9, F.lit(one)).when(nation < 17, F.lit(two)).otherwise(F.lit(three))

    tagged = F.concat(F.lit('[o_orderstatus]&"-"&[o_orderkey]&"'), segment, F.lit('"'))
    texts = {
        "order_label": of_nation(tagged, "[priority_code]&[order_note]", "[order_note]"),
        "order_note": of_nation('[a_order_label]&"/"&[total]', '[o_orderstatus]&"+"&[priority_code]', '[order_note]&"~"'),
        "priority_code": of_nation('[order_note]&"!"', '"P"&[o_orderpriority]', ""),
    }
    rules = [
        F.struct(F.lit(f).alias("field_name"), t.alias("formula"), F.lit(k).cast("long").alias("formula_id"))
        for k, (f, t) in enumerate(texts.items())
    ]
    if circles:
        later = F.struct(F.lit("order_label").alias("field_name"), F.lit("[Priority_Code]").alias("formula"), F.lit(9).cast("long").alias("formula_id"))
        rules.append(F.when(F.col("c_acctbal") < 0, later))
    each = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("category_id"), F.explode(F.array_compact(F.array(*rules))).alias("r"))
    return each.select("category_id", "r.field_name", "r.formula", "r.formula_id")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items, categorised by customer."""
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("category_id"),
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        F.lit(None).cast("string").alias("order_label"),
        F.col("o_orderpriority").alias("order_note"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_code"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as items, categorised by line number."""
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("l_linenumber").cast("long").alias("category_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_returnflag").alias("label"),
        F.lit(None).cast("string").alias("price_text"),
    )


def draft_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One formula per document around its whole text: valid, broken or unresolvable."""
    text, lang, source = F.col("text"), F.col("lang"), F.col("source")
    shapes = [
        F.concat(F.lit('"'), text, F.lit('"')),
        F.concat(F.lit("["), text, F.lit("]")),
        text,
        F.concat(F.lit("["), lang, F.lit(']&"'), text, F.lit('"')),
        F.concat(F.lit("[a_"), source, F.lit(']&"'), text, F.lit('"&['), lang, F.lit("]")),
        F.concat(F.lit("[doc_id] & "), text),
        F.concat(F.lit("["), lang, F.lit("]&["), source, F.lit("]&[ padded ]")),
        F.concat(F.lit('"'), text),
        F.lit(""),
    ]
    shape = F.pmod("n_chars", F.lit(len(shapes)))
    formula = F.lit(None).cast("string")
    for i, made in enumerate(shapes):
        formula = F.when(shape == i, made).otherwise(formula)
    return read(spark, sf_dir, "documents").select("doc_id", formula.alias("formula"))
