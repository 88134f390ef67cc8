"""Named queries, each with an independent SQL statement of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import dependencies, inspect
from fieldloom.functions.applying import apply, current_rules
from fieldloom.functions.compiling import compile_formula
from fieldloom.functions.metadata import formula_map, latest, targets
from fieldloom.operators import audits, pivots
from fieldloom.operators.joins import JoinSpec, join_chain, lookup_join, update_from
from fieldloom.operators.pivots import pivot_values, pivot_wide
from fieldloom.operators.schema import rename_to_target, select_existing
from fieldloom.operators.sizing import settled, shared_folder
from fieldloom.plans import incremental, pipeline
from fieldloom.plans import testbed as tb
from fieldloom.sinks import buckets
from fieldloom.sinks.tables import append_rows, cast_checked, cast_losses, dedupe, upsert
from fieldloom.sources import bucketed, ranges
from fieldloom.sources.catalogue import load_catalogue
from fieldloom.sources.scan import scan_aliased

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# --- SQL statements of the derived relations ---------------------------------

CATEGORY_SQL = "CASE p_type " + " ".join(
    f"WHEN '{name}' THEN {category}" for name, category in tb.CATEGORIES.items()
) + " END"

CTES = {
    "item": """
        SELECT p_partkey AS item_id, 'P' || p_partkey AS part_number, p_brand AS brand_name,
               p_type || '-' || p_size AS my_part_number, p_name AS short_description,
               CASE WHEN p_size >= 10 THEN p_type END AS long_description,
               p_brand || ' ' || p_name AS invoice_description, p_size AS qty_available,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price,
               CASE WHEN p_size >= 25 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
        FROM part""",
    "item_category": f"""
        SELECT p_partkey * 10 AS item_category_id, CAST({CATEGORY_SQL} AS BIGINT) AS category_id,
               p_partkey AS category_item_id
        FROM part WHERE p_type <> 'PROMO'
        UNION ALL
        SELECT p_partkey * 10 + 1, 10001, p_partkey
        FROM part WHERE p_size >= 40 AND p_type <> 'ECONOMY'""",
    "categorised": """
        SELECT c.category_item_id, c.item_category_id, c.category_id, part_number, brand_name,
               my_part_number, short_description, long_description, invoice_description,
               qty_available, price, status
        FROM item i JOIN item_category c ON i.item_id = c.category_item_id""",
    "attribute_value": """
        SELECT l_partkey AS item_id, l_returnflag || l_linenumber AS attribute_name,
               CAST(CAST(max(CASE WHEN l_discount >= 0.03 THEN l_quantity END) AS BIGINT)
                    AS VARCHAR) AS attribute_value
        FROM lineitem GROUP BY 1, 2""",
    "custom_value": """
        SELECT p_partkey AS item_id, 'item_name' AS custom_field_name,
               CASE WHEN p_size > 5 THEN p_name END AS custom_field_value FROM part
        UNION ALL
        SELECT p_partkey, 'skew', p_brand FROM part WHERE p_type <> 'PROMO'""",
    "attribute_wide": "SELECT item_id, "
    + ", ".join(
        f"max(attribute_value) FILTER (WHERE attribute_name = '{n}') AS {n}"
        for n in tb.ATTRIBUTE_NAMES
    )
    + " FROM attribute_value GROUP BY item_id",
    "custom_wide": """
        SELECT item_id, max(custom_field_value) FILTER (WHERE custom_field_name = 'item_name')
                   AS item_name,
               max(custom_field_value) FILTER (WHERE custom_field_name = 'skew') AS skew
        FROM custom_value GROUP BY item_id""",
    "widened": """
        SELECT c.*, """ + ", ".join(tb.ATTRIBUTE_NAMES) + """, item_name, skew
        FROM categorised c
        LEFT JOIN attribute_wide a ON a.item_id = c.category_item_id
        LEFT JOIN custom_wide f ON f.item_id = c.category_item_id""",
    "enriched": """
        SELECT category_item_id, item_category_id, category_id, part_number, brand_name,
               my_part_number, invoice_description, qty_available, price, status, A1, N2, R3, R7,
               CASE category_id WHEN 10001 THEN concat_ws('', item_name, ' no. ', part_number)
                    WHEN 10004 THEN concat_ws('', R7, ' ', CAST(price AS VARCHAR))
                    ELSE short_description END AS short_description,
               CASE category_id WHEN 10002 THEN concat_ws('', skew, '/', A1)
                    WHEN 10003 THEN concat_ws('', N2, '-', R3, long_description)
                    ELSE long_description END AS long_description,
               CASE category_id WHEN 10001 THEN invoice_description
                    WHEN 10005 THEN concat_ws('', item_name, ' x ', CAST(qty_available AS VARCHAR))
                    ELSE item_name END AS item_name,
               CASE category_id WHEN 10002 THEN my_part_number ELSE skew END AS skew
        FROM widened""",
    "customer_rule": """
        SELECT c_custkey * 10 + 1 AS formula_id, c_custkey AS category_id,
               'order_label' AS field_name,
               '[o_orderstatus]&"-"&[o_orderkey]&"@' || c_name || '"' AS formula FROM customer
        UNION ALL
        SELECT c_custkey * 10 + 2, c_custkey, 'order_note',
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '[order_note] & checked & "x&y"'
                    WHEN 'MACHINERY' THEN '"' || c_name || '"&[a_o_orderpriority]'
                    WHEN 'FURNITURE' THEN '' WHEN 'AUTOMOBILE' THEN '[a_order_label]&[total]'
                    ELSE '""' END FROM customer
        UNION ALL
        SELECT c_custkey * 10 + 3, c_custkey, 'priority_code',
               CASE WHEN c_nationkey < 8 THEN '[priority_code]'
                    WHEN c_nationkey < 16 THEN '"N"&[priority_code]' ELSE 'fixed' END FROM customer
        UNION ALL
        SELECT c_custkey * 10 + 4, c_custkey, 'order_label', '"hold "&[o_orderkey]'
        FROM customer WHERE c_acctbal < 0""",
    "latest_rule": """
        SELECT category_id, field_name, arg_max(formula, formula_id) AS formula,
               max(formula_id) AS formula_id
        FROM customer_rule GROUP BY category_id, field_name""",
    "draft": """
        SELECT doc_id, CASE n_chars % 9
               WHEN 0 THEN '"' || text || '"' WHEN 1 THEN '[' || text || ']' WHEN 2 THEN text
               WHEN 3 THEN '[' || lang || ']&"' || text || '"'
               WHEN 4 THEN '[a_' || source || ']&"' || text || '"&[' || lang || ']'
               WHEN 5 THEN '[doc_id] & ' || text
               WHEN 6 THEN '[' || lang || ']&[' || source || ']&[ padded ]'
               WHEN 7 THEN '"' || text ELSE '' END AS formula
        FROM documents""",
    "finished": """
        SELECT o_custkey AS custkey, count(*) AS n_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total,
               max(o_orderpriority) AS priority, 'kept' AS note
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""",
    "open_orders": """
        SELECT o_custkey AS custkey, count(*) AS n_orders,
               CASE WHEN count(*) < 4
                    THEN CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) END AS total,
               min(o_orderpriority) AS priority
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey""",
}

# What each relation above reads from the others.
CTE_NEEDS = {
    "categorised": ("item", "item_category"),
    "attribute_wide": ("attribute_value",),
    "custom_wide": ("custom_value",),
    "widened": ("categorised", "attribute_wide", "custom_wide"),
    "enriched": ("widened",),
    "latest_rule": ("customer_rule",),
}


def _with(*names: str) -> str:
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        for needed in CTE_NEEDS.get(name, ()):
            add(needed)
        ordered.setdefault(name, CTES[name])

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in ordered.items()) + "\n"


def query(sql: str, ctes: tuple[str, ...] = (), name: str | None = None):
    """Register a query, by default under its function's name, with its SQL statement."""

    def register(build: Query) -> Query:
        QUERIES[name or build.__name__] = build
        ORACLE[name or build.__name__] = (_with(*ctes) if ctes else "") + sql
        return build

    return register


# --- scans and schema ---------------------------------------------------------

PART_ALIASES = {
    "p_partkey": "item_id",
    "p_name": "short_description",
    "p_brand": "brand_name",
    "p_size": "qty_available",
}


@query("""
    SELECT p_partkey AS item_id, p_name AS short_description, p_brand AS brand_name,
           p_size AS qty_available FROM part""")
def scan_alias(spark, sf_dir):
    return scan_aliased(spark, f"{sf_dir}/part.parquet", PART_ALIASES)


@query("""
    SELECT p_partkey AS id, p_name AS short_description, p_size AS qty_available FROM part""")
def schema_align(spark, sf_dir):
    renamed = rename_to_target(
        tb.read(spark, sf_dir, "part"),
        {"p_partkey": "id", "p_name": "short_description", "p_size": "qty_available", "none": "x"},
    )
    return select_existing(renamed, ["id", "short_description", "volume", "qty_available"])[0]


# --- formula metadata ---------------------------------------------------------


@query("SELECT category_id, field_name, formula, formula_id FROM customer_rule", ("customer_rule",))
def formula_metadata(spark, sf_dir):
    return tb.customer_rules(spark, sf_dir)


@query("SELECT category_id, field_name, formula, formula_id FROM latest_rule", ("latest_rule",))
def formula_latest(spark, sf_dir):
    return latest(tb.customer_rules(spark, sf_dir))


@query(
    """SELECT category_id, string_agg(field_name || '=' || formula, '|' ORDER BY field_name)
              AS formulas
       FROM latest_rule GROUP BY category_id""",
    ("latest_rule",),
    name="formula_map",
)
def formula_map_entries(spark, sf_dir):
    entries = F.array_sort(F.map_entries("formulas"))
    texts = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return formula_map(tb.customer_rules(spark, sf_dir)).select(
        "category_id", F.array_join(texts, "|").alias("formulas")
    )


@query(
    r"""SELECT category_id, string_agg(field_name || '=' || formula, '|' ORDER BY field_name)
              AS formulas
       FROM latest_rule
       WHERE regexp_matches(formula,
           '\A(?:\[[^\]\x00-\x20](?:[^\]]*[^\]\x00-\x20])?\]|"[^"]*")(?:&(?:\[[^\]\x00-\x20](?:[^\]]*[^\]\x00-\x20])?\]|"[^"]*"))*\z')
       GROUP BY category_id""",
    ("latest_rule",),
)
def formula_map_valid(spark, sf_dir):
    """The map of the formulas that follow the grammar; the others are left out."""
    entries = F.array_sort(F.map_entries("formulas"))
    texts = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    found = formula_map(tb.customer_rules(spark, sf_dir), syntax="strict", on_invalid="skip")
    return found.select("category_id", F.array_join(texts, "|").alias("formulas"))


@query("SELECT DISTINCT field_name FROM customer_rule", ("customer_rule",))
def formula_targets(spark, sf_dir):
    return targets(tb.customer_rules(spark, sf_dir))


# --- formula texts ------------------------------------------------------------


@query(
    r"""
    , checked AS (
        SELECT doc_id, formula,
               regexp_replace(formula,
                   '(\[)[^\]]*(\])|(")[^"]*(")|(\[)[^\]]*\z|(")[^"]*\z|(&)|[\s\S]',
                   '\1\2\3\4\5\6\7', 'g') AS lex,
               regexp_extract_all(formula, '\[[^\]]*\]|"[^"]*"') AS parts
        FROM draft)
    , classed AS (
        SELECT doc_id, CASE
            WHEN formula IS NULL OR formula = '' THEN 'EMPTY'
            WHEN NOT regexp_matches(lex, '\A(?:(?:\[\]|"")(?:&(?:\[\]|""))*)?\z')
                THEN 'ILLEGAL_LEXICON'
            WHEN len(list_filter(parts, lambda p: p LIKE '[%' AND NOT regexp_matches(p,
                '\A\[[^\]\x00-\x20](?:[^\]]*[^\]\x00-\x20])?\]\z'))) > 0 THEN 'BLANK_FIELD'
            WHEN coalesce(array_to_string(parts, '&'), '') <> formula THEN 'MISMATCH'
            ELSE 'OK' END AS error_class
        FROM checked)
    SELECT doc_id, error_class, error_class = 'OK' AS is_valid FROM classed""",
    ("draft",),
)
def formula_validate(spark, sf_dir):
    checked = inspect.validate(tb.draft_formulas(spark, sf_dir))
    return checked.select("doc_id", "error_class", "is_valid")


@query(
    r"""
    , lexed AS (
        SELECT doc_id, formula,
               regexp_replace(formula,
                   '(\[)[^\]]*(\])|(")[^"]*(")|(\[)[^\]]*\z|(")[^"]*\z|(&)|[\s\S]',
                   '\1\2\3\4\5\6\7', 'g') AS lex
        FROM draft)
    , marks AS (
        SELECT doc_id, lex, unnest(range(length(lex))) AS i FROM lexed WHERE lex <> '')
    , around AS (
        SELECT doc_id, i, substr(lex, CAST(i + 1 AS BIGINT), 1) AS c,
               substr(lex, CAST(i + 2 AS BIGINT), 1) AS c1, substr(lex, CAST(i + 3 AS BIGINT), 1) AS c2,
               length(replace(replace(replace(substr(lex, 1, CAST(i AS BIGINT)), '[', ''), ']', ''), '&', '')) % 2 = 0
                   AS opens
        FROM marks)
    , bad AS (
        SELECT doc_id, min(i) AS i, arg_min(c, i) AS c FROM around
        WHERE (c = '[' AND c1 <> ']') OR (c = ']' AND (i = 0 OR c1 NOT IN ('&', '')))
           OR (c = '&' AND (i = 0 OR c1 NOT IN ('[', '"')))
           OR (c = '"' AND opens AND (c1 <> '"' OR c2 NOT IN ('&', '')))
        GROUP BY doc_id)
    SELECT d.doc_id, CAST(b.i AS INTEGER) AS error_position, b.c AS error_lexeme
    FROM draft d LEFT JOIN bad b ON b.doc_id = d.doc_id AND d.formula <> ''""",
    ("draft",),
)
def formula_error_position(spark, sf_dir):
    """Where the structure of each draft breaks: the lexeme's number and the lexeme."""
    checked = inspect.validate(tb.draft_formulas(spark, sf_dir))
    structural = F.col("error_class") == "ILLEGAL_LEXICON"
    return checked.select(
        "doc_id", F.when(structural, F.col("error_position")).alias("error_position"), "error_lexeme"
    )


@query(
    r"""
    , split AS (SELECT doc_id, regexp_extract_all(formula, '\[[^\]]*\]|"[^"]*"') AS parts FROM draft)
    SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS pos, unnest(parts) AS part
    FROM split""",
    ("draft",),
)
def formula_parts(spark, sf_dir):
    return inspect.explode_parts(tb.draft_formulas(spark, sf_dir)).select("doc_id", "pos", "part")


LENIENT_SQL = r"""
    , split AS (
        SELECT doc_id, list_filter(list_transform(string_split(formula, '&'),
            lambda p: regexp_replace(p, '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g')),
            lambda p: p <> '') AS parts
        FROM draft)"""


@query(
    LENIENT_SQL
    + """
    SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS pos, unnest(parts) AS part
    FROM split""",
    ("draft",),
)
def formula_parts_lenient(spark, sf_dir):
    drafts = tb.draft_formulas(spark, sf_dir)
    return inspect.explode_parts(drafts, syntax="lenient").select("doc_id", "pos", "part")


@query(
    r"""
    SELECT doc_id, coalesce(array_to_string(
               regexp_extract_all(formula, '\[[^\]]*\]|"[^"]*"'), '&'), '') = formula AS round_trips
    FROM draft""",
    ("draft",),
)
def formula_roundtrip(spark, sf_dir):
    return tb.draft_formulas(spark, sf_dir).select(
        "doc_id", inspect.round_trips(F.col("formula")).alias("round_trips")
    )


REFERENCE_SQL = (
    LENIENT_SQL
    + r"""
    , piece AS (SELECT doc_id, unnest(parts) AS part FROM split)
    , ref AS (
        SELECT doc_id, regexp_replace(part[2:len(part) - 1], '\Aa_', '') AS reference
        FROM piece WHERE part LIKE '[%' AND part LIKE '%]' AND len(part) > 1)"""
)


@query(REFERENCE_SQL + "\nSELECT doc_id, reference FROM ref", ("draft",))
def formula_references(spark, sf_dir):
    return inspect.references(tb.draft_formulas(spark, sf_dir)).select("doc_id", "reference")


@query(
    REFERENCE_SQL
    + """
    SELECT reference, count(*) AS n_uses FROM ref
    WHERE reference NOT IN (SELECT lang FROM documents) GROUP BY reference""",
    ("draft",),
)
def formula_unresolved(spark, sf_dir):
    names = tb.read(spark, sf_dir, "documents").select(F.col("lang").alias("name")).distinct()
    return audits.unresolved(tb.draft_formulas(spark, sf_dir), names)


@query(
    """
    SELECT item_id, concat_ws('', brand_name, ' ', long_description, '/',
               CAST(qty_available AS VARCHAR), '@', CAST(price AS VARCHAR)) AS label FROM item""",
    ("item",),
)
def formula_concat(spark, sf_dir):
    items = tb.item(spark, sf_dir)
    formula = '[brand_name]&" "&[a_long_description]&"/"&[qty_available]&"@"&[price]'
    return items.select(F.col("id").alias("item_id"), compile_formula(items, formula).alias("label"))


@query(r"""
    WITH RECURSIVE rule AS (
        SELECT c_custkey AS category_id, 'order_label' AS field_name,
               CASE WHEN c_acctbal < 0 THEN '[priority_code]' WHEN c_nationkey < 9 THEN '[o_orderstatus][o_orderkey]'
                    WHEN c_nationkey < 17 THEN '[priority_code][order_note]' ELSE '[order_note]' END AS formula
        FROM customer
        UNION ALL SELECT c_custkey, 'order_note',
               CASE WHEN c_nationkey < 9 THEN '[order_label][total]' WHEN c_nationkey < 17 THEN '[o_orderstatus][priority_code]'
                    ELSE '[order_note]' END FROM customer
        UNION ALL SELECT c_custkey, 'priority_code',
               CASE WHEN c_nationkey < 9 THEN '[order_note]' ELSE '[o_orderpriority]' END FROM customer WHERE c_nationkey < 17),
    edge AS (
        SELECT category_id, field_name, unnest(regexp_extract_all(formula, '\[([^]]*)\]', 1)) AS reference FROM rule),
    reach AS (
        SELECT category_id, field_name, reference, 1 AS depth FROM edge
        UNION SELECT r.category_id, r.field_name, e.reference, r.depth + 1
        FROM reach r JOIN edge e ON e.category_id = r.category_id AND e.field_name = r.reference WHERE r.depth < 8)
    SELECT category_id, field_name, reference, CAST(min(depth) AS INTEGER) AS depth,
           NOT EXISTS (SELECT 1 FROM rule k WHERE k.category_id = reach.category_id AND k.field_name = reach.reference) AS is_base
    FROM reach GROUP BY category_id, field_name, reference""")
def formula_lineage(spark, sf_dir):
    """All that a field depends on through the rules of its category, circles included."""
    rules = current_rules(tb.chained_rules(spark, sf_dir, circles=True))
    return dependencies.lineage(dependencies.structures(rules, dependencies.formula_references(rules)))


# --- formulas applied ---------------------------------------------------------


def _categorised(spark, sf_dir):
    tables = tb.catalogue(spark, sf_dir)
    links = tables["item_category"].drop("default_category")
    return pipeline.join_categories(tables["item"], links)


SNAPSHOT_SQL = """
    SELECT item_category_id, category_item_id, category_id, part_number, my_part_number,
           invoice_description, price, status,
           CASE category_id WHEN 10001 THEN concat_ws('', brand_name, ' ', part_number, '-custom')
                WHEN 10003 THEN concat_ws('', short_description, 'bare"xy"')
                WHEN 10004 THEN '' WHEN 10005 THEN '' ELSE short_description END
               AS short_description,
           CASE category_id WHEN 10001 THEN coalesce(short_description, '')
                WHEN 10002 THEN concat_ws('', long_description, '/', CAST(qty_available AS VARCHAR),
                                          ' @ ', CAST(price AS VARCHAR))
                ELSE long_description END AS long_description,
           CASE category_id WHEN 10002 THEN my_part_number
                WHEN 10003 THEN concat_ws('', '"xy"', brand_name)
                WHEN 10005 THEN concat_ws('', brand_name, long_description)
                ELSE brand_name END AS brand_name,
           CASE category_id WHEN 10003 THEN CAST(qty_available AS VARCHAR) || ' pcs'
                WHEN 10005 THEN 'abc' ELSE CAST(qty_available AS VARCHAR) END AS qty_available
    FROM categorised"""

SEQUENTIAL_ORDER = ("brand_name", "short_description", "long_description", "qty_available")
SEQUENTIAL_SQL = """
    , one AS (SELECT * REPLACE (
        CASE category_id WHEN 10002 THEN my_part_number
             WHEN 10003 THEN concat_ws('', '"xy"', brand_name)
             WHEN 10005 THEN concat_ws('', brand_name, long_description)
             ELSE brand_name END AS brand_name) FROM categorised)
    , two AS (SELECT * REPLACE (
        CASE category_id WHEN 10001 THEN concat_ws('', brand_name, ' ', part_number, '-custom')
             WHEN 10003 THEN concat_ws('', short_description, 'bare"xy"')
             WHEN 10004 THEN '' WHEN 10005 THEN '' ELSE short_description END
            AS short_description) FROM one)
    , three AS (SELECT * REPLACE (
        CASE category_id WHEN 10001 THEN coalesce(short_description, '')
             WHEN 10002 THEN concat_ws('', long_description, '/', CAST(qty_available AS VARCHAR),
                                       ' @ ', CAST(price AS VARCHAR))
             ELSE long_description END AS long_description) FROM two)
    SELECT * REPLACE (
        CASE category_id WHEN 10003 THEN CAST(qty_available AS VARCHAR) || ' pcs'
             WHEN 10005 THEN 'abc' ELSE CAST(qty_available AS VARCHAR) END AS qty_available)
    FROM three"""


@query(SNAPSHOT_SQL, ("categorised",))
def apply_snapshot(spark, sf_dir):
    return apply(_categorised(spark, sf_dir), tb.rules(spark, tb.BASIC_RULES))


AUTO_ORDER_SQL = """
    WITH rows AS (
        SELECT o_orderkey, o_custkey AS category_id, o_orderstatus, o_orderpriority,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total, o_orderpriority AS order_note,
               c_nationkey AS nation, c_mktsegment AS segment,
               o_orderstatus || '-' || o_orderkey || c_mktsegment AS tagged
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey, category_id, o_orderstatus, o_orderpriority, total,
           CASE WHEN nation < 9 THEN tagged
                WHEN nation < 17 THEN 'P' || o_orderpriority || o_orderstatus || '+P' || o_orderpriority
                WHEN nation IS NOT NULL THEN order_note || '~' END AS order_label,
           CASE WHEN nation < 9 THEN tagged || '/' || total
                WHEN nation < 17 THEN o_orderstatus || '+P' || o_orderpriority
                WHEN nation IS NOT NULL THEN order_note || '~' ELSE order_note END AS order_note,
           CASE WHEN nation < 9 THEN tagged || '/' || total || '!'
                WHEN nation < 17 THEN 'P' || o_orderpriority
                ELSE substr(o_orderpriority, 1, 1) END AS priority_code
    FROM rows"""


@query(AUTO_ORDER_SQL)
def apply_auto_order(spark, sf_dir):
    """Every field after those its formula reads, in an order of each category's own."""
    return apply(tb.order_items(spark, sf_dir), tb.chained_rules(spark, sf_dir), mode="sequential", order="auto")


@query("""
    SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) AS category_id,
           l_quantity AS q0, CASE WHEN l_linenumber % 2 = 0 THEN q2 + 1 ELSE l_extendedprice * 2 END AS q1,
           CASE WHEN l_linenumber % 2 = 0 THEN q0 * 3 ELSE q1 - q0 END AS q2
    FROM (SELECT *, l_quantity AS q0, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 3 END AS q2,
                 CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice * 2 END AS q1 FROM lineitem)""")
def apply_auto_order_sql(spark, sf_dir):
    """SQL formulas in the order of what they read; even and odd line numbers run the other way."""
    lines = tb.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").cast("long").alias("category_id"),
        F.col("l_quantity").alias("q0"), F.col("l_extendedprice").alias("q1"), F.lit(0.0).alias("q2"),
    )
    rules = tb.rules(spark, tuple(
        (n, f, t) for n in tb.LINES
        for f, t in ((("q1", "q2 + 1"), ("q2", "q0 * 3")) if n % 2 == 0 else (("q1", "q1 * 2"), ("q2", "q1 - q0")))
    ))
    return apply(lines, rules, mode="sequential", order="auto", dialect="sql")


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus,
           CAST(l_linenumber AS BIGINT) AS category_id,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           CASE WHEN l_linenumber = 7 THEN l_returnflag ELSE 'L' || l_linenumber || '-'
                || l_orderkey || '/' || l_partkey || '/' || l_suppkey END AS label,
           CASE WHEN l_linenumber % 2 = 1 THEN '' ELSE l_returnflag || l_linestatus || ' ' END
               || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price_text
    FROM lineitem""")
def apply_line_rules(spark, sf_dir):
    return apply(tb.order_lines(spark, sf_dir), tb.rules(spark, tb.LINE_RULES))


@query(SEQUENTIAL_SQL, ("categorised",))
def apply_sequential(spark, sf_dir):
    return apply(
        _categorised(spark, sf_dir),
        tb.rules(spark, tb.BASIC_RULES),
        mode="sequential",
        order=SEQUENTIAL_ORDER,
    )


@query(SNAPSHOT_SQL, ("categorised",))
def apply_data_driven(spark, sf_dir):
    return apply(_categorised(spark, sf_dir), tb.rules(spark, tb.BASIC_RULES), form="lookup")


@query(SEQUENTIAL_SQL, ("categorised",))
def apply_data_driven_sequential(spark, sf_dir):
    return apply(
        _categorised(spark, sf_dir),
        tb.rules(spark, tb.BASIC_RULES),
        mode="sequential",
        order=SEQUENTIAL_ORDER,
        form="lookup",
    )


@query(
    """
    SELECT item_category_id, category_item_id, category_id,
           CASE category_id WHEN 10001 THEN concat_ws('', brand_name, ' ', part_number, '-custom')
                WHEN 10004 THEN '' ELSE short_description END AS short_description,
           CASE category_id WHEN 10001 THEN coalesce(short_description, '')
                WHEN 10002 THEN concat_ws('', long_description, '/', CAST(qty_available AS VARCHAR),
                                          ' @ ', CAST(price AS VARCHAR))
                ELSE long_description END AS long_description,
           CASE category_id WHEN 10002 THEN my_part_number
                WHEN 10003 THEN concat_ws('', 'x&y', brand_name)
                WHEN 10005 THEN concat_ws('', brand_name, long_description)
                ELSE brand_name END AS brand_name,
           CASE category_id WHEN 10003 THEN CAST(qty_available AS VARCHAR) || ' pcs'
                ELSE CAST(qty_available AS VARCHAR) END AS qty_available
    FROM categorised""",
    ("categorised",),
)
def apply_strict(spark, sf_dir):
    applied = apply(
        _categorised(spark, sf_dir),
        tb.rules(spark, tb.BASIC_RULES),
        syntax="strict",
        on_invalid="skip",
    )
    return applied.select(
        "item_category_id", "category_item_id", "category_id", *SEQUENTIAL_ORDER
    )


RULE_VALUE_SQL = """
    CASE WHEN {field}_rule IS NULL THEN {current}
         ELSE coalesce(array_to_string(list_transform({field}_rule, lambda p: CASE p
             WHEN '[o_orderstatus]' THEN o_orderstatus
             WHEN '[o_orderkey]' THEN CAST(o_orderkey AS VARCHAR)
             WHEN '[order_note]' THEN o_orderpriority
             WHEN '[a_o_orderpriority]' THEN o_orderpriority
             WHEN '[a_order_label]' THEN ''
             WHEN '[total]' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)
             WHEN '[priority_code]' THEN left(o_orderpriority, 1)
             ELSE CASE WHEN p LIKE '"%"' THEN p[2:len(p) - 1] ELSE p END END), ''), '') END"""

CUSTOMER_APPLY_SQL = (
    """
    , parsed AS (
        SELECT category_id, field_name, list_transform(string_split(formula, '&'),
                   lambda p: trim(p)) AS parts
        FROM latest_rule WHERE formula <> '')
    , rule AS (
        SELECT category_id, any_value(parts) FILTER (WHERE field_name = 'order_label')
                   AS order_label_rule,
               any_value(parts) FILTER (WHERE field_name = 'order_note') AS order_note_rule,
               any_value(parts) FILTER (WHERE field_name = 'priority_code') AS priority_code_rule
        FROM parsed GROUP BY category_id)
    SELECT o_orderkey, o_custkey AS category_id, o_orderstatus, o_orderpriority,
           CAST(o_totalprice AS DECIMAL(12,2)) AS total, """
    + ", ".join(
        RULE_VALUE_SQL.format(field=field, current=current) + f" AS {field}"
        for field, current in (
            ("order_label", "CAST(NULL AS VARCHAR)"),
            ("order_note", "o_orderpriority"),
            ("priority_code", "left(o_orderpriority, 1)"),
        )
    )
    + " FROM orders LEFT JOIN rule ON rule.category_id = o_custkey"
)


@query(CUSTOMER_APPLY_SQL, ("latest_rule",))
def apply_customer_rules(spark, sf_dir):
    return apply(tb.order_items(spark, sf_dir), tb.customer_rules(spark, sf_dir))


@query(CUSTOMER_APPLY_SQL, ("latest_rule",))
def apply_customer_rules_split(spark, sf_dir):
    """As above, as if the rules were too large to broadcast and categories were hot."""
    return apply(
        tb.order_items(spark, sf_dir), tb.customer_rules(spark, sf_dir), form="lookup",
        limit_bytes=0, hot_rows=10,
    )


@query(
    """
    SELECT item_category_id, category_item_id, category_id,
           CAST(CASE category_id WHEN 10001 THEN price - price * qty_available * 0.01
                     WHEN 10002 THEN price - 5 ELSE price END AS DECIMAL(12,2)) AS price,
           CASE category_id WHEN 10001 THEN brand_name || ' ' || my_part_number
                WHEN 10003 THEN short_description || ' ' || coalesce(long_description, '?')
                ELSE short_description END AS short_description
    FROM categorised""",
    ("categorised",),
)
def formula_sql_dialect(spark, sf_dir):
    applied = apply(_categorised(spark, sf_dir), tb.rules(spark, tb.SQL_RULES), dialect="sql")
    return applied.select(
        "item_category_id", "category_item_id", "category_id", "price", "short_description"
    )


@query("""
    SELECT o_orderkey, o_custkey AS category_id,
           CAST(CASE c_nationkey % 3 WHEN 0 THEN total * 2 WHEN 1 THEN total - 5 ELSE total END
                AS DECIMAL(12,2)) AS total,
           CASE WHEN c_custkey IS NULL THEN o_orderpriority
                ELSE o_orderstatus || '/' || o_orderpriority END AS order_note
    FROM (SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders) o
    LEFT JOIN customer ON c_custkey = o_custkey""")
def formula_sql_many_rules(spark, sf_dir):
    """SQL formulas of as many categories as there are customers, in three texts."""
    customer = tb.read(spark, sf_dir, "customer")
    price = F.when(F.col("c_nationkey") % 3 == 0, "total * 2").when(F.col("c_nationkey") % 3 == 1, "total - 5")
    note = F.lit("concat(o_orderstatus, '/', o_orderpriority)")
    rules = customer.select(
        F.col("c_custkey").alias("category_id"),
        F.explode(F.create_map(F.lit("total"), price, F.lit("order_note"), note)).alias("field_name", "formula"),
    )
    applied = apply(tb.order_items(spark, sf_dir), rules, dialect="sql", max_rules=20)
    return applied.select("o_orderkey", "category_id", "total", "order_note")


REPEATED_SQL = """
    SELECT o_orderkey, o_custkey AS category_id,
           CASE WHEN c_custkey IS NULL THEN o_orderpriority
                ELSE o_orderstatus || CASE WHEN c_custkey % 2 = 0 THEN 'z' ELSE 'b' END END AS order_note
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""


def _repeated_versions(spark, sf_dir, form):
    """Rules whose field differs in case, with versions that repeat: the last, then the greater
    text, is taken in either form."""
    customer = tb.read(spark, sf_dir, "customer")
    key = F.col("c_custkey")

    def rule(field: str, text: str, version) -> F.Column:
        return F.struct(F.lit(field).alias("field_name"), F.lit(text).alias("formula"), version.alias("formula_id"))

    later = F.when(key % 2 == 0, key * 0 + 9).otherwise(1)
    made = F.array(
        rule("order_note", '[o_orderstatus]&"a"', key * 0 + 2), rule("ORDER_NOTE", '[o_orderstatus]&"b"', key * 0 + 2),
        rule("Order_Note", '[o_orderstatus]&"z"', later),
    )
    rules = customer.select(key.alias("category_id"), F.explode(made).alias("r")).select("category_id", "r.*")
    applied = apply(tb.order_items(spark, sf_dir), rules, form=form, max_rules=10**6 if form == "compiled" else 500)
    return applied.select("o_orderkey", "category_id", "order_note")


@query(REPEATED_SQL)
def apply_repeated_versions(spark, sf_dir):
    return _repeated_versions(spark, sf_dir, "lookup")


@query(REPEATED_SQL)
def apply_repeated_versions_compiled(spark, sf_dir):
    return _repeated_versions(spark, sf_dir, "compiled")


# --- joins --------------------------------------------------------------------


@query(
    """SELECT item_category_id, category_id, category_item_id, part_number, brand_name,
              my_part_number, short_description, long_description, invoice_description,
              qty_available, price, status FROM categorised""",
    ("categorised",),
)
def join_chain_inner(spark, sf_dir):
    return _categorised(spark, sf_dir)


@query(
    "SELECT category_item_id, item_category_id, category_id, "
    + ", ".join(tb.ATTRIBUTE_NAMES) + ", item_name, skew FROM widened",
    ("widened",),
)
def join_left_pivot(spark, sf_dir):
    tables = tb.catalogue(spark, sf_dir)
    return pipeline.widen_items(
        tables["item_category"].drop("default_category"),
        pipeline.eav(tables["item_attribute_value"], tables["attribute"], "attribute_id"),
        pipeline.eav(
            tables["item_custom_field_value"], tables["custom_field"], "custom_field_id"
        ),
        tb.ATTRIBUTE_NAMES,
        ["item_name", "skew"],
    )


def _labels_and_vectors(spark, sf_dir, how):
    """Two tables by document id, each with ids the other lacks."""
    labels = tb.read(spark, sf_dir, "labels")
    vectors = tb.read(spark, sf_dir, "embeddings").select("vec_id", "label")
    return join_chain(labels, [JoinSpec(vectors, ["vec_id"], how)], on="doc_id")


JOIN_SQL = """
    SELECT {columns} FROM labels {how} JOIN (SELECT vec_id, label FROM embeddings)
    ON doc_id = vec_id"""
ALL_COLUMNS = "doc_id, quality, toxic, vec_id, label"


@query(JOIN_SQL.format(columns=ALL_COLUMNS, how="FULL"))
def join_full(spark, sf_dir):
    return _labels_and_vectors(spark, sf_dir, "full_outer")


@query(JOIN_SQL.format(columns=ALL_COLUMNS, how="RIGHT"))
def join_right(spark, sf_dir):
    return _labels_and_vectors(spark, sf_dir, "right")


@query(JOIN_SQL.format(columns=ALL_COLUMNS, how="LEFT"))
def join_left(spark, sf_dir):
    return _labels_and_vectors(spark, sf_dir, "left")


@query(JOIN_SQL.format(columns="doc_id, quality, toxic", how="SEMI"))
def join_semi(spark, sf_dir):
    return _labels_and_vectors(spark, sf_dir, "left_semi")


@query(JOIN_SQL.format(columns="doc_id, quality, toxic", how="ANTI"))
def join_anti(spark, sf_dir):
    return _labels_and_vectors(spark, sf_dir, "left_anti")


@query("""
    SELECT p_partkey, p_name, l_orderkey, l_partkey, l_suppkey, l_linenumber
    FROM part JOIN lineitem ON p_partkey = l_partkey AND p_partkey = l_suppkey""")
def join_multi_key(spark, sf_dir):
    lines = tb.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    parts = tb.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return join_chain(parts, [JoinSpec(lines, ["l_partkey", "l_suppkey"])], on="p_partkey")


@query("""
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, s.n_lines
    FROM lineitem l JOIN (SELECT l_partkey, l_suppkey, count(*) AS n_lines FROM lineitem
                          GROUP BY 1, 2) s
      ON l.l_partkey = s.l_partkey AND l.l_suppkey = s.l_suppkey""")
def join_composite_key(spark, sf_dir):
    lines = tb.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    keys = [("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey")]
    return join_chain(lines, [JoinSpec(pairs, keys, strategy="split")])


EAV_SQL = """
    SELECT item_id AS attribute_item_id, attribute_name, attribute_value FROM attribute_value"""


@query(EAV_SQL, ("attribute_value",))
def eav_join(spark, sf_dir):
    tables = tb.catalogue(spark, sf_dir)
    return pipeline.eav(
        tables["item_attribute_value"], tables["attribute"], "attribute_id"
    ).select("attribute_item_id", "attribute_name", "attribute_value")


@query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, s_name
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def lookup_split(spark, sf_dir):
    """A lookup join as if the dimension were too large to broadcast."""
    lines = tb.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )
    suppliers = tb.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name"
    )
    return lookup_join(lines, suppliers, "l_suppkey", "left", limit_bytes=0, hot_rows=100)


UPDATE_SQL = """
    SELECT c_custkey, c_name, coalesce(segment, small_segment) AS c_mktsegment
    FROM (SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END
              AS small_segment FROM customer)
    LEFT JOIN (
        SELECT o_custkey, arg_max(struct_pack(v := CASE WHEN o_orderstatus <> 'P'
                   THEN o_orderpriority END), o_orderkey).v AS segment
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"""


def _update_pair(spark, sf_dir):
    small = tb.read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    large = tb.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("c_mktsegment"),
        "o_orderkey",
    )
    return small, large


@query(UPDATE_SQL)
def update_small_from_large(spark, sf_dir):
    small, large = _update_pair(spark, sf_dir)
    columns = ["c_mktsegment", "not_in_large"]
    return update_from(small, large, ["c_custkey"], columns, latest_by="o_orderkey")[0]


@query(UPDATE_SQL)
def update_large_from_large(spark, sf_dir):
    """The same update as if the small side were too large to broadcast."""
    small, large = _update_pair(spark, sf_dir)
    return update_from(
        small, large, ["c_custkey"], ["c_mktsegment"], latest_by="o_orderkey", limit_bytes=0
    )[0]


@query("""
    SELECT l.doc_id, l.quality, coalesce(d.toxic, l.toxic) AS toxic
    FROM labels l LEFT JOIN (
        SELECT doc_id, CAST(CASE WHEN n_chars >= 300 THEN n_chars % 7 END AS INTEGER) AS toxic
        FROM documents) d ON d.doc_id = l.doc_id""")
def update_bloom(spark, sf_dir):
    """Keys above the broadcast limit: documents that no label names leave by a Bloom filter."""
    large = tb.read(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") >= 300, F.col("n_chars") % 7).cast("int").alias("toxic")
    )
    return update_from(tb.read(spark, sf_dir, "labels"), large, ["doc_id"], ["toxic"], limit_bytes=0)[0]


# --- pivots -------------------------------------------------------------------


@query(
    "SELECT item_id AS attribute_item_id, " + ", ".join(tb.ATTRIBUTE_NAMES) + " FROM attribute_wide",
    ("attribute_wide",),
)
def pivot_first(spark, sf_dir):
    return pivot_wide(
        _long_attributes(spark, sf_dir), ["attribute_item_id"], "attribute_name", "attribute_value",
        values=tb.ATTRIBUTE_NAMES,
    )


@query(ORACLE["pivot_first"])
def pivot_first_discovered(spark, sf_dir):
    return pivot_wide(
        _long_attributes(spark, sf_dir), ["attribute_item_id"], "attribute_name", "attribute_value"
    )


@query(ORACLE["pivot_first"])
def pivot_one_pass(spark, sf_dir):
    """Names found in what was aggregated: the values are read once."""
    return pivots.pivot_one_pass(_long_attributes(spark, sf_dir), ["attribute_item_id"], "attribute_name", "attribute_value")


def _long_attributes(spark, sf_dir):
    return eav_join(spark, sf_dir)


@query("""
    SELECT l_partkey, arg_min(l_shipdate, l_orderkey * 10 + l_linenumber)
                          FILTER (WHERE l_returnflag = 'A') AS A,
           arg_min(l_shipdate, l_orderkey * 10 + l_linenumber)
                          FILTER (WHERE l_returnflag = 'N') AS N,
           arg_min(l_shipdate, l_orderkey * 10 + l_linenumber)
                          FILTER (WHERE l_returnflag = 'R') AS R
    FROM (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate
          FROM lineitem GROUP BY ALL) GROUP BY l_partkey""")
def pivot_first_ordered(spark, sf_dir):
    lines = (
        tb.read(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber")
        .agg(F.min("l_shipdate").alias("l_shipdate"))
        .withColumn("position", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    )
    return pivot_wide(
        lines, ["l_partkey"], "l_returnflag", "l_shipdate", values=tb.FLAGS, order_by="position"
    )


@query("""
    SELECT l_partkey, """ + ", ".join(
    f"""CASE WHEN bool_or(l_linenumber = {n}) THEN count(CASE WHEN l_discount >= 0.05
            THEN l_quantity END) FILTER (WHERE l_linenumber = {n}) END AS line_{n}"""
    for n in tb.LINES
) + " FROM lineitem GROUP BY l_partkey")
def pivot_custom_agg(spark, sf_dir):
    lines = tb.read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_linenumber",
        F.when(F.col("l_discount") >= 0.05, F.col("l_quantity")).alias("discounted"),
    )
    return pivot_wide(
        lines, ["l_partkey"], "l_linenumber", "discounted", values=tb.LINES, agg="count",
        prefix="line_",
    )


@query("""
    SELECT l_partkey, l_linestatus, """ + ", ".join(
    f"""CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) FILTER (WHERE l_returnflag = '{f}')
        AS DECIMAL(22,2)) AS {f}"""
    for f in tb.FLAGS
) + " FROM lineitem GROUP BY l_partkey, l_linestatus")
def pivot_multi_key(spark, sf_dir):
    lines = tb.read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_linestatus", "l_returnflag",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )
    return pivot_wide(
        lines, ["l_partkey", "l_linestatus"], "l_returnflag", "price", values=tb.FLAGS, agg="sum"
    )


@query("""
    SELECT o_custkey, """ + ", ".join(
    f"max(o_orderkey) FILTER (WHERE o_orderstatus = '{s}') AS {s}" for s in "FOP"
) + """ FROM orders GROUP BY o_custkey""")
def pivot_agg_first(spark, sf_dir):
    """``first`` as given by a caller, over a numeric value that is unique per cell."""
    last = tb.read(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(
        F.max("o_orderkey").alias("o_orderkey")
    )
    return pivot_wide(
        last, ["o_custkey"], "o_orderstatus", "o_orderkey", values=list("FOP"), agg=F.first
    )


SIZES = tuple(range(1, 51))


@query("""
    SELECT p_brand, """ + ", ".join(
    f"CAST(max(p_partkey) FILTER (WHERE p_size = {n}) AS BIGINT) AS size_{n}" for n in SIZES
) + " FROM part GROUP BY p_brand")
def pivot_agg_wide(spark, sf_dir):
    """Fifty numeric columns by a caller's aggregate."""
    return pivot_wide(
        tb.read(spark, sf_dir, "part"), ["p_brand"], "p_size", "p_partkey", values=SIZES,
        agg=F.max, prefix="size_",
    )


@query("SELECT DISTINCT l_returnflag FROM lineitem", name="pivot_values")
def pivot_value_list(spark, sf_dir):
    return pivot_values(tb.read(spark, sf_dir, "lineitem"), "l_returnflag")


# --- sinks --------------------------------------------------------------------


def _per_customer(spark, sf_dir, finished):
    orders = tb.read(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "F") == finished)
    return orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(18,2)").alias("total"),
        F.max("o_orderpriority").alias("last"),
        F.min("o_orderpriority").alias("first"),
    )


def _upsert_pair(spark, sf_dir):
    target = _per_customer(spark, sf_dir, True).select(
        "custkey", "n_orders", "total", F.col("last").alias("priority"), F.lit("kept").alias("note")
    )
    source = _per_customer(spark, sf_dir, False).select(
        "custkey", "n_orders", F.when(F.col("n_orders") < 4, F.col("total")).alias("total"),
        F.col("first").alias("priority"),
    )
    return target, source


@query(
    """
    SELECT coalesce(t.custkey, s.custkey) AS custkey, t.n_orders AS n_orders,
           CASE WHEN s.custkey IS NULL THEN t.total ELSE s.total END AS total,
           CASE WHEN s.custkey IS NULL THEN t.priority ELSE s.priority END AS priority, t.note AS note
    FROM finished t FULL JOIN open_orders s ON t.custkey = s.custkey""",
    ("finished", "open_orders"),
)
def upsert_merge(spark, sf_dir):
    target, source = _upsert_pair(spark, sf_dir)
    return upsert(target, source, ["custkey"], ["total", "priority"])


@query(
    """
    , pending AS (
        SELECT o_custkey AS custkey, count(*) AS n_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total,
               min(o_orderpriority) AS priority
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey)
    SELECT coalesce(t.custkey, s.custkey) AS custkey,
           CASE WHEN s.custkey IS NULL THEN t.n_orders ELSE s.n_orders END AS n_orders,
           CASE WHEN s.custkey IS NULL THEN t.total ELSE s.total END AS total,
           CASE WHEN s.custkey IS NULL THEN t.priority ELSE s.priority END AS priority, t.note
    FROM finished t FULL JOIN pending s ON t.custkey = s.custkey""",
    ("finished",),
)
def upsert_all_orders(spark, sf_dir):
    """Every order is in the target (finished) or in the source (open and pending)."""
    target, _ = _upsert_pair(spark, sf_dir)
    orders = tb.read(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "F")
    source = orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(18,2)").alias("total"),
        F.min("o_orderpriority").alias("priority"),
    )
    return upsert(target, source, ["custkey"])


UPSERT_DEFAULTS_SQL = """
    SELECT coalesce(t.custkey, s.custkey) AS custkey,
           CASE WHEN s.custkey IS NULL THEN t.n_orders ELSE s.n_orders END AS n_orders,
           CASE WHEN s.custkey IS NULL THEN t.total ELSE s.total END AS total,
           CASE WHEN s.custkey IS NULL THEN t.priority ELSE s.priority END AS priority,
           CASE WHEN t.custkey IS NULL THEN 'INACTIVE' ELSE t.note END AS note
    FROM finished t FULL JOIN open_orders s ON t.custkey = s.custkey"""


@query(UPSERT_DEFAULTS_SQL, ("finished", "open_orders"))
def upsert_insert_defaults(spark, sf_dir):
    target, source = _upsert_pair(spark, sf_dir)
    return upsert(target, source, ["custkey"], defaults={"note": "INACTIVE"}, unique="assume")


@query(UPSERT_DEFAULTS_SQL, ("finished", "open_orders"))
def upsert_small_source(spark, sf_dir):
    target, source = _upsert_pair(spark, sf_dir)
    return upsert(
        target, source, ["custkey"], defaults={"note": "INACTIVE"}, unique="assume",
        small_source=True,
    )


@query("""
    SELECT coalesce(c_custkey, id) AS id, coalesce(s_name, c_name) AS name,
           CASE WHEN id IS NULL THEN c_acctbal ELSE s_acctbal END AS balance,
           CASE WHEN c_custkey IS NULL THEN 'SUPPLIER' ELSE c_mktsegment END AS segment
    FROM customer FULL JOIN (SELECT s_suppkey * 20 AS id, * FROM supplier) ON id = c_custkey""")
def upsert_touched(spark, sf_dir):
    """Few rows into a table of many key buckets: only those of the source are rewritten."""
    parties = tb.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    path = shared_folder(spark, "parties")
    buckets.write_buckets(parties, path, ["id"], 64)
    incoming = tb.read(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 20).alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    buckets.upsert_touched(path, incoming, defaults={"segment": "SUPPLIER"})
    return buckets.read_buckets(spark, path)


@query("""
    SELECT o_custkey, row.o_orderkey, row.o_orderdate, row.o_orderpriority
    FROM (SELECT o_custkey, arg_max(struct_pack(o_orderkey, o_orderdate, o_orderpriority),
                                    struct_pack(o_orderdate, o_orderkey)) AS row
          FROM orders GROUP BY o_custkey)""")
def dedupe_source(spark, sf_dir):
    orders = tb.read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    return dedupe(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""
    SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""")
def append_union(spark, sf_dir):
    customers = tb.read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = tb.read(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name")
    )
    return append_rows(customers, suppliers)


@query(
    """
    SELECT 'qty_available' AS column_name,
           count(*) FILTER (WHERE category_id IN (10003, 10005)) AS n_lost FROM categorised""",
    ("categorised",),
)
def sink_cast_losses(spark, sf_dir):
    applied = apply_snapshot(spark, sf_dir)
    return cast_losses(applied, tb.item(spark, sf_dir))[1]


# --- the whole job ------------------------------------------------------------


@query(
    """SELECT category_item_id, item_category_id, category_id, part_number, brand_name,
              my_part_number, invoice_description, qty_available, price, status, A1, N2, R3, R7,
              short_description, long_description, item_name, skew FROM enriched""",
    ("enriched",),
)
def enrich_flagship(spark, sf_dir):
    return pipeline.enrich(tb.catalogue(spark, sf_dir), tb.rules(spark, tb.WIDE_RULES))


@query(
    """SELECT category_item_id, item_category_id, category_id, part_number, brand_name,
              my_part_number, invoice_description, qty_available, price, status, """
    + ", ".join(f"w.{n}" for n in tb.ATTRIBUTE_NAMES)
    + """, e.short_description, e.long_description, e.item_name, e.skew
       FROM enriched e JOIN (SELECT item_category_id, """
    + ", ".join(tb.ATTRIBUTE_NAMES) + " FROM widened) w USING (item_category_id)",
    ("enriched",),
)
def enrich_all_columns(spark, sf_dir):
    """The whole widening: every attribute and custom field becomes a column."""
    return pipeline.enrich(
        tb.catalogue(spark, sf_dir), tb.rules(spark, tb.WIDE_RULES), referenced_only=False
    )


@query(
    """
    , chosen AS (
        SELECT e.* FROM enriched e QUALIFY row_number() OVER (
            PARTITION BY category_item_id ORDER BY item_category_id % 10, item_category_id) = 1)
    SELECT i.item_id AS id, i.part_number, i.brand_name, i.my_part_number,
           CASE WHEN c.category_item_id IS NULL THEN i.short_description
                ELSE c.short_description END AS short_description,
           CASE WHEN c.category_item_id IS NULL THEN i.long_description
                ELSE c.long_description END AS long_description,
           i.invoice_description, i.qty_available, i.price, i.status
    FROM item i LEFT JOIN chosen c ON c.category_item_id = i.item_id""",
    ("enriched",),
)
def enrich_writeback(spark, sf_dir):
    tables = tb.catalogue(spark, sf_dir)
    tables["item_category"] = pipeline.pick_category(tables["item_category"])
    enriched = pipeline.enrich(tables, tb.rules(spark, tb.WIDE_RULES))
    written, _ = pipeline.write_back(enriched, tb.ITEM_ALIASES, ["status"])
    return upsert(tb.item(spark, sf_dir), written, ["id"], unique="assume")


@query(ORACLE["enrich_writeback"])
def enrich_bucketed(spark, sf_dir):
    """The same from tables bucketed by item: no shuffle from the pivots to the upsert."""
    folder = shared_folder(spark, "catalogue")
    prefix = folder.rpartition("/")[2].replace("-", "_") + "_"
    bucketed.write_catalogue(tb.stored_catalogue(spark, sf_dir), prefix, 8, folder)
    reader = bucketed.table_reader(spark, prefix)
    tables = load_catalogue(reader, tb.ENTITY_ALIASES)
    rows, _ = pipeline.enriched_rows(tables, tb.rules(spark, tb.WIDE_RULES), aliases=tb.ITEM_ALIASES, read_only=["status"])
    return upsert(spark.table(f"{prefix}item"), rows, ["id"], unique="assume")


@query(ORACLE["enrich_writeback"])
def enrich_incremental(spark, sf_dir):
    """A run over an earlier catalogue with earlier rules, then only what has changed since."""
    options = {"aliases": tb.ITEM_ALIASES, "read_only": ["status"]}
    stored = tb.earlier_catalogue(spark, sf_dir)
    tables, rules = tb.catalogue(spark, sf_dir, stored), tb.rules(spark, tb.EARLIER_WIDE_RULES)
    rows, _ = pipeline.enriched_rows(tables, rules, **options)
    previous = settled(upsert(stored["item"], rows, ["id"], unique="assume"))
    before = incremental.RunState(*map(settled, incremental.run_state(tables, rules, stored["item"], options)))

    stored = tb.stored_catalogue(spark, sf_dir)
    tables, rules = tb.catalogue(spark, sf_dir, stored), tb.rules(spark, tb.WIDE_RULES)
    now = incremental.run_state(tables, rules, stored["item"], options)
    return incremental.enrich_changed(tables, rules, stored["item"], previous, before, now, **options)


@query(
    """
    , rule_value AS (
        SELECT category_item_id, CASE category_id WHEN 10001 THEN part_number
               WHEN 10002 THEN CAST(qty_available + 1 AS VARCHAR) ELSE CAST(qty_available AS VARCHAR) END AS qty
        FROM categorised QUALIFY row_number() OVER (
            PARTITION BY category_item_id ORDER BY item_category_id % 10) = 1)
    SELECT i.item_id AS id, coalesce(TRY_CAST(v.qty AS INTEGER), i.qty_available) AS qty_available
    FROM item i LEFT JOIN rule_value v ON v.category_item_id = i.item_id""",
    ("categorised",),
)
def enrich_writeback_losses(spark, sf_dir):
    """Texts that do not fit an int column leave the stored value."""
    items = tb.item(spark, sf_dir).select("id", "part_number", "qty_available")
    links = pipeline.pick_category(tb.catalogue(spark, sf_dir)["item_category"])
    rules = tb.rules(spark, ((10001, "qty_available", "part_number"), (10002, "qty_available", "cast(qty_available + 1 as string)")))
    texts = pipeline.join_categories(items.withColumnRenamed("id", "item_id"), links)
    computed = apply(texts.withColumn("qty_available", F.col("qty_available").cast("string")), rules, dialect="sql")
    rows, _ = cast_checked(computed.select(F.col("category_item_id").alias("id"), "qty_available"), items, "keep")
    return upsert(items, rows, ["id"], unique="assume").select("id", "qty_available")


# --- audits -------------------------------------------------------------------


@query("""
    SELECT rule_key, count(*) AS n
    FROM (SELECT CASE WHEN p_size >= 10 THEN p_type || p_size END AS rule_key FROM part)
    WHERE rule_key IS NOT NULL GROUP BY rule_key HAVING count(*) > 1""")
def audit_nullable_keys(spark, sf_dir):
    """Null keys are no duplicates of each other."""
    key = F.when(F.col("p_size") >= 10, F.concat("p_type", F.col("p_size").cast("string")))
    return audits.duplicate_keys(tb.read(spark, sf_dir, "part").select(key.alias("rule_key")), ["rule_key"])



@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def audit_duplicate_keys(spark, sf_dir):
    return audits.duplicate_keys(tb.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
    GROUP BY o_custkey HAVING count(*) > 1""")
def audit_partial_unique(spark, sf_dir):
    orders = tb.read(spark, sf_dir, "orders")
    return audits.duplicate_keys(orders, ["o_custkey"], F.col("o_orderpriority") == "1-URGENT")


@query("""
    SELECT doc_id, count(*) AS n FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""")
def audit_orphans(spark, sf_dir):
    documents, labels = tb.read(spark, sf_dir, "documents"), tb.read(spark, sf_dir, "labels")
    return audits.orphans(documents, labels, [("doc_id", "doc_id")])


@query(
    """
    SELECT 'attribute_value' AS column_name, count(*) AS n_rows,
           count(*) FILTER (WHERE attribute_value IS NULL) AS n_null FROM attribute_value
    UNION ALL SELECT 'attribute_item_id', count(*), count(*) FILTER (WHERE item_id IS NULL)
    FROM attribute_value""",
    ("attribute_value",),
)
def audit_nulls(spark, sf_dir):
    values = tb.catalogue(spark, sf_dir)["item_attribute_value"]
    return audits.nulls(values, ["attribute_value", "attribute_item_id"])


@query("""
    SELECT event_type, count(*) AS n FROM events
    WHERE event_type NOT IN ('click', 'view') GROUP BY event_type""")
def audit_domain(spark, sf_dir):
    return audits.domain(tb.read(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query("""
    SELECT 'text' AS column_name, count(*) AS n_rows,
           count(*) FILTER (WHERE length(text) > 1000) AS n_too_long,
           CAST(max(length(text)) AS INTEGER) AS max_length FROM documents
    UNION ALL SELECT 'lang', count(*), count(*) FILTER (WHERE length(lang) > 2),
           CAST(max(length(lang)) AS INTEGER) FROM documents""")
def audit_length(spark, sf_dir):
    return audits.lengths(tb.read(spark, sf_dir, "documents"), {"text": 1000, "lang": 2})


@query("""
    SELECT 'o_totalprice' AS column_name, count(*) AS n_rows,
           count(*) FILTER (WHERE TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL)
               AS n_out_of_range FROM orders""")
def audit_decimal(spark, sf_dir):
    return audits.decimals(tb.read(spark, sf_dir, "orders"), {"o_totalprice": (7, 2)})


@query("""
    WITH counted AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
    parts AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT 'key' AS rule, 'l_orderkey, l_linenumber' AS subject, (SELECT count(*) FROM lineitem) AS n_rows,
           CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_bad FROM counted
    UNION ALL SELECT 'key', 'l_orderkey, l_partkey', (SELECT count(*) FROM lineitem),
           CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM parts
    UNION ALL SELECT 'not null', 'l_shipdate', count(*), count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
    UNION ALL SELECT 'domain', 'l_returnflag', count(*), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
    UNION ALL SELECT 'length', 'l_linestatus', count(*), count(*) FILTER (WHERE length(l_linestatus) > 1) FROM lineitem
    UNION ALL SELECT 'decimal', 'l_extendedprice', count(*),
           count(*) FILTER (WHERE TRY_CAST(l_extendedprice AS DECIMAL(6,2)) IS NULL) FROM lineitem""")
def audit_suite(spark, sf_dir):
    """All rules of a table in one scan, its candidate keys in one shuffle."""
    return audits.suite(
        tb.read(spark, sf_dir, "lineitem"),
        keys=[["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"]],
        not_null=["l_shipdate"],
        domains={"l_returnflag": ["A", "N"]},
        lengths={"l_linestatus": 1},
        decimals={"l_extendedprice": (6, 2)},
    )


# --- ranges of a parallel read --------------------------------------------------


RANGES = 8


@query("""
    WITH keys AS (
        SELECT CASE WHEN l_linenumber < 6 THEN l_orderkey ELSE l_orderkey * 1000000 END AS id FROM lineitem)
    SELECT 'even' AS cut, 8 AS n_ranges, count(*) AS n_rows, true AS is_even FROM keys
    UNION ALL SELECT 'strides', 8, count(*), false FROM keys""")
def range_predicates(spark, sf_dir):
    """Clustered keys with a few far away: even ranges against equal strides, each row in one range."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    keys = tb.read(spark, sf_dir, "lineitem").select(F.when(line < 6, key).otherwise(key * 1_000_000).alias("id"))
    low, high = keys.agg(F.min("id"), F.max("id")).first()
    strides = [low + (high - low) * i // RANGES for i in range(1, RANGES)]
    found = None
    for cut, bounds in (("even", ranges.even_bounds(keys, "id", RANGES)), ("strides", strides)):
        predicates = ranges.predicates("id", bounds)
        counts = keys.agg(*[F.count_if(F.expr(p)).alias(f"r{i}") for i, p in enumerate(predicates)])
        counted = F.array(*[F.col(f"r{i}") for i in range(len(predicates))])
        total = F.aggregate(counted, F.lit(0).cast("long"), lambda a, b: a + b)
        # Twice the fair share is far beyond the sketch's error, and far below a cluster's.
        row = counts.select(
            F.lit(cut).alias("cut"), F.size(counted).alias("n_ranges"), total.alias("n_rows"),
            (F.array_max(counted) * RANGES <= 2 * total).alias("is_even"),
        )
        found = row if found is None else found.unionByName(row)
    return found
