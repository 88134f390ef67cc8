"""The enrichment pipeline: widen items, apply category rules, shape the write-back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldloom.functions.applying import RuleSet, apply, rule_set, sql_names
from fieldloom.functions.compiling import formula_parts
from fieldloom.functions.inspect import references
from fieldloom.operators.joins import JoinSpec, join_chain, lookup_join
from fieldloom.operators.schema import (
    col,
    folding,
    has_column,
    invert_aliases,
    is_case_sensitive,
    rename_to_target,
    select_existing,
)
from fieldloom.sinks.tables import cast_checked, dedupe
from fieldloom.sources.catalogue import ALIASES, ITEM_READ_ONLY

# Kinds of fields that are stored long and become columns.
KINDS = ("attribute", "custom_field")


def join_categories(
    items: DataFrame, item_category: DataFrame, strategy: str = "plain"
) -> DataFrame:
    """Items with their categories; uncategorised items leave, n categories give n rows.

    An item has few categories, so no key of this join is hot.
    """
    spec = JoinSpec(items, [("category_item_id", "item_id")], "inner", strategy=strategy)
    return join_chain(item_category, [spec]).drop("item_id")


def eav(values: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Entity-attribute-value rows with the attribute's name from its dimension."""
    return lookup_join(values, dimension, key, "inner")


def names_in_use(found: RuleSet, syntax: str = "lenient", dialect: str = "concat") -> list[str]:
    """Names the rules read or write, on the driver, which plans a column for each."""
    spark = found.rules.sparkSession
    if dialect == "sql":
        texts = found.rows if found.rows is not None else found.rules.select("formula").distinct().collect()
        read = {part for r in texts for name in sql_names(spark, r["formula"])[1] for part in name}
    elif found.rows is not None:
        read = {text for r in found.rows for kind, text in formula_parts(r["formula"], syntax) if kind == "field"}
    else:
        both = references(found.rules, syntax=syntax).select("reference").union(found.rules.select("field_name"))
        return sorted(r[0] for r in both.distinct().collect())
    written = found.rows if found.rows is not None else found.rules.select("field_name").distinct().collect()
    return sorted(read | {r["field_name"] for r in written})


def widen_items(
    items: DataFrame,
    attributes: DataFrame,
    custom_fields: DataFrame,
    attribute_values: Sequence[str] | None = None,
    custom_field_values: Sequence[str] | None = None,
    prefix: Mapping[str, str] | None = None,
    keep_keys: bool = False,
    on: str = "category_item_id",
) -> DataFrame:
    """Items ⟕ pivoted attributes ⟕ pivoted custom fields, on the item's id.

    Given value lists, only those become columns: no job looks them up and other EAV
    rows are dropped before the shuffle.  ``prefix`` renames the columns of
    ``attribute`` or ``custom_field`` where names would clash.
    """
    prefix = prefix or {}
    specs = [
        JoinSpec(
            table,
            [f"{kind}_item_id"],
            "left",
            group_by=[f"{kind}_item_id"],
            pivot=f"{kind}_name",
            value=f"{kind}_value",
            values=values,
            matched_only=values is not None and not keep_keys,
            prefix=prefix.get(kind, ""),
        )
        for kind, table, values in (
            ("attribute", attributes, attribute_values),
            ("custom_field", custom_fields, custom_field_values),
        )
    ]
    wide = join_chain(items, specs, on=on)
    return wide if keep_keys else wide.drop("attribute_item_id", "custom_field_item_id")


def _held(tables: Mapping[str, DataFrame], used: Sequence[str], prefix: Mapping[str, str]) -> dict[str, list[str]]:
    """Per kind of field the names its dimension holds whose column, prefix included, is used."""
    spark = tables["attribute"].sparkSession
    fold = folding(spark)
    found = None
    for kind in KINDS:
        start = prefix.get(kind, "")
        name = col(f"{kind}_name")
        wanted = {fold(n[len(start):]) for n in used if n.startswith(start)}
        held = (name if is_case_sensitive(spark) else F.lower(name)).isin(sorted(wanted))
        names = tables[kind].where(held).select(F.lit(kind).alias("kind"), name.alias("name"))
        found = names if found is None else found.unionByName(names)
    by_kind: dict[str, list[str]] = {kind: [] for kind in KINDS}
    for r in found.distinct().collect():
        by_kind[r["kind"]].append(r["name"])
    for kind, names in by_kind.items():
        names.sort()
        by_fold: dict[str, list[str]] = {}
        for v in names:
            by_fold.setdefault(fold(v), []).append(v)
        clashes = [vs for vs in by_fold.values() if len(vs) > 1]
        if clashes:
            raise ValueError(f"{kind}_name holds names that would be one column: {clashes}")
    return by_kind


def enrich(
    tables: Mapping[str, DataFrame],
    formulas: DataFrame,
    referenced_only: bool = True,
    prefix: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Load → join → pivot → formulas; ``tables`` as from ``load_catalogue``.

    With ``referenced_only`` just the attributes and custom fields that some formula
    reads or writes are pivoted.  ``options`` go to ``apply``.
    """
    # Made once: the columns pivoted below and the rules applied must be the same.
    given = {k: options[k] for k in ("syntax", "on_invalid", "dialect", "version", "max_rules") if k in options}
    if options.get("form") == "lookup":
        given["max_rules"] = 0
    rules = rule_set(formulas, **given)
    values: dict[str, list[str] | None] = dict.fromkeys(KINDS)
    if referenced_only:
        used = names_in_use(rules, options.get("syntax", "lenient"), options.get("dialect", "concat"))
        values = _held(tables, used, prefix or {})
    # Widened before categories repeat items, so each item is shuffled once and every
    # side of these joins holds one row per item.
    wide = widen_items(
        tables["item"],
        eav(tables["item_attribute_value"], tables["attribute"], "attribute_id"),
        eav(tables["item_custom_field_value"], tables["custom_field"], "custom_field_id"),
        values["attribute"],
        values["custom_field"],
        prefix,
        on="item_id",
    )
    wide = join_categories(wide, tables["item_category"].drop("default_category"))
    return apply(wide, rules, **({"keys_from": tables["item_category"]} | options))


def pick_category(
    item_category: DataFrame, order_by: Sequence[str] = ("item_category_id",)
) -> DataFrame:
    """One category per item, so that each item is written once: its default category where
    the links say which (``default_category``), then the first by ``order_by``.

    Choosing before the join keeps the aggregate to the narrow link table.
    """
    if not has_column(item_category, "default_category"):
        return dedupe(item_category, ["category_item_id"], order_by, descending=False)
    other = ~F.coalesce(F.col("default_category"), F.lit(False))
    ranked = item_category.withColumn("__other", other)
    chosen = dedupe(ranked, ["category_item_id"], ["__other", *order_by], descending=False)
    return chosen.drop("__other", "default_category")


def write_back(
    enriched: DataFrame,
    aliases: Mapping[str, str] = ALIASES["item"],
    read_only: Sequence[str] = ITEM_READ_ONLY,
) -> tuple[DataFrame, list[str]]:
    """The item columns to upsert, under their table names; also the names skipped."""
    mapping = invert_aliases(aliases, read_only, {"id": "category_item_id"})
    return select_existing(rename_to_target(enriched, mapping), list(mapping.values()))


def enriched_rows(
    tables: Mapping[str, DataFrame],
    formulas: DataFrame,
    on_loss: str = "fail",
    aliases: Mapping[str, str] = ALIASES["item"],
    read_only: Sequence[str] = ITEM_READ_ONLY,
    **options,
) -> tuple[DataFrame, Observation | None]:
    """The item columns to write, one row per categorised item, in the types of the item
    table; and the counter of computed values that their column's type cannot hold."""
    chosen = dict(tables, item_category=pick_category(tables["item_category"]))
    rows, _ = write_back(enrich(chosen, formulas, **options), aliases, read_only)
    return cast_checked(rows, tables["item"].withColumnRenamed("item_id", "id"), on_loss)
