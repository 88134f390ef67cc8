"""Formula metadata: load it, keep the last definition, group it per category."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import grammar as g
from fieldloom.functions.compiling import FormulaError
from fieldloom.functions.inspect import error_class
from fieldloom.operators.joins import lookup_join

ON_INVALID = ("fail", "skip")
REPORTED_PROBLEMS = 20

FORMULA_SCHEMA = T.StructType(
    [
        T.StructField("category_id", T.LongType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("formula", T.StringType()),
        T.StructField("formula_id", T.LongType()),
    ]
)


def load_metadata(
    category_field: DataFrame, formula: DataFrame, field_names: DataFrame
) -> DataFrame:
    """category_field ⋈ formula ⋈ field names → (category_id, field_name, formula, formula_id)."""
    rules = formula.select(
        F.col("id").alias("formula_id"),
        "category_field_id",
        "field_id",
        F.col("formula_definition").alias("formula"),
    )
    owners = category_field.select(F.col("id").alias("category_field_id"), "category_id")
    names = field_names.select(F.col("id").alias("field_id"), "field_name")
    named = lookup_join(rules, names, "field_id", "inner")
    return lookup_join(named, owners, "category_field_id", "inner").select(
        "category_id", "field_name", "formula", "formula_id"
    )


def from_map(
    spark: SparkSession, formulas: Mapping[int, Mapping[str, str | None]]
) -> DataFrame:
    """A hand-written category → field → formula map in the shape ``apply`` takes."""
    rows = [(c, f, text) for c, fields in formulas.items() for f, text in fields.items()]
    return spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)], FORMULA_SCHEMA
    )


def latest(formulas: DataFrame, version: str = "formula_id") -> DataFrame:
    """One row per (category, field): the one with the greatest ``version``.

    A null definition counts as an empty one, so it still replaces earlier ones.  Of equal
    versions the formula that is greater as text is taken; a null version never is.
    """
    text = F.coalesce(F.col("formula"), F.lit(""))
    known = formulas.where(F.col(version).isNotNull())
    return known.groupBy("category_id", "field_name").agg(
        F.max_by(text, F.struct(F.col(version), text)).alias("formula"),
        F.max(version).alias(version),
    )


def formula_map(
    formulas: DataFrame,
    version: str = "formula_id",
    syntax: str | None = None,
    on_invalid: str = "fail",
) -> DataFrame:
    """category_id → map of field name to its last formula.

    With a ``syntax`` of ``strict``, formulas the validator rejects raise or, with
    ``on_invalid="skip"``, are left out.  Each group holds at most one entry per distinct
    field name.
    """
    rules = latest(formulas, version)
    if syntax is not None and g.check_syntax(syntax) == "strict":
        rules = only_valid(rules, on_invalid)
    entry = F.struct("field_name", "formula")
    return rules.groupBy("category_id").agg(
        F.map_from_entries(F.collect_list(entry)).alias("formulas")
    )


def only_valid(rules: DataFrame, on_invalid: str) -> DataFrame:
    """The rules that follow the grammar; others raise (``"fail"``) or go (``"skip"``)."""
    if on_invalid not in ON_INVALID:
        raise ValueError(f"on_invalid must be one of {ON_INVALID}, not {on_invalid!r}")
    verdict = error_class(F.col("formula"))
    if on_invalid == "fail":
        bad = rules.select("formula", verdict.alias("why")).where(~F.col("why").isin(g.OK, g.EMPTY))
        found = bad.limit(REPORTED_PROBLEMS).collect()
        if found:
            raise FormulaError((r["formula"], r["why"]) for r in found)
    return rules.where(verdict == g.OK)


def targets(formulas: DataFrame) -> DataFrame:
    """The set of fields that any category computes."""
    return formulas.select("field_name").distinct()
