"""Formula columns: validity, parts, references and round trip.

Everything here is a native Column expression over a column of formula texts, so
it runs as a narrow projection next to the scan, however many formulas there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import grammar as g
from fieldloom.operators.schema import col


def trimmed(text: Column) -> Column:
    """Strip all leading and trailing characters up to U+0020."""
    return F.regexp_replace(text, g.PADDING, "")


def parts(formula: Column, syntax: str = "strict") -> Column:
    """Array of the formula's parts in order, delimiters included."""
    if g.check_syntax(syntax) == "strict":
        return F.regexp_extract_all(formula, F.lit(g.TOKEN), F.lit(0))
    pieces = F.transform(F.split(formula, "&"), trimmed)
    return F.filter(pieces, lambda p: p != "")


def rebuilt(formula: Column) -> Column:
    """The formula put together again from its strict parts."""
    return F.array_join(parts(formula), "&")


def round_trips(formula: Column) -> Column:
    return rebuilt(formula) == formula


def lexemes(formula: Column) -> Column:
    return F.regexp_replace(formula, g.LEXEMES, g.LEXEMES_KEPT)


def error_class(formula: Column) -> Column:
    """EMPTY, ILLEGAL_LEXICON, BLANK_FIELD, MISMATCH or OK; the first that applies."""
    blank = F.exists(
        parts(formula), lambda p: p.startswith("[") & ~F.regexp_like(p, F.lit(g.FIELD))
    )
    return (
        F.when(formula.isNull() | (formula == ""), g.EMPTY)
        .when(~F.regexp_like(lexemes(formula), F.lit(g.LEXEME_ORDER)), g.ILLEGAL_LEXICON)
        .when(blank, g.BLANK_FIELD)
        .when(~round_trips(formula), g.MISMATCH)
        .otherwise(g.OK)
    )


def error_position(formula: Column) -> Column:
    """Where a formula is wrong; null where it is empty or right.

    For ILLEGAL_LEXICON the number of structural characters (brackets, quotes, ampersands)
    before the first that is out of place; for BLANK_FIELD the number of characters up to the
    end of the first blank field; 0 for MISMATCH, which concerns the whole text.
    """
    kind = error_class(formula)
    in_order = F.length(F.regexp_extract(lexemes(formula), g.LEXEMES_IN_ORDER, 0))
    to_blank = F.length(F.regexp_extract(formula, g.TO_BLANK_FIELD, 0))
    return (
        F.when(kind == g.ILLEGAL_LEXICON, in_order)
        .when(kind == g.BLANK_FIELD, to_blank)
        .when(kind == g.MISMATCH, 0)
    )


def error_lexeme(formula: Column) -> Column:
    """The structural character that is out of place, for ILLEGAL_LEXICON."""
    at = F.length(F.regexp_extract(lexemes(formula), g.LEXEMES_IN_ORDER, 0))
    found = F.substring(lexemes(formula), at + 1, F.lit(1))
    return F.when(error_class(formula) == g.ILLEGAL_LEXICON, found)


def validate(df: DataFrame, formula: str = "formula") -> DataFrame:
    """Add ``error_class``, ``error_position``, ``error_lexeme`` and ``is_valid``."""
    text = col(formula)
    return df.withColumns(
        {
            "error_class": error_class(text),
            "error_position": error_position(text),
            "error_lexeme": error_lexeme(text),
            "is_valid": error_class(text) == g.OK,
        }
    )


def is_field(part: Column) -> Column:
    return part.startswith("[") & part.endswith("]")


def is_quoted(part: Column) -> Column:
    return part.startswith('"') & part.endswith('"')


def body(part: Column) -> Column:
    """A part without its first and last character."""
    return F.substring(part, F.lit(2), F.greatest(F.length(part) - 2, F.lit(0)))


def field_name(part: Column) -> Column:
    """The column a bracketed part refers to."""
    return F.regexp_replace(body(part), r"\A" + g.ATTRIBUTE_PREFIX, "")


def explode_parts(df: DataFrame, formula: str = "formula", syntax: str = "strict") -> DataFrame:
    """One row per part: the input columns plus ``pos`` (from 0) and ``part``."""
    return df.select("*", F.posexplode(parts(col(formula), syntax)).alias("pos", "part"))


def references(df: DataFrame, formula: str = "formula", syntax: str = "lenient") -> DataFrame:
    """One row per column reference: the input columns plus ``reference``."""
    fields = F.transform(F.filter(parts(col(formula), syntax), is_field), field_name)
    return df.select("*", F.explode(fields).alias("reference"))
