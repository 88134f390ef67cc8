"""Formula text → Column, for rule sets small enough to live in the plan."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import grammar as g
from fieldloom.operators.schema import col, folding


class FormulaError(ValueError):
    """Formulas that cannot be applied, each with its reason."""

    def __init__(self, problems: Iterable[tuple[str, str]]):
        self.problems = list(problems)
        listed = "; ".join(f"{formula!r}: {reason}" for formula, reason in self.problems)
        super().__init__(f"{len(self.problems)} formula problem(s): {listed}")


def formula_parts(formula: str, syntax: str = "lenient") -> list[tuple[str, str]]:
    """(kind, text) of each part, kind being ``field``, ``literal`` or ``broken``."""
    if g.check_syntax(syntax) == "strict":
        pieces = re.findall(g.TOKEN, formula)
    else:
        pieces = [p.strip(g.PADDING_CHARS) for p in formula.split("&")]
    kinds = []
    for piece in filter(None, pieces):
        if piece == '"':
            kinds.append(("broken", piece))
        elif piece[0] == "[" and piece[-1] == "]":
            kinds.append(("field", piece[1:-1].removeprefix(g.ATTRIBUTE_PREFIX)))
        elif piece[0] == '"' and piece[-1] == '"':
            kinds.append(("literal", piece[1:-1]))
        else:
            kinds.append(("literal", piece))
    return kinds


def as_text(df: DataFrame, name: str) -> Column:
    """A column as a formula sees it: its text, with arrays run together."""
    fold = folding(df.sparkSession)
    field_type = next(f.dataType for f in df.schema.fields if fold(f.name) == fold(name))
    if isinstance(field_type, T.ArrayType):
        return F.array_join(col(name).cast("array<string>"), "")
    return col(name).cast("string")


def problems(df: DataFrame, formula: str, syntax: str = "lenient") -> list[tuple[str, str]]:
    """Why a formula cannot be compiled against the columns of ``df``."""
    fold = folding(df.sparkSession)
    names = [fold(c) for c in df.columns]
    found = []
    for kind, text in formula_parts(formula, syntax):
        if kind == "broken":
            found.append((formula, "a lone quote"))
        elif kind == "field" and names.count(fold(text)) != 1:
            state = "ambiguous" if fold(text) in names else "unknown"
            found.append((formula, f"{state} column {text!r}"))
    return found


def compile_formula(df: DataFrame, formula: str, syntax: str = "lenient") -> Column:
    """The concatenation a formula describes; null fields contribute nothing."""
    found = problems(df, formula, syntax)
    if found:
        raise FormulaError(found)
    return F.concat_ws(
        "",
        *[
            as_text(df, text) if kind == "field" else F.lit(text)
            for kind, text in formula_parts(formula, syntax)
        ],
    )


def compile_map(
    df: DataFrame, formulas: Mapping[int, Mapping[str, str | None]], syntax: str = "lenient"
) -> dict[int, dict[str, Column]]:
    """Every formula of a category → field → formula map; empty ones are left out."""
    return {
        category: {f: compile_formula(df, text, syntax) for f, text in fields.items() if text}
        for category, fields in formulas.items()
    }
