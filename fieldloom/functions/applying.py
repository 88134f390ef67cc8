"""Apply per-category formulas to rows.

Two physical forms give equal results.  The *compiled* form turns the rules into one CASE
per target field with a branch for each distinct formula.  A small rule set is all in the
plan: a narrow projection, no join.  Of a larger one only the distinct formulas are, and a
size-checked join brings the number of its formula to each category.  The *lookup* form
keeps the rules as data, one row per category with a parsed rule per target, attached
by a size-checked join, so neither plan size nor driver memory grows with the number
of rules.  Rules usually differ in category and literals but not in shape, so each
shape is compiled once and takes its literals from the rule; only rules of very many
shapes are evaluated part by part with higher-order functions.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import grammar as g
from fieldloom.functions.compiling import FormulaError, as_text, compile_formula, formula_parts, problems
from fieldloom.functions.dependencies import Graph, cycle_problems, formula_references, layers, layers_of, structures
from fieldloom.functions.inspect import (
    body,
    field_name,
    is_field,
    is_quoted,
    parts,
)
from fieldloom.functions.metadata import REPORTED_PROBLEMS, latest, only_valid
from fieldloom.operators.joins import lookup_join
from fieldloom.operators.pivots import pivot_wide
from fieldloom.operators.schema import col, folding, is_case_sensitive
from fieldloom.operators.sizing import ROW_OVERHEAD_BYTES, settled
from fieldloom.operators.skew import HOT_ROWS

# Above this many rules, planning the CASE costs more than a join; no more reach the driver.
COMPILED_RULES = 500
# Distinct (field, shape) pairs up to which the lookup form compiles each shape.
COMPILED_SHAPES = 200
UNRESOLVED = -1
AUTO = "auto"
NO_FIELD = "a rule for no field"
SECOND_FORMULA = "second formula for its category and field"

Rules = dict[str, dict[str, list[int]]]  # field → formula text → categories


def apply(
    df: DataFrame,
    formulas: DataFrame | RuleSet,
    category: str = "category_id",
    mode: str = "snapshot",
    order: Sequence[str] | str | None = None,
    syntax: str = "lenient",
    on_invalid: str = "fail",
    dialect: str = "concat",
    form: str = "auto",
    version: str = "formula_id",
    limit_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
    max_rules: int = COMPILED_RULES,
    max_shapes: int = COMPILED_SHAPES,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Replace each target field by its category's formula.

    ``formulas`` has category_id, field_name, formula and, where a (category, field)
    may repeat, the ``version`` column; or it is a ``rule_set`` made with the same options.  Rows whose category has no formula for a
    field keep the field's value.  In ``snapshot`` mode every formula reads the input
    row; in ``sequential`` mode fields are computed in ``order`` and later ones read
    earlier results.  ``order="auto"`` finds it for each category from what its formulas read:
    each field is computed after those it depends on, and fields that depend on each other in
    a circle raise.  With ``strict`` syntax, formulas the validator rejects raise
    (``on_invalid="fail"``) or are left out (``"skip"``).  With ``dialect="sql"`` a
    formula is a Spark SQL expression, cast to the type of its target field.  Rules too
    large to broadcast are joined with hot categories split; these are counted on
    ``keys_from``, a narrower table with the category column, where there is one.
    Up to ``max_rules`` rules are compiled, with ``form="compiled"`` any number of rules of up
    to as many distinct formulas.
    """
    g.check_syntax(syntax)
    for name, given, allowed in (
        ("mode", mode, ("snapshot", "sequential")),
        ("on_invalid", on_invalid, ("fail", "skip")),
        ("dialect", dialect, ("concat", "sql")),
        ("form", form, ("auto", "compiled", "lookup")),
    ):
        if given not in allowed:
            raise ValueError(f"{name} must be one of {allowed}, not {given!r}")
    if mode == "sequential" and not order:
        raise ValueError("sequential mode needs an order of fields")
    if isinstance(order, str) and order != AUTO:
        raise ValueError(f"order must be a list of fields or {AUTO!r}, not {order!r}")
    if dialect == "sql" and form == "lookup":
        raise ValueError("SQL formulas are planned by their texts, not looked up by parts")

    if isinstance(formulas, RuleSet):
        found = formulas
    else:
        found = rule_set(formulas, syntax, on_invalid, dialect, version, 0 if form == "lookup" else max_rules)
    if form != "lookup":
        if found.rows is not None:
            return _apply_compiled(df, found.rows, category, mode, order, syntax, dialect)
        if dialect == "sql" or form == "compiled" or max_rules > COMPILED_RULES and found.rules.count() <= max_rules:
            return _apply_texts(
                df, found.rules, category, mode, order, syntax, dialect, limit_bytes, hot_rows, max_rules, keys_from
            )
    return _apply_lookup(
        df, found.rules, category, mode, order, syntax, limit_bytes, hot_rows, max_shapes, keys_from
    )


class RuleSet(NamedTuple):
    """The rules that count, made once and checked; ``rows`` are all of them where they are few."""

    rules: DataFrame  # category_id, field_name, formula
    rows: list[Row] | None


def rule_set(
    formulas: DataFrame,
    syntax: str = "lenient",
    on_invalid: str = "fail",
    dialect: str = "concat",
    version: str = "formula_id",
    max_rules: int = COMPILED_RULES,
) -> RuleSet:
    """The rules of ``formulas`` as ``apply`` takes them, from few jobs: one makes them, one
    brings up to ``max_rules`` (and ``COMPILED_RULES``) to the driver, and only of more the checks are jobs."""
    max_rules = min(max_rules, COMPILED_RULES)
    rules = current_rules(formulas, version)
    if dialect == "concat" and syntax == "strict":
        rules = only_valid(rules, on_invalid)
    if version in formulas.columns:  # which leaves one rule a category and field
        rules = rules.withColumn("n", F.lit(1))
    else:
        rules = rules.groupBy("category_id", "field_name").agg(F.min("formula").alias("formula"), F.count(F.lit(1)).alias("n"))
    rules = settled(rules)
    rows = rules.limit(max_rules + 1).collect() if max_rules > 0 else None
    few = rows is not None and len(rows) <= max_rules
    wrong = F.col("field_name").isNull() | (F.col("n") > 1)
    bad = [r for r in rows if r["field_name"] is None or r["n"] > 1] if few else rules.where(wrong).limit(REPORTED_PROBLEMS).collect()
    if bad:
        raise FormulaError((r["formula"], NO_FIELD if r["field_name"] is None else SECOND_FORMULA) for r in bad[:REPORTED_PROBLEMS])
    return RuleSet(rules.drop("n"), rows if few else None)


def current_rules(formulas: DataFrame, version: str = "formula_id") -> DataFrame:
    """(category_id, field_name, formula): the rules that count, whatever form applies them. Names
    are folded first, then the last version is taken; without versions a rule may repeat."""
    rules = formulas.withColumn("field_name", _folded(formulas.sparkSession, F.col("field_name")))
    if version in formulas.columns:
        rules = latest(rules, version)
    rules = rules.where(F.col("category_id").isNotNull() & (F.col("formula") != ""))
    return rules.select("category_id", "field_name", "formula")


def _stages(graphs: Mapping[int, Graph]) -> dict[int, dict[str, int]]:
    """category → field → layer; all cycles in one error."""
    found = cycle_problems(sorted(graphs.items()))
    if found:
        raise FormulaError(found)
    return {category: layers_of(graph) for category, graph in graphs.items()}


def _ordered(targets: Sequence[str], mode: str, order: Sequence[str] | None) -> list[str]:
    if mode == "snapshot":
        return list(targets)
    left_out = [t for t in targets if t not in order]
    if left_out:
        raise ValueError(f"order does not mention target fields {left_out}")
    return [t for t in order if t in targets]


def _check_targets(df: DataFrame, targets: Sequence[str]) -> None:
    fold = folding(df.sparkSession)
    names = [fold(c) for c in df.columns]
    bad = [t for t in targets if names.count(fold(t)) != 1]
    if bad:
        raise FormulaError((t, "not exactly one column") for t in bad)


def case_by_category(
    df: DataFrame,
    field: str,
    by_formula: Mapping[str, Sequence[int]],
    category: str = "category_id",
    syntax: str = "lenient",
    dialect: str = "concat",
) -> Column:
    """One WHEN per distinct formula of the field, over all categories that share it."""
    target_type = df.schema[field].dataType
    result, otherwise = None, col(field)
    for formula, categories in by_formula.items():
        if dialect == "sql":
            value = F.expr(formula).cast(target_type)
        else:
            value = compile_formula(df, formula, syntax)
        here = col(category).isin(*sorted(categories))
        result = F.when(here, value) if result is None else result.when(here, value)
    # Without this cast, ANSI mode would coerce text to the type of a numeric target.
    return result.otherwise(otherwise if dialect == "sql" else otherwise.cast("string"))


def _replaced(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Replace columns by values that all read the columns as they were.

    The values get names of their own first: inside a lambda, Spark would resolve a
    column replaced in the same projection to its new value.
    """
    temporary = {f: f"__value_{i}" for i, f in enumerate(values)}
    computed = df.withColumns({temporary[f]: v for f, v in values.items()})
    return computed.select(
        *[col(temporary[c]).alias(c) if c in temporary else col(c) for c in df.columns]
    )


def _apply_compiled(df, rows, category, mode, order, syntax, dialect) -> DataFrame:
    fold, actual = folding(df.sparkSession), _actual(df)
    rules: Rules = defaultdict(lambda: defaultdict(list))
    for r in sorted(rows):
        field = actual.get(fold(r["field_name"]), r["field_name"])
        rules[field][r["formula"]].append(r["category_id"])

    _check_targets(df, list(rules))
    texts = dict.fromkeys(f for by_formula in rules.values() for f in by_formula)
    _check_texts(df, list(texts), syntax, dialect)

    if mode == "sequential" and order == AUTO:
        return _apply_in_layers(df, rows, actual, category, syntax, dialect)
    fields = _ordered(list(rules), mode, order)
    if mode == "snapshot":
        return _replaced(
            df, {f: case_by_category(df, f, rules[f], category, syntax, dialect) for f in fields}
        )
    for f in fields:
        df = df.withColumn(f, case_by_category(df, f, rules[f], category, syntax, dialect))
    return df


def _read_by(df: DataFrame, formula: str, syntax: str, dialect: str) -> set[str]:
    """The columns a formula reads, folded."""
    fold = folding(df.sparkSession)
    if dialect == "sql":
        known = {fold(c) for c in df.columns}
        # A name of several parts is a field of a column, or a column of a table.
        return {fold(n[0] if fold(n[0]) in known else n[-1]) for n in sql_names(df.sparkSession, formula)[1]}
    return {fold(text) for kind, text in formula_parts(formula, syntax) if kind == "field"}


def _apply_in_layers(df, rows, actual, category, syntax, dialect) -> DataFrame:
    """The compiled form by dependencies: one projection a layer, each rule in its own."""
    fold = folding(df.sparkSession)
    graphs: dict[int, dict[str, set[str]]] = defaultdict(dict)
    for r in rows:
        graphs[r["category_id"]][fold(r["field_name"])] = _read_by(df, r["formula"], syntax, dialect)
    stages = _stages(graphs)
    staged: dict[int, Rules] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for r in sorted(rows):
        field = fold(r["field_name"])
        staged[stages[r["category_id"]][field]][actual[field]][r["formula"]].append(r["category_id"])
    for layer in sorted(staged):
        values = {
            f: case_by_category(df, f, by_formula, category, syntax, dialect)
            for f, by_formula in staged[layer].items()
        }
        df = _replaced(df, values)
    return df


# Names of functions that run code of the caller's choice; rules are data, so they are refused.
REFUSED_FUNCTIONS = ("reflect", "java_method", "try_reflect")


def sql_names(spark: SparkSession, text: str) -> tuple[set[str], set[tuple[str, ...]]]:
    """(functions, columns as their name parts) in a SQL expression, as Spark's parser reads it.

    The text itself would mislead: comments, quoting and hints do not change what is called.
    """
    functions: set[str] = set()
    columns: set[tuple[str, ...]] = set()
    pending = [spark._jsparkSession.sessionState().sqlParser().parseExpression(text)]
    while pending:
        node = pending.pop()
        kind = node.getClass().getSimpleName()
        if kind in ("UnresolvedFunction", "UnresolvedTableValuedFunction"):
            names = node.nameParts() if kind == "UnresolvedFunction" else node.name()
            functions.add(names.last().lower())
        elif kind == "UnresolvedAttribute":
            columns.add(tuple(_each(node.nameParts())))
        # Expressions and plans alike have children; plans of subqueries and of their WITH
        # clauses hang elsewhere.
        pending += _each(node.children()) + _each(node.innerChildren())
        if kind in SUBQUERIES:
            pending.append(node.plan())
        elif _is_plan(node):
            pending += _each(node.expressions())
    return functions, columns


# Classes of Spark's parser that hold a plan.
SUBQUERIES = ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression")


def _each(held) -> list:
    return [held.apply(i) for i in range(held.length())]


def _is_plan(node) -> bool:
    return ".catalyst.plans." in node.getClass().getName() or node.getClass().getName().endswith(("UnresolvedRelation", "UnresolvedTableValuedFunction", "UnresolvedSubqueryColumnAliases", "UnresolvedInlineTable"))


def check_sql(df: DataFrame, texts: Sequence[str]) -> None:
    """Raise one error naming every SQL formula that cannot be applied to ``df``, and why."""
    found = []
    for text in texts:
        try:
            refused = sorted(sql_names(df.sparkSession, text)[0] & set(REFUSED_FUNCTIONS))
            if refused:
                found.append((text, f"function {refused[0]} is refused"))
                continue
            df.select(F.expr(text))
        except PySparkException as e:
            found.append((text, (e.getMessage() or str(e)).strip().splitlines()[0]))
    if found:
        raise FormulaError(found)


def _check_texts(df: DataFrame, texts: Sequence[str], syntax: str, dialect: str) -> None:
    """Raise one error naming every formula that cannot be applied to ``df``, and why."""
    if dialect == "sql":
        check_sql(df, texts)
        return
    found = [p for f in texts for p in problems(df, f, syntax)]
    if found:
        raise FormulaError(found)


def _apply_texts(
    df, rules, category, mode, order, syntax, dialect, limit_bytes, hot_rows, max_texts, keys_from
) -> DataFrame:
    """Many rules of few distinct texts: each text is planned once, and a category brings the
    number of its text."""
    texts = rules.select("field_name", "formula").distinct().limit(max_texts + 1).collect()
    if len(texts) > max_texts:
        raise ValueError(f"more than {max_texts} distinct formulas cannot be compiled; raise max_rules to plan them")
    actual, fold = _actual(df), folding(df.sparkSession)
    numbered: dict[str, list[str]] = defaultdict(list)
    for r in sorted(texts):
        numbered[actual.get(fold(r["field_name"]), r["field_name"])].append(r["formula"])
    targets = sorted(numbered)
    if not targets:
        return df
    _check_targets(df, targets)
    _check_texts(df, list(dict.fromkeys(f for fs in numbered.values() for f in fs)), syntax, dialect)

    number = F.lit(None).cast("int")
    for field, formulas in numbered.items():
        listed = F.array(*[F.lit(f) for f in formulas])
        here = F.col("field_name") == fold(field)
        number = F.when(here, F.array_position(listed, F.col("formula")).cast("int")).otherwise(number)
    layer = F.lit(0)
    if mode == "sequential" and order == AUTO:
        read = {f: sorted(_read_by(df, f, syntax, dialect)) for fs in numbered.values() for f in fs}
        listed = F.create_map(*[x for f, names in read.items() for x in (F.lit(f), F.array(*map(F.lit, names)).cast("array<string>"))])
        rules = _with_layers(rules, F.element_at(listed, F.col("formula")))
        layer = F.col("layer")
    rule = F.struct(number.alias("number"), layer.alias("layer"))
    rows = rules.select(F.col("category_id").alias("__category"), "field_name", rule.alias("rule"))
    wide = pivot_wide(rows, ["__category"], "field_name", "rule", values=[fold(t) for t in targets])
    wide = wide.toDF("__category", *[f"__text_{i}" for i in range(len(targets))])
    df = df.withColumn("__category", _as_key(df, category, wide))
    keys = _narrow_keys(keys_from, category, wide)
    df = lookup_join(df, wide, "__category", "left", limit_bytes, hot_rows, keys_from=keys)

    def value(i: int, field: str, layer: int | None = None) -> Column:
        rule, target_type = col(f"__text_{i}"), df.schema[field].dataType
        # Without this cast, ANSI mode would coerce text to the type of a numeric target.
        result = F.when(_idle(rule, layer), col(field) if dialect == "sql" else col(field).cast("string"))
        for k, text in enumerate(numbered[field], start=1):
            made = F.expr(text).cast(target_type) if dialect == "sql" else compile_formula(df, text, syntax)
            result = result.when(rule["number"] == k, made)
        return result

    values = {f: i for i, f in enumerate(targets)}
    if mode == "sequential" and order == AUTO:
        for layer in range(_depth(rules)):
            df = _replaced(df, {f: value(i, f, layer) for f, i in values.items()})
        return df.drop("__category", *[f"__text_{i}" for i in values.values()])
    fields = _ordered(targets, mode, order)
    if mode == "snapshot":
        df = _replaced(df, {f: value(values[f], f) for f in fields})
    else:
        for f in fields:
            df = df.withColumn(f, value(values[f], f))
    return df.drop("__category", *[f"__text_{i}" for i in values.values()])


def _as_key(df: DataFrame, category: str, wide: DataFrame) -> Column:
    """The category in the type of the rules'; null where that would change it, so that it fits no rule."""
    kind = wide.schema["__category"].dataType
    if df.select(col(category)).schema[0].dataType == kind:
        return col(category)
    key = col(category).try_cast(kind)
    return F.when(key == col(category), key)


def _idle(rule: Column, layer: int | None) -> Column:
    """Whether a row's rule says nothing, or not in this layer."""
    return rule.isNull() if layer is None else rule.isNull() | (rule["layer"] != layer)


def _with_layers(rules: DataFrame, references: Column) -> DataFrame:
    """The rules with the layer of each, from the dependencies within its category."""
    found = layers(structures(rules, references))
    return settled(rules.join(found, ["category_id", "field_name"]))


def _depth(rules: DataFrame) -> int:
    """The number of layers of rules that have one."""
    return (rules.agg(F.max("layer")).first()[0] or 0) + 1


def _apply_lookup(
    df, rules, category, mode, order, syntax, limit_bytes, hot_rows, max_shapes, keys_from
) -> DataFrame:
    spark = df.sparkSession
    automatic = mode == "sequential" and order == AUTO
    if automatic:
        rules = _with_layers(rules, formula_references(rules, syntax))
    parsed = rules.select(
        F.col("category_id").alias("__category"),
        "field_name",
        (F.col("layer") if automatic else F.lit(0)).alias("layer"),
        _parsed(df, F.col("formula"), syntax).alias("parts"),
    ).withColumn("shape", _shape(F.col("parts")))
    # What the driver gets is bounded: a few integers per distinct shape and field.
    size = F.octet_length(F.to_json("parts")) + ROW_OVERHEAD_BYTES
    shapes = (
        parsed.groupBy("field_name", "shape")
        .agg(F.sum(size.cast("long")).alias("size"))
        .limit(max_shapes + 1)
        .collect()
    )
    if len(shapes) <= max_shapes:
        size_bytes = sum(r["size"] for r in shapes)
        targets, referenced = _names_in(df, rules, syntax, shapes)
    else:
        shapes, size_bytes = None, None
        targets, referenced = _names_used(df, rules, syntax)
    if not targets:
        return df

    number = {f: i for i, f in enumerate(targets)}
    by_field = {f: [] for f in targets}
    for row in shapes or ():
        by_field[_actual(df)[row["field_name"]]].append(row["shape"])

    # One row per category, at most one rule per target column.
    rule = F.struct("parts", "layer")
    if shapes:
        rule = F.struct(
            "layer",
            _shape_number(df, by_field).alias("shape"),
            F.transform(
                F.filter("parts", lambda p: p["source"] == 0), lambda p: p["text"]
            ).alias("literals"),
        )
    wide = pivot_wide(
        parsed.select("__category", "field_name", rule.alias("rule")),
        ["__category"],
        "field_name",
        "rule",
        values=[folding(spark)(t) for t in targets],
    ).toDF("__category", *[f"__rule_{i}" for i in number.values()])
    # Like types, so that a hot category can be recognised on both sides.
    df = df.withColumn("__category", col(category).cast(wide.schema["__category"].dataType))
    keys = _narrow_keys(keys_from, category, wide)
    df = lookup_join(df, wide, "__category", "left", limit_bytes, hot_rows, size_bytes, keys)

    def value(field: str, layer: int | None = None) -> Column:
        rule = col(f"__rule_{number[field]}")
        kept = F.when(_idle(rule, layer), col(field).cast("string"))
        if shapes:
            return _by_shape(df, kept, rule, by_field[field])
        return kept.otherwise(_by_part(df, rule["parts"], referenced))

    if automatic:
        for layer in range(_depth(rules)):
            df = _replaced(df, {f: value(f, layer) for f in targets})
        return df.drop("__category", *[f"__rule_{i}" for i in number.values()])
    fields = _ordered(targets, mode, order)
    if mode == "snapshot":
        df = _replaced(df, {f: value(f) for f in fields})
    else:
        for f in fields:
            df = df.withColumn(f, value(f))
    return df.drop("__category", *[f"__rule_{i}" for i in number.values()])


def _narrow_keys(keys_from: DataFrame | None, category: str, wide: DataFrame) -> DataFrame | None:
    if keys_from is None:
        return None
    return keys_from.select(col(category).cast(wide.schema["__category"].dataType).alias("__category"))


def _actual(df: DataFrame) -> dict[str, str]:
    fold = folding(df.sparkSession)
    return {fold(c): c for c in df.columns}


def _folded(spark: SparkSession, name: Column) -> Column:
    return name if is_case_sensitive(spark) else F.lower(name)


def _parsed(df: DataFrame, formula: Column, syntax: str) -> Column:
    """Parts as (source, text): the position of the column read, 0 for a literal, or
    UNRESOLVED."""
    spark = df.sparkSession
    known = F.array(*[F.lit(name) for name in map(folding(spark), df.columns)])

    def part(p: Column) -> Column:
        position = F.array_position(known, _folded(spark, field_name(p))).cast("int")
        source = (
            F.when(p == '"', UNRESOLVED)
            .when(is_field(p), F.when(position > 0, position).otherwise(UNRESOLVED))
            .otherwise(0)
        )
        return F.struct(
            source.alias("source"), F.when(is_quoted(p), body(p)).otherwise(p).alias("text")
        )

    return F.transform(parts(formula, syntax), part)


def _shape(parsed: Column) -> Column:
    """What a formula does apart from the texts of its literals."""
    return F.array_join(F.transform(parsed, lambda p: p["source"].cast("string")), ",")


def _sources(shape: str) -> list[int]:
    return [int(s) for s in shape.split(",") if s]


def _shape_number(df: DataFrame, by_field: Mapping[str, Sequence[str]]) -> Column:
    number = F.lit(None).cast("int")
    for field, shapes in by_field.items():
        listed = F.array(*[F.lit(s) for s in shapes])
        here = F.col("field_name") == folding(df.sparkSession)(field)
        number = F.when(here, F.array_position(listed, F.col("shape")).cast("int")).otherwise(number)
    return number


def _by_shape(df: DataFrame, kept: Column, rule: Column, shapes: Sequence[str]) -> Column:
    """One compiled concatenation per shape, its literals taken from the rule."""
    for i, shape in enumerate(shapes, start=1):
        pieces, literals = [], 0
        for source in _sources(shape):
            if source:
                pieces.append(as_text(df, df.columns[source - 1]))
            else:
                pieces.append(F.get(rule["literals"], literals))
                literals += 1
        kept = kept.when(rule["shape"] == i, F.concat_ws("", *pieces))
    return kept.otherwise(F.raise_error(F.lit("the rules changed while they were applied")))


def _by_part(df: DataFrame, parsed: Column, referenced: Sequence[str]) -> Column:
    """Evaluate parts one by one, for rules of too many shapes to compile."""
    position = {c: i for i, c in enumerate(df.columns, start=1)}

    def text(p: Column) -> Column:
        # Tested in order, so only the column a part refers to is cast to text.
        chosen = F.when(p["source"] == 0, p["text"])
        for name in referenced:
            chosen = chosen.when(p["source"] == position[name], as_text(df, name))
        return chosen

    return F.concat_ws("", F.transform(parsed, text))


def _names_in(df, rules, syntax, shapes) -> tuple[list[str], list[str]]:
    """Target and referenced columns of the collected shapes, all of which resolve."""
    actual = _actual(df)
    fields = {r["field_name"] for r in shapes}
    sources = {s for r in shapes for s in _sources(r["shape"])} - {0}
    if UNRESOLVED in sources or not fields <= set(actual):
        return _names_used(df, rules, syntax)  # raises, naming the culprits
    targets = sorted(actual[f] for f in fields)
    referenced = sorted(df.columns[s - 1] for s in sources)
    _check_targets(df, [*targets, *referenced])
    return targets, referenced


def _names_used(df: DataFrame, rules: DataFrame, syntax: str) -> tuple[list[str], list[str]]:
    """Target and referenced columns, after checking that all of them resolve."""
    spark, actual = df.sparkSession, _actual(df)
    uses = F.concat(
        F.array(F.struct(F.lit("target").alias("use"), F.col("field_name").alias("name"))),
        F.transform(
            F.filter(parts(F.col("formula"), syntax), lambda p: is_field(p) | (p == '"')),
            lambda p: F.struct(
                F.when(is_field(p), "field").otherwise("broken").alias("use"),
                F.when(is_field(p), _folded(spark, field_name(p))).otherwise(p).alias("name"),
            ),
        ),
    )
    names = rules.select(F.explode(uses).alias("u")).select("u.*").distinct()
    # Names that resolve number at most twice the columns, so a full result of this
    # size always contains one that does not.
    rows = names.limit(2 * len(actual) + REPORTED_PROBLEMS).collect()
    bad = [r for r in rows if r["use"] == "broken" or r["name"] not in actual]
    if bad:
        raise FormulaError(
            (r["name"], "a lone quote" if r["use"] == "broken" else f"unknown {r['use']} column")
            for r in bad[:REPORTED_PROBLEMS]
        )
    targets = sorted(actual[r["name"]] for r in rows if r["use"] == "target")
    referenced = sorted(actual[r["name"]] for r in rows if r["use"] == "field")
    _check_targets(df, [*targets, *referenced])
    return targets, referenced
