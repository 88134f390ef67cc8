import re

import pytest
from conftest import optimized_plan, physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.functions import inspect
from fieldloom.functions.applying import COMPILED_RULES, apply, rule_set
from fieldloom.functions.compiling import (
    FormulaError, compile_formula, compile_map, formula_parts,
)
from fieldloom.functions.metadata import FORMULA_SCHEMA, formula_map, from_map, latest

# (formula, class, lenient value for a=A, b=NULL, x=X; None where it cannot be applied)
VECTORS = [
    ("[a]", "OK", "A"),
    ('[a]&[b]&"-"', "OK", "A-"),
    ("[b]", "OK", ""),
    ("[a_x]", "OK", "X"),
    ('""', "OK", ""),
    ('"p&q"', "OK", '"pq"'),
    ("[p&q]", "OK", "[pq]"),
    ("[x y]", "OK", "spaced"),
    ("[a[b]", "OK", "odd"),
    ("[c.d]", "OK", "dotted"),
    ("abc", "MISMATCH", "abc"),
    ('[a] & "b"', "MISMATCH", "Ab"),
    ("[a]]", "MISMATCH", None),
    ("[a]\n", "MISMATCH", "A"),
    ("  ", "MISMATCH", ""),
    ("[a][b]", "ILLEGAL_LEXICON", None),
    ("[a]&", "ILLEGAL_LEXICON", "A"),
    ("&[a]", "ILLEGAL_LEXICON", "A"),
    ('"a""b"', "ILLEGAL_LEXICON", 'a""b'),
    ("[a", "ILLEGAL_LEXICON", "[a"),
    ('"', "ILLEGAL_LEXICON", None),
    ("&", "ILLEGAL_LEXICON", ""),
    ("[]", "BLANK_FIELD", None),
    ("[ a]", "BLANK_FIELD", None),
    ("[a_]", "OK", None),
]
APPLICABLE = [(f, v) for f, _, v in VECTORS if v is not None]


def model_class(f):
    """The grammar as a plain scan, independent of the patterns under test."""
    if not f:
        return "EMPTY"
    marks, parts, i = [], [], 0
    while i < len(f):
        c = f[i]
        if c in '["':
            close = f.find("]" if c == "[" else '"', i + 1)
            marks.append(c)
            if close < 0:
                break
            marks.append(f[close])
            parts.append(f[i : close + 1])
            i = close
        elif c == "&":
            marks.append(c)
        i += 1
    text = "".join(marks)
    if text and not re.fullmatch(r'(\[\]|"")(&(\[\]|""))*', text):
        return "ILLEGAL_LEXICON"
    padding = "".join(map(chr, range(33)))
    for p in parts:
        if p[0] == "[" and (p == "[]" or p[1:-1] != p[1:-1].strip(padding)):
            return "BLANK_FIELD"
    return "OK" if "&".join(parts) == f else "MISMATCH"


def model_position(f):
    """(position, lexeme) of the error, from the same scan."""
    kind = model_class(f)
    if kind in ("OK", "EMPTY"):
        return None, None
    if kind == "MISMATCH":
        return 0, None
    marks, ends, i = [], [], 0
    while i < len(f):
        if f[i] in '["':
            close = f.find("]" if f[i] == "[" else '"', i + 1)
            marks.append(f[i])
            if close < 0:
                break
            marks.append(f[close])
            ends.append((f[i : close + 1], close + 1))
            i = close
        elif f[i] == "&":
            marks.append("&")
        i += 1
    if kind == "BLANK_FIELD":
        padding = "".join(map(chr, range(33)))
        return next(e for p, e in ends if p[0] == "[" and (p == "[]" or p[1:-1] != p[1:-1].strip(padding))), None
    i = 0
    while True:
        c, after = marks[i], [*marks[i + 1 : i + 3], None, None]
        bad = (
            (c == "[" and after[0] != "]") or (c == "]" and (i == 0 or after[0] not in ("&", None)))
            or (c == "&" and (i == 0 or after[0] not in ("[", '"')))
            or (c == '"' and (after[0] != '"' or after[1] not in ("&", None)))
        )
        if bad:
            return i, c
        i += 2 if c == '"' else 1


def make_rules(spark, table):
    return spark.createDataFrame(
        [(c, f, t, i) for i, (c, f, t) in enumerate(table)], FORMULA_SCHEMA
    )


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "A", None, "X", "spaced", "odd", "dotted", "old")],
        "category_id long, a string, b string, x string, `x y` string, `a[b` string, "
        "`c.d` string, target string",
    )


def test_vectors_are_classified(spark):
    table = [(f, c) for f, c, _ in VECTORS] + [("", "EMPTY"), (None, "EMPTY")]
    df = inspect.validate(spark.createDataFrame(table, "formula string, expected string"))
    assert df.where("error_class <> expected").collect() == []
    assert df.where("is_valid <> (expected = 'OK')").collect() == []
    assert [model_class(f) for f, _, _ in VECTORS] == [c for _, c, _ in VECTORS]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text('[]"&a \n', max_size=14), min_size=200, max_size=400))
def test_validation_agrees_with_a_plain_scan(spark, formulas):
    df = spark.createDataFrame([(f,) for f in formulas], "formula string")
    for r in inspect.validate(df).collect():
        assert r["error_class"] == model_class(r["formula"]), r["formula"]
        assert (r["error_position"], r["error_lexeme"]) == model_position(r["formula"]), r["formula"]


def test_all_short_formulas(spark):
    """Every string of up to five structural characters."""
    chars = F.array(*[F.lit(c) for c in '[]"&a '])
    df = spark.createDataFrame([("",)], "formula string")
    seen = df
    for _ in range(5):
        df = df.select(F.explode(F.transform(chars, lambda c: F.concat("formula", c))).alias("formula"))
        seen = seen.union(df)
    found = inspect.validate(seen).select("formula", "error_class").collect()
    assert len(found) == sum(6**n for n in range(6))
    assert [r for r in found if r["error_class"] != model_class(r["formula"])] == []


def test_long_formulas_do_not_overflow(spark):
    n = 50_000
    df = spark.createDataFrame(
        [("&".join(["[a]"] * n),), ('"' + "x" * 10 * n + '"',), ("&" * n,), ("x]" * n,)],
        "formula string",
    )
    found = [r["error_class"] for r in inspect.validate(df).collect()]
    assert found == ["OK", "OK", "ILLEGAL_LEXICON", "MISMATCH"]


@pytest.mark.parametrize("form", ["compiled", "lookup", "parts"])
@pytest.mark.parametrize("limit_bytes", [None, 0])
def test_lenient_values(spark, items, form, limit_bytes):
    cases = spark.createDataFrame(
        [(i, v) for i, (_, v) in enumerate(APPLICABLE)], "category_id long, expected string"
    )
    wide = items.drop("category_id").withColumn(
        "category_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(APPLICABLE)).cast("long")))
    )
    rules = make_rules(spark, [(i, "target", f) for i, (f, _) in enumerate(APPLICABLE)])
    options = {"compiled": {}, "lookup": {"form": "lookup"},
               "parts": {"form": "lookup", "max_shapes": 1}}[form]
    result = apply(wide, rules, limit_bytes=limit_bytes, **options)
    assert result.columns == wide.columns
    checked = result.join(cases, "category_id", "left").select("category_id", "target", "expected")
    for r in checked.collect():
        expected = "old" if r["category_id"] == len(APPLICABLE) else r["expected"]
        assert r["target"] == expected, r


@pytest.mark.parametrize("form", ["compiled", "lookup"])
@pytest.mark.parametrize("formula", [f for f, _, v in VECTORS if v is None])
def test_inapplicable_formulas_are_reported(spark, items, form, formula):
    with pytest.raises(FormulaError) as error:
        apply(items, make_rules(spark, [(1, "target", formula), (2, "target", "[a]")]), form=form)
    assert len(error.value.problems) == 1


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_strict_syntax(spark, items, form):
    table = [(1, "target", '"p&q"&[a]'), (1, "x", "[a] & bare")]
    with pytest.raises(FormulaError):
        apply(items, make_rules(spark, table), syntax="strict", form=form)
    skipped = apply(
        items, make_rules(spark, table), syntax="strict", on_invalid="skip", form=form
    ).first()
    assert (skipped["target"], skipped["x"]) == ("p&qA", "X")


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_snapshot_and_sequential(spark, items, form):
    rules = make_rules(spark, [(1, "a", '"new"'), (1, "target", "[a]"), (1, "x", "[target]")])
    snapshot = apply(items, rules, form=form).first()
    assert (snapshot["a"], snapshot["target"], snapshot["x"]) == ("new", "A", "old")
    chained = apply(items, rules, mode="sequential", order=["a", "target", "x"], form=form).first()
    assert (chained["a"], chained["target"], chained["x"]) == ("new", "new", "new")
    with pytest.raises(ValueError):
        apply(items, rules, mode="sequential", order=["a"], form=form)
    with pytest.raises(ValueError):
        apply(items, rules, mode="sequential")


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_types_become_text(spark, form):
    df = spark.sql(
        "SELECT 1L category_id, 5 i, CAST(10 AS DECIMAL(10,2)) d, true t, 1.0D f, "
        "TIMESTAMP'2024-01-01 00:00:00' ts, array('p', null, 'q') l, array(1, 2) n, 7 target"
    )
    formula = '[i]&" "&[d]&" "&[t]&" "&[f]&" "&[ts]&" "&[l]&" "&[n]'
    rules = make_rules(spark, [(1, "target", formula), (1, "i", "abc"), (2, "d", "x")])
    row = apply(df, rules, form=form).first()
    assert row["target"] == "5 10.00 true 1.0 2024-01-01 00:00:00 pq 12"
    assert (row["i"], row["d"]) == ("abc", "10.00")


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_targets_must_exist(spark, items, form):
    with pytest.raises(FormulaError):
        apply(items, make_rules(spark, [(1, "missing", "[a]")]), form=form)


def test_names_resolve_without_case_but_the_prefix_does_not(spark, items):
    for form in ("compiled", "lookup"):
        row = apply(items, make_rules(spark, [(1, "TARGET", "[A]&[a_X]")]), form=form).first()
        assert row["target"] == "AX"
        with pytest.raises(FormulaError):
            apply(items, make_rules(spark, [(1, "target", "[A_x]")]), form=form)


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_last_definition_wins(spark, items, form):
    rules = make_rules(spark, [(1, "target", "[a]"), (1, "x", "[a]"), (1, "target", "[x]"), (1, "x", None)])
    row = apply(items, rules, form=form).first()
    assert (row["target"], row["x"]) == ("X", "X")
    unversioned = rules.drop("formula_id")
    with pytest.raises(FormulaError):
        apply(items, unversioned.where("formula is not null"), form=form)


def test_unmatched_and_null_categories_keep_their_values(spark, items):
    many = items.unionByName(items.withColumn("category_id", F.lit(9).cast("long"))).unionByName(
        items.withColumn("category_id", F.lit(None).cast("long"))
    )
    many = many.unionByName(many)
    rules = make_rules(spark, [(1, "target", "[a]"), (None, "target", "[x]")])
    for options in ({}, {"form": "lookup"}, {"form": "lookup", "limit_bytes": 0, "hot_rows": 1}):
        found = rows(apply(many, rules, **options).select("category_id", "target"))
        assert found == [(None, "old")] * 2 + [(1, "A")] * 2 + [(9, "old")] * 2


def test_no_rules(spark, items):
    empty = make_rules(spark, [(1, "target", "")])
    for form in ("compiled", "lookup"):
        assert apply(items, empty, form=form).first()["target"] == "old"


def test_sql_dialect(spark):
    df = spark.sql("SELECT 1L category_id, CAST(80 AS DECIMAL(10,2)) price, 25 pct, 'b' name")
    rules = make_rules(spark, [(1, "price", "price - price * pct / 100"), (1, "name", "concat(name, '!')")])
    row = apply(df, rules, dialect="sql")
    assert row.schema == df.schema or row.dtypes == df.dtypes
    assert [str(v) for v in row.first()] == ["1", "60.00", "25", "b!"]
    with pytest.raises(ValueError):
        apply(df, rules, dialect="sql", form="lookup")


def test_categories_share_a_branch(spark, items):
    rules = make_rules(spark, [(i, "target", "[a]") for i in range(1, 50)])
    plan = physical_plan(apply(items, rules))
    assert plan.count("concat_ws") == 1


def test_compiled_formulas_add_no_shuffle_and_no_join(spark, items):
    plan = physical_plan(apply(items, make_rules(spark, [(1, "target", "[a]")])))
    assert "Exchange" not in plan and "Join" not in plan


def test_small_lookup_does_not_shuffle_the_items(spark):
    items = spark.range(1000).selectExpr("id % 7 category_id", "'t' target", "id")
    rules = make_rules(spark, [(i, "target", f'"{i}"&[id]') for i in range(5)])
    plan = physical_plan(apply(items, rules, form="lookup"))
    join = plan[plan.index("BroadcastHashJoin"):]
    assert "SortMergeJoin" not in plan
    streamed = join[: join.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in streamed


def test_rules_beyond_the_compiled_limit_are_looked_up(spark, items):
    rules = make_rules(spark, [(i, "target", f'"{i}"') for i in range(20)])
    with pytest.raises(ValueError):
        apply(items, rules, form="compiled", max_rules=10)
    assert apply(items, rules, max_rules=10).first()["target"] == "1"


PARTS = st.sampled_from(["[a]", "[b]", "[a_x]", '"t"', " bare ", '"p&q"', "", "[x y]", "[c.d] "])


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PARTS, min_size=1, max_size=5).map("&".join), min_size=5, max_size=25))
def test_forms_agree(spark, items, formulas):
    wide = items.withColumn(
        "category_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(formulas)).cast("long")))
    )
    rules = make_rules(spark, [(i, "target", f) for i, f in enumerate(formulas)])
    keys = ("category_id", "target")
    compiled = rows(apply(wide, rules, form="compiled").select(*keys))
    assert rows(apply(wide, rules, form="lookup").select(*keys)) == compiled
    assert rows(apply(wide, rules, form="lookup", max_shapes=0).select(*keys)) == compiled


def test_parts_and_references(spark):
    df = spark.createDataFrame([(1, '[a] & "x&y"&[a_b]&c')], "id int, formula string")
    strict = [r["part"] for r in inspect.explode_parts(df).orderBy("pos").collect()]
    lenient = inspect.explode_parts(df, syntax="lenient").orderBy("pos").collect()
    assert strict == ["[a]", '"x&y"', "[a_b]"]
    assert [r["part"] for r in lenient] == ["[a]", '"x', 'y"', "[a_b]", "c"]
    assert rows(inspect.references(df).select("reference")) == [("a",), ("b",)]
    assert formula_parts('[a] & "x&y"', "strict") == [("field", "a"), ("literal", "x&y")]


def test_compile_formula_alone(spark, items):
    row = items.select(compile_formula(items, '[a]&"/"&[b]&[x]').alias("v")).first()
    assert row["v"] == "A/X"


def test_latest_and_map(spark):
    rules = make_rules(spark, [(1, "f", "old"), (1, "f", "new"), (1, "g", "x"), (2, "f", "y"), (2, "f", None)])
    assert rows(latest(rules).select("category_id", "field_name", "formula")) == [
        (1, "f", "new"), (1, "g", "x"), (2, "f", ""),
    ]
    found = {r["category_id"]: r["formulas"] for r in formula_map(rules).collect()}
    assert found == {1: {"f": "new", "g": "x"}, 2: {"f": ""}}


def test_maps(spark, items):
    given = {1: {"target": "[a]", "x": None}, 2: {"target": ""}}
    compiled = compile_map(items, given)
    assert {c: sorted(f) for c, f in compiled.items()} == {1: ["target"], 2: []}
    assert items.select(compiled[1]["target"].alias("v")).first()["v"] == "A"
    assert apply(items, from_map(spark, given)).first()["target"] == "A"


def test_case_sensitive_sessions(spark, items):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        for form in ("compiled", "lookup"):
            with pytest.raises(FormulaError):
                apply(items, make_rules(spark, [(1, "target", "[A]")]), form=form)
            row = apply(items, make_rules(spark, [(1, "target", "[a]")]), form=form).first()
            assert row["target"] == "A"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_a_hot_category_is_split(spark):
    """A third of the rows, all alike, in one category of a rule set too large to broadcast."""
    rows_in = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 7 else id % 40 end category_id",
        "case when id % 3 = 0 then 'same' else concat('n', id) end name",
        "'old' target",
    )
    rules = make_rules(spark, [(i, "target", f'"{i}-"&[name]') for i in range(30)])
    split = apply(rows_in, rules, form="lookup", limit_bytes=0, hot_rows=100)
    assert "__salt" in split._jdf.queryExecution().optimizedPlan().toString()
    expected = sorted(
        f"{r['category_id']}-{r['name']}" if r["category_id"] < 30 else "old"
        for r in rows_in.collect()
    )
    assert sorted(r["target"] for r in split.collect()) == expected


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_names_that_differ_in_case_are_one_field(spark, items, form):
    table = [(1, "target", '"one"'), (1, "TARGET", '"two"')]
    last = apply(items, make_rules(spark, table), form=form)
    assert [r["target"] for r in last.collect()] == ["two"]
    with pytest.raises(FormulaError, match="second formula"):
        apply(items, make_rules(spark, table).drop("formula_id"), form=form).collect()
    equal = spark.createDataFrame([(*r, 7) for r in table], FORMULA_SCHEMA)
    assert [r["target"] for r in apply(items, equal, form=form).collect()] == ["two"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["target", "TARGET", "Target", "b"]), st.sampled_from(["[a]", '"x"', "[x]"]), st.integers(0, 2)), min_size=1, max_size=12))
def test_forms_agree_on_versions_and_case(spark, items, table):
    rules = spark.createDataFrame(table, FORMULA_SCHEMA)
    rows_of = [rows(apply(items, rules, form=form).select("target", "b")) for form in ("compiled", "lookup")]
    assert rows_of[0] == rows_of[1]


@pytest.mark.parametrize("max_rules", [500, 2])
def test_bad_sql_formulas_are_reported_together(spark, items, max_rules):
    table = [(1, "target", "nope + 1"), (2, "target", "a ||| b"), (3, "b", "java_method('x', 'y')"), (4, "b", "upper(a)")]
    with pytest.raises(FormulaError) as error:
        apply(items, make_rules(spark, table), dialect="sql", max_rules=max(max_rules, 4) if max_rules > 2 else 4)
    assert len(error.value.problems) == 3 and "refused" in str(error.value)
    good = make_rules(spark, [(k, "target", "upper(a)" if k % 2 else "concat(a, 'z')") for k in range(1, 9)])
    assert [r["target"] for r in apply(items, good, dialect="sql", max_rules=max_rules).collect()] == ["A"]


def test_hot_categories_are_counted_on_the_narrow_table(spark, monkeypatch):
    from fieldloom.operators import skew

    seen = []
    counted = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda df, *rest: seen.append(df.columns) or counted(df, *rest))
    df = spark.range(300).selectExpr("id % 2 category_id", "cast(id as string) a", "'old' target")
    table = make_rules(spark, [(0, "target", "[a]"), (1, "target", '"x"&[a]')])
    found = apply(
        df, table, form="lookup", limit_bytes=0, hot_rows=20, keys_from=df.select("category_id", "a")
    )
    assert seen == [["__category"]]
    assert rows(found.where("a in ('4', '7')").select("a", "target")) == [("4", "4"), ("7", "x7")]


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_a_rule_for_no_field_has_one_meaning(spark, form):
    df = spark.createDataFrame([(1, "a")], "category_id long, x string")
    rules = spark.createDataFrame([(1, None, "b", 1), (1, "x", "c", 2)], FORMULA_SCHEMA)
    with pytest.raises(FormulaError, match="a rule for no field"):
        apply(df, rules, form=form)


def test_of_many_rules_only_the_distinct_formulas_reach_the_driver(spark):
    items = spark.range(1500).selectExpr("id category_id", "cast(id as int) target", "'n' || id note", "'x' a")
    table = spark.range(1400).selectExpr(
        "id category_id", "explode(array('target', 'note')) field_name", "CASE WHEN id % 2 = 0 THEN '[a]&\"z\"' ELSE '[target]&\"b\"' END formula",
        "1L formula_id")
    assert len(rule_set(table, max_rules=10**6).rows or ()) <= COMPILED_RULES
    expected = rows(apply(items, table, form="lookup"))
    order = ["target", "note"]
    for form, many in (("compiled", 10**6), ("compiled", 5), ("auto", 10**6)):
        found = apply(items, table, form=form, max_rules=many)
        assert rows(found) == expected
        assert len(optimized_plan(found)) < 20_000  # no list of categories
        again = apply(items, table, form=form, max_rules=many, mode="sequential", order=order)
        assert rows(again) == rows(apply(items, table, form="lookup", mode="sequential", order=order))
    ordered = apply(items, table.where("field_name = 'note'"), form="compiled", mode="sequential", order="auto", max_rules=10**6)
    assert {r["note"] for r in ordered.where("category_id = 1").collect()} == {"1b"}
    with pytest.raises(ValueError):
        apply(items, table, form="compiled", max_rules=3)
    with pytest.raises(FormulaError, match="unknown column 'a'"):
        apply(items.drop("a"), table, form="compiled", max_rules=10**6)


def test_a_category_that_is_no_whole_number_fits_no_rule(spark):
    items = spark.sql("SELECT explode(array(1D, 1.5D, double('NaN'), null)) category_id, 'kept' target")
    table = spark.range(600).selectExpr("id category_id", "'target' field_name", "'made' formula", "1L formula_id")
    found = apply(items, table, form="compiled", max_rules=10**6)
    assert sorted(r["target"] for r in found.collect()) == ["kept", "kept", "kept", "made"]
