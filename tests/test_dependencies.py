import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fieldloom.functions import dependencies as d
from fieldloom.functions.applying import apply, current_rules
from fieldloom.functions.compiling import FormulaError
from fieldloom.functions.metadata import from_map

FIELDS = "abcdef"
graphs = st.dictionaries(st.sampled_from(FIELDS), st.sets(st.sampled_from(FIELDS + "xy"), max_size=3), max_size=6)


def reach(graph, field):
    """{reference: smallest depth}, breadth first."""
    found, newest, depth = {}, set(graph.get(field, ())), 1
    while newest:
        found |= dict.fromkeys(newest, depth)
        newest = {g for f in newest if f != field for g in graph.get(f, ())} - found.keys()
        depth += 1
    return found


@settings(max_examples=300, deadline=None)
@given(graphs)
def test_cycles_and_layers(graph):
    circular = {f for f in graph for g in reach({k: v - {k} for k, v in graph.items()}, f) if g == f}
    assert {f for c in d.cycles(graph) for f in c} == circular
    if not circular:
        layer = d.layers_of(graph)
        assert set(layer) == set(graph)
        for f, read in graph.items():
            below = [layer[g] for g in read - {f} if g in graph]
            assert layer[f] == max((b + 1 for b in below), default=0)


def test_long_chains_need_no_recursion():
    graph = {f"f{i}": {f"f{i + 1}"} for i in range(5000)}
    assert d.layers_of(graph)["f0"] == 4999
    assert len(d.cycles(graph | {"f5000": {"f0"}})[0]) == 5001


def rules_of(spark, by_category):
    return current_rules(from_map(spark, {
        c: {f: "&".join(f"[{g}]" for g in sorted(read)) or '"k"' for f, read in graph.items()} for c, graph in by_category.items()
    }))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(graphs.filter(bool), min_size=1, max_size=4))
def test_tables_agree_with_the_driver(spark, found):
    by_category = dict(enumerate(found))
    rules = rules_of(spark, by_category)
    made = d.structures(rules, d.formula_references(rules))
    want = [(c, f, g, depth, g not in graph) for c, graph in by_category.items() for f in graph for g, depth in reach(graph, f).items()]
    assert rows(d.lineage(made)) == sorted(want, key=lambda r: tuple((True, str(v)) for v in r))
    problems = d.cycle_problems(by_category.items())
    if problems:
        with pytest.raises(FormulaError) as error:
            d.layers(made)
        assert {p[0] for p in error.value.problems} == {p[0] for p in problems}
    else:
        assert {tuple(r) for r in d.layers(made).collect()} == {(c, f, n) for c, g in by_category.items() for f, n in d.layers_of(g).items()}


RULES = {
    1: {"a": "[b]&1", "b": "[c]&2", "c": '[c]&"3"'},
    2: {"c": "[b]&1", "b": "[a]&2", "A": '"z"'},
    3: {"b": "[a]&[c]"},
    4: {"b": ""},
}
DATA = [(k, "a", "b", "c") for k in (1, 2, 3, 4, 5, None)]
WANT = [(1, "c321", "c32", "c3"), (2, "z", "z2", "z21"), (3, "a", "ac", "c"), *[(k, "a", "b", "c") for k in (4, 5, None)]]


@pytest.mark.parametrize("options", [{"form": "compiled"}, {"form": "lookup"}, {"form": "lookup", "max_shapes": 0}, {"form": "lookup", "limit_bytes": 0}])
def test_forms_agree_on_the_order(spark, options):
    df = spark.createDataFrame(DATA, "category_id long, a string, b string, c string")
    found = apply(df, from_map(spark, RULES), mode="sequential", order="auto", **options)
    assert found.columns == df.columns and rows(found) == sorted(WANT, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("max_rules", [500, 6])
def test_sql_formulas_in_order(spark, max_rules):
    df = spark.createDataFrame([(k, 1, 2, 3) for k in (1, 2, 3)], "category_id int, a int, b int, c int")
    rules = {1: {"a": "b + 1", "b": "c * 10"}, 2: {"c": "b * 2", "b": "-`A`"}, 3: {"a": "b + 1"}, 4: {"b": "c * 10"}, 5: {"b": "c * 10"}}
    found = apply(df, from_map(spark, rules), mode="sequential", order="auto", dialect="sql", max_rules=max_rules)
    assert rows(found) == [(1, 31, 30, 3), (2, 1, -1, -2), (3, 3, 2, 3)]


@pytest.mark.parametrize("form", ["compiled", "lookup"])
def test_all_cycles_are_reported_at_once(spark, form):
    df = spark.createDataFrame(DATA, "category_id long, a string, b string, c string")
    rules = from_map(spark, {1: {"a": "[b]", "b": "[a]", "c": "[a]"}, 2: {"a": "[b]", "b": "[c]", "c": "[a_a]"}, 3: {"a": "[a]"}})
    with pytest.raises(FormulaError) as error:
        apply(df, rules, mode="sequential", order="auto", form=form)
    assert {(p[0], p[1].split()[3]) for p in error.value.problems} == {("a -> b -> a", "1"), ("a -> b -> c -> a", "2")}


def test_other_orders_are_refused(spark):
    df = spark.createDataFrame(DATA, "category_id long, a string, b string, c string")
    with pytest.raises(ValueError, match="order must be"):
        apply(df, from_map(spark, RULES), mode="sequential", order="a")


def test_no_rules(spark):
    df = spark.createDataFrame(DATA, "category_id long, a string, b string, c string")
    none = from_map(spark, RULES).limit(0)
    for form in ("compiled", "lookup"):
        assert rows(apply(df, none, mode="sequential", order="auto", form=form)) == rows(df)
    made = d.structures(current_rules(none), d.formula_references(current_rules(none)))
    assert d.lineage(made).count() == 0 and d.layers(made).count() == 0


REFLECTION = "('java.lang.System', 'getProperty', 'user.name')"


@pytest.mark.parametrize(
    "text",
    [
        f"reflect{REFLECTION}", f"reflect/**/{REFLECTION}", f"`reflect`{REFLECTION}", f"REFLECT\n--x\n{REFLECTION}", f"system.builtin.reflect{REFLECTION}",
        f"concat(a, java_method{REFLECTION})", f"transform(array(a), x -> try_reflect{REFLECTION})[0]", f"(select max(reflect{REFLECTION}))",
        f"(with q as (select reflect{REFLECTION} as x) select max(x) from q)", f"(select max(x) from values (reflect{REFLECTION}) as t(x))",
        f"case when a in (select java_method{REFLECTION}) then a end",
    ],
)
def test_foreign_code_is_refused_however_it_is_written(spark, text):
    df = spark.createDataFrame(DATA, "category_id long, a string, b string, c string")
    with pytest.raises(FormulaError, match="is refused"):
        apply(df, from_map(spark, {1: {"a": text}}), dialect="sql")


def test_names_in_literals_are_no_calls(spark):
    df = spark.createDataFrame(DATA, "category_id long, a string, b string, c string")
    found = apply(df, from_map(spark, {1: {"a": "concat(\"reflect('x')\", /* reflect('y') */ b)"}}), dialect="sql")
    assert found.where("category_id = 1").first()["a"] == "reflect('x')b"
