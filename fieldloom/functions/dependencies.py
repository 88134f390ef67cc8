"""How the fields of a category depend on each other through its formulas.

A field depends on the fields its formula reads; a formula that reads its own field reads the stored
value, which is no dependency.  Categories mostly share their structure (which field reads which), so
all graph work is done once per distinct structure, by rounds of joins whose number is the length
of the longest chain, and categories are joined back at the end.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Set
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.compiling import FormulaError
from fieldloom.functions.inspect import field_name, is_field, parts
from fieldloom.functions.metadata import REPORTED_PROBLEMS
from fieldloom.operators.schema import is_case_sensitive
from fieldloom.operators.sizing import settled

Graph = Mapping[str, Set[str]]  # field → fields its formula reads


# --- one category, on the driver ------------------------------------------------


def components(graph: Graph) -> list[list[str]]:
    """The strongly connected components, each after those it depends on.

    Depth-first search with an explicit stack, so that chains may be long.
    """
    number: dict[str, int] = {}
    low: dict[str, int] = {}
    open_, found = [], []
    for root in sorted(graph):
        if root in number:
            continue
        walk = [(root, iter(sorted(graph[root] & graph.keys())))]
        number[root] = low[root] = len(number)
        open_.append(root)
        while walk:
            node, ahead = walk[-1]
            for other in ahead:
                if other not in number:
                    number[other] = low[other] = len(number)
                    open_.append(other)
                    walk.append((other, iter(sorted(graph[other] & graph.keys()))))
                    break
                if other in open_:
                    low[node] = min(low[node], number[other])
            else:
                walk.pop()
                if walk:
                    low[walk[-1][0]] = min(low[walk[-1][0]], low[node])
                if low[node] == number[node]:
                    at = open_.index(node)
                    found.append(sorted(open_[at:]))
                    del open_[at:]
    return found


def cycles(graph: Graph) -> list[list[str]]:
    """Groups of fields that depend on each other in a circle."""
    return [c for c in components(graph) if len(c) > 1]


def layers_of(graph: Graph) -> dict[str, int]:
    """Field → number of fields on the longest chain below it.  The graph must have no cycles."""
    layer: dict[str, int] = {}
    for (field,) in components(graph):
        layer[field] = max((layer[g] + 1 for g in graph[field] & graph.keys() - {field}), default=0)
    return layer


def cycle_problems(graphs: Iterable[tuple[int, Graph]]) -> list[tuple[str, str]]:
    """What ``FormulaError`` lists: a problem for each cycle of each category."""
    return [
        (" -> ".join([*c, c[0]]), f"fields of category {category} depend on each other")
        for category, graph in graphs
        for c in cycles(graph)
    ]


# --- all categories, as data ----------------------------------------------------


class Structures(NamedTuple):
    categories: DataFrame  # category_id, structure
    edges: DataFrame  # structure, field_name, reference (null for a field that reads nothing)


def formula_references(rules: DataFrame, syntax: str = "lenient") -> Column:
    """The names a formula reads, folded as the session does, each once."""
    sensitive = is_case_sensitive(rules.sparkSession)
    read = F.transform(F.filter(parts(F.col("formula"), syntax), is_field), field_name)
    return F.array_sort(F.array_distinct(read if sensitive else F.transform(read, F.lower)))


def structures(rules: DataFrame, references: Column) -> Structures:
    """``rules``: at most one per category and field, names folded; ``references`` an array."""
    fields = F.array_sort(F.collect_list(F.struct("field_name", references.alias("references"))))
    by_category = rules.groupBy("category_id").agg(fields.alias("fields"))
    named = settled(by_category.withColumn("structure", F.sha2(F.to_json("fields"), 256)))
    distinct = named.groupBy("structure").agg(F.first("fields").alias("fields"))
    each = distinct.select("structure", F.explode("fields").alias("f"))
    edges = each.select("structure", "f.field_name", F.explode_outer("f.references").alias("reference"))
    return Structures(named.select("category_id", "structure"), settled(edges))


def _inner(edges: DataFrame) -> DataFrame:
    """The edges to other fields that have a rule."""
    fields = edges.select("structure", F.col("field_name").alias("reference")).distinct()
    return edges.where("reference <> field_name").join(fields, ["structure", "reference"], "left_semi")


def layers(found: Structures) -> DataFrame:
    """(category_id, field_name, layer): fields of a layer only read fields of lower ones.

    Each round takes the fields that wait for nothing; what is left then waits in a circle and is
    reported, all cycles in one ``FormulaError``.
    """
    waiting = settled(_inner(found.edges).select("structure", "field_name", "reference"))
    left = found.edges.select("structure", "field_name").distinct()
    done: list[DataFrame] = []
    while True:
        blocked = waiting.select("structure", "field_name").distinct()
        ready = settled(left.join(blocked, ["structure", "field_name"], "left_anti"))
        if ready.isEmpty():
            if not waiting.isEmpty():
                raise FormulaError(_reported(found, waiting))
            break
        done.append(ready.withColumn("layer", F.lit(len(done))))
        left = blocked
        gone = ready.select("structure", F.col("field_name").alias("reference"))
        waiting = settled(waiting.join(gone, ["structure", "reference"], "left_anti").select("structure", "field_name", "reference"))
    if not done:
        return found.categories.select("category_id", F.lit("").alias("field_name"), F.lit(0).alias("layer")).limit(0)
    by_structure = done[0]
    for more in done[1:]:
        by_structure = by_structure.unionByName(more)
    return found.categories.join(by_structure, "structure").select("category_id", "field_name", "layer")


def _reported(found: Structures, waiting: DataFrame) -> list[tuple[str, str]]:
    """The cycles of a few structures, each with one category that has it."""
    some = waiting.select("structure").distinct().join(
        found.categories.groupBy("structure").agg(F.min("category_id").alias("category_id")), "structure"
    ).orderBy("category_id").limit(REPORTED_PROBLEMS)
    graphs: dict[int, dict[str, set[str]]] = {}
    for r in waiting.join(some, "structure").select("category_id", "field_name", "reference").collect():
        graphs.setdefault(r[0], {}).setdefault(r[1], set()).add(r[2])
    return cycle_problems(sorted(graphs.items()))


def lineage(found: Structures) -> DataFrame:
    """(category_id, field_name, reference, depth, is_base): everything a field depends on.

    ``depth`` is the smallest number of formulas in between, from 1; base references have no rule
    in the category.  Rounds only follow what the round before has newly reached, so
    cycles end: their fields reach themselves.
    """
    edges = found.edges.where(F.col("reference").isNotNull())
    reached = settled(edges.withColumn("depth", F.lit(1)))
    step = edges.select("structure", F.col("field_name").alias("via"), F.col("reference").alias("next"))
    newest, depth = reached, 1
    while not newest.isEmpty():
        depth += 1
        further = (
            newest.withColumnRenamed("reference", "via")
            .join(step, ["structure", "via"])
            .where("via <> field_name")  # its own rule has been followed already
            .select("structure", "field_name", F.col("next").alias("reference"))
            .distinct()
        )
        newest = settled(
            further.join(reached, ["structure", "field_name", "reference"], "left_anti").withColumn("depth", F.lit(depth))
        )
        reached = reached.unionByName(newest)
    ruled = found.edges.select("structure", F.col("field_name").alias("reference")).distinct().withColumn("ruled", F.lit(True))
    marked = reached.join(ruled, ["structure", "reference"], "left")
    return found.categories.join(marked, "structure").select(
        "category_id", "field_name", "reference", "depth", F.col("ruled").isNull().alias("is_base")
    )
