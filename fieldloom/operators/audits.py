"""Integrity checks that a database would enforce, as jobs over lake tables."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fieldloom.functions.inspect import references
from fieldloom.operators.joins import join_on_pairs
from fieldloom.operators.schema import col


def duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    where: Column | None = None,
    count: str = "n",
    nulls: str = "distinct",
) -> DataFrame:
    """Key values held by more than one row (of those satisfying ``where``).

    Keys with a null part are never equal, as under SQL's UNIQUE; with ``nulls="equal"``
    they are, as for a primary key.
    """
    if nulls not in ("distinct", "equal"):
        raise ValueError(f"nulls must be 'distinct' or 'equal', not {nulls!r}")
    rows = df if where is None else df.where(where)
    if nulls == "distinct":
        for k in keys:
            rows = rows.where(col(k).isNotNull())
    return rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(count)).where(
        col(count) > 1
    )


def orphans(
    child: DataFrame, parent: DataFrame, pairs: Sequence[tuple[str, str]], count: str = "n"
) -> DataFrame:
    """Foreign keys without a parent, with the number of child rows holding each.

    Child keys are counted before the join, so a hot key reaches it as one row.  Keys
    with a null part are exempt, as in SQL.
    """
    keys = [c for c, _ in pairs]
    held = child.select(*[col(k) for k in keys]).na.drop().groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias(count)
    )
    return join_on_pairs(held, parent.select(*[col(p) for _, p in pairs]), pairs, "left_anti")


def _per_column(counts: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One wide aggregate row → one row per checked column."""
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            *[F.col(f"{m}_{i}").alias(m) for m in measures],
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column that must not be null, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(col(c).isNull()).alias(f"n_null_{i}") for i, c in enumerate(columns)],
    )
    return _per_column(counts, columns, ["n_null"])


def domain(df: DataFrame, column: str, allowed: Sequence, count: str = "n") -> DataFrame:
    """Values outside the allowed set, with their row counts; nulls are exempt."""
    return (
        df.where(~col(column).isin(list(allowed)))
        .groupBy(col(column))
        .agg(F.count(F.lit(1)).alias(count))
    )


def lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per text column: rows longer than its limit and the greatest length, in one pass."""
    aggregates = []
    for i, (c, limit) in enumerate(limits.items()):
        aggregates += [
            F.count_if(F.length(col(c)) > limit).alias(f"n_too_long_{i}"),
            F.max(F.length(col(c))).alias(f"max_length_{i}"),
        ]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    return _per_column(counts, list(limits), ["n_too_long", "max_length"])


def decimals(df: DataFrame, limits: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Per numeric column: rows whose value does not fit DECIMAL(precision, scale)."""
    aggregates = [
        F.count_if(col(c).isNotNull() & col(c).try_cast(f"decimal({p},{s})").isNull()).alias(
            f"n_out_of_range_{i}"
        )
        for i, (c, (p, s)) in enumerate(limits.items())
    ]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    return _per_column(counts, list(limits), ["n_out_of_range"])


def _sharing(df: DataFrame, keys: Sequence[Sequence[str]]) -> tuple[int, list[int]]:
    """The number of rows, and per candidate key how many share it with others: grouping sets."""
    columns = list(dict.fromkeys(c for key in keys for c in key))
    names = {c: f"k{i}" for i, c in enumerate(columns)}
    renamed = df.select(*[col(c).alias(n) for c, n in names.items()])
    sets = [[F.col(names[c]) for c in key] for key in keys]
    counted = renamed.groupingSets(sets, *names.values()).agg(
        F.grouping_id().alias("left_out"), F.count(F.lit(1)).alias("n")
    )
    # A set is known by the columns it leaves out.
    ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key) for key in keys]
    sums = [F.sum(F.when(F.col("left_out") == ids[0], F.col("n")))]
    for key, g in zip(keys, ids, strict=True):
        shared = (F.col("left_out") == g) & (F.col("n") > 1)
        for c in key:
            shared = shared & F.col(names[c]).isNotNull()
        sums.append(F.sum(F.when(shared, F.col("n"))))
    n_rows, *found = counted.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return n_rows or 0, [n or 0 for n in found]


def suite(
    df: DataFrame,
    keys: Sequence[Sequence[str]] = (),
    not_null: Sequence[str] = (),
    domains: Mapping[str, Sequence] | None = None,
    lengths: Mapping[str, int] | None = None,
    decimals: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """(rule, subject, n_rows, n_bad) for all rules of a table, from one scan.

    Candidate ``keys`` are counted together by grouping sets, so one shuffle carries them all;
    ``n_bad`` is the number of rows that share their key with others (null parts are never
    equal).  Rules on columns are metrics observed in that same scan: nulls, values outside a
    domain, texts too long, numbers that do not fit DECIMAL(precision, scale).  Runs at once;
    what comes back is a row a rule.
    """
    bad: list[tuple[str, str, Column]] = [("not null", c, col(c).isNull()) for c in not_null]
    bad += [("domain", c, ~col(c).isin(list(v))) for c, v in (domains or {}).items()]
    bad += [("length", c, F.length(col(c)) > n) for c, n in (lengths or {}).items()]
    bad += [
        ("decimal", c, col(c).isNotNull() & col(c).try_cast(f"decimal({p},{s})").isNull())
        for c, (p, s) in (decimals or {}).items()
    ]
    metrics = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(wrong).alias(f"bad_{i}") for i, (_, _, wrong) in enumerate(bad)]]
    repeated: list[int] = []
    if keys:
        observed = Observation()
        n_rows, repeated = _sharing(df.observe(observed, *metrics), keys)
        # A scan without rows may be planned away, and its metrics with it.
        seen = observed.get if n_rows else defaultdict(int)
    else:
        seen = df.agg(*metrics).first().asDict()
    rows = [("key", ", ".join(key), seen["n_rows"], n) for key, n in zip(keys, repeated, strict=True)]
    rows += [(rule, c, seen["n_rows"], seen[f"bad_{i}"]) for i, (rule, c, _) in enumerate(bad)]
    return df.sparkSession.createDataFrame(rows, "rule string, subject string, n_rows long, n_bad long")


def unresolved(
    formulas: DataFrame,
    names: DataFrame,
    name: str = "name",
    formula: str = "formula",
    syntax: str = "lenient",
) -> DataFrame:
    """References to columns not in ``names``, with the number of uses of each."""
    uses = references(formulas, formula, syntax).select("reference")
    return orphans(uses, names.select(col(name)), [("reference", name)], count="n_uses")
