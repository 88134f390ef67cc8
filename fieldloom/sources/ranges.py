"""Key ranges of about equal numbers of rows, for parallel reads of clustered keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.schema import col

# The sketch's size: ranks are off by about 0.2 % of all rows.
SKETCH_K = 2048


def even_bounds(df: DataFrame, key: str, ranges: int) -> list[int]:
    """At most ``ranges`` - 1 rising bounds that cut the whole-number ``key`` into ranges of about
    as many rows; fewer where one value holds several ranges' rows.

    From one quantile sketch of fixed size, merged from partial ones.
    """
    if ranges < 1:
        raise ValueError("at least one range")
    sketch = df.where(col(key).isNotNull()).agg(F.kll_sketch_agg_bigint(col(key).cast("long"), SKETCH_K).alias("s"), F.count(F.lit(1)).alias("n"))
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    at = F.array(*[F.kll_sketch_get_quantile_bigint("s", F.lit(float(p))) for p in shares])
    found = sketch.select(F.when(F.col("n") > 0, at).alias("bounds")).first()["bounds"]
    return sorted(set(found or []))


def predicates(key: str, bounds: Sequence[int]) -> list[str]:
    """One condition a range, as a reader's ``predicates`` take them: every row, null keys
    included, satisfies exactly one."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *inner, f"{key} >= {bounds[-1]}"]
