"""Exact top-k search by inner product.

Method: candidates are range-partitioned by falling length into blocks, queries into blocks of
their own. All vectors are rotated to the principal axes of the candidates (SVD of their d x d
moment matrix, the only thing summed to the driver), so that the first coordinates carry most of a
product. A query starts with the k-th best score among a bounded seed of longest vectors as its
threshold; a pair of blocks meets only if the longest candidate times the query's length can reach
it. Inside a pair of blocks the candidates come by falling length: partial sums over the first
axes plus the Cauchy-Schwarz bound of the rest (product of the residual lengths) decide what is
scored exactly, and thresholds rise as scores are found. Blocks return at most k rows a query.

Both sides are dealt in blocks, so a task holds one block of each; no vector set is broadcast but
the seed, whose size is fixed. With n candidates and q queries each candidate is sent once per query
block that can still use it.

Scores are exact: vectors hold whole numbers, and products are summed in doubles only where no
partial sum can leave 2^53, else in Python integers, clipped to a long. Bounds carry a margin for
rounding, so nothing that ties is pruned.

Results in odd cases: vectors that are null or hold null or non-finite components take no part;
vectors of other lengths are filled with zeros to the longest; an empty vector is all zeros;
equal scores go to the smaller id; repeated ids each take part, but a query never meets a row
of its own id; fewer than k candidates give fewer rows; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, map_arrow, read

#: Rows of a candidate and of a query block; of the seed; candidates that are pruned at once.
CANDIDATES, QUERIES, SEED, STRIP = 8192, 1024, 2048, 1024
EXACT = float(2**53)
_VECTOR = "id long, x array<double>, size double"


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, x, size): components floor(scale * x) as doubles, and the vector's length."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lists = batch.column(0), batch.column(1)
        keep, rows, sizes = [], [], []
        for k, (i, v) in enumerate(zip(ids, lists, strict=True)):
            if not i.is_valid or not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if len(v.values) else np.zeros(0)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(x * scale), -1e150, 1e150)
            keep.append(k)
            rows.append(x)
            sizes.append(float(np.linalg.norm(x)))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
        values = pa.array(np.concatenate(rows) if rows else np.zeros(0))
        return pa.RecordBatch.from_arrays([ids.take(pa.array(keep, pa.int64())), pa.ListArray.from_arrays(bounds, values), pa.array(sizes, pa.float64())], names=["id", "x", "size"])

    return map_arrow(vectors.select(F.col(key).cast("long").alias("id"), F.col(vector)), each, _VECTOR)


def matrix(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The lists as rows, filled with zeros up to ``width``."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    counts = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.repeat(np.arange(len(lists)), counts), np.concatenate([np.arange(c) for c in counts] or [np.zeros(0, int)]).astype(int)] = lists.flatten().to_numpy()
    return out


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns by falling share of the vectors' mass; d x d numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column(0), width)
            x /= max(1.0, np.abs(x).max(initial=0.0) / 1e70)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["place", "v"])

    sums = vectors.select("x").mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).toPandas().sort_values("place")
    moments = sums["v"].to_numpy().reshape(width, width) if len(sums) else np.zeros((width, width))
    u, _, _ = np.linalg.svd(moments / max(1.0, np.abs(moments).max(initial=0.0)))
    return u


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows, as Python integers would give them."""
    with np.errstate(over="ignore"):
        safe = float(np.linalg.norm(q, axis=1).max(initial=0.0)) * float(np.linalg.norm(c, axis=1).max(initial=0.0)) < EXACT / 2
    if safe:
        return (q @ c.T).astype(np.int64)
    big_q, big_c = ([[int(v) for v in row] for row in m] for m in (q, c))
    clip = lambda v: max(-(2**63), min(2**63 - 1, v))
    return np.array([[clip(sum(a * b for a, b in zip(x, y, strict=True))) for y in big_c] for x in big_q], np.int64).reshape(len(q), len(c))


class Block:
    """Vectors with their rotated coordinates and the lengths of what follows each cut."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray):
        self.ids, self.x = ids, x
        self.turned = x @ axes
        d = x.shape[1]
        self.cuts = sorted({min(d, max(1, d // 8)), min(d, max(1, d // 2))})
        self.size = np.linalg.norm(x, axis=1)
        self.rest = [np.linalg.norm(self.turned[:, m:], axis=1) for m in self.cuts]


def search(queries: Block, candidates: Block, k: int, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, ids, scores): its at most ``k`` best candidates with a score of ``least`` or
    more. ``least``: a score that k other candidates are known to reach, else -inf."""
    least = least.copy()
    order = np.lexsort((candidates.ids, -candidates.size))
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at in range(0, len(order), STRIP):
        strip = order[at : at + STRIP]
        margin = 1e-9 * queries.size * candidates.size[strip[0]] + 1.0
        active = np.flatnonzero(queries.size * candidates.size[strip[0]] + margin >= least)
        if not len(active):
            break  # all that follow are shorter
        mask = np.ones((len(active), len(strip)), bool)
        for m, rest_q, rest_c in zip(queries.cuts, queries.rest, candidates.rest, strict=True):
            bound = queries.turned[active, :m] @ candidates.turned[strip, :m].T + np.outer(rest_q[active], rest_c[strip])
            mask &= bound + margin[active, None] >= least[active, None]
        columns = np.flatnonzero(mask.any(axis=0))
        if not len(columns):
            continue
        rows = np.flatnonzero(mask.any(axis=1))
        ids = candidates.ids[strip[columns]]
        scores = exact_scores(queries.x[active[rows]], candidates.x[strip[columns]])
        for r, q in enumerate(active[rows]):
            ok = mask[rows[r], columns] & (ids != queries.ids[q]) & (scores[r] >= least[q])
            if not ok.any():
                continue
            all_ids, all_scores = ids[ok], scores[r][ok]
            if q in best:
                all_ids, all_scores = np.concatenate([best[q][0], all_ids]), np.concatenate([best[q][1], all_scores])
            top = np.lexsort((all_ids, -all_scores.astype(object) if all_scores.min() == -(2**63) else -all_scores))[:k]
            best[q] = all_ids[top], all_scores[top]
            if len(top) == k:
                least[q] = max(least[q], float(all_scores[top[-1]]))
    for q, (ids, scores) in best.items():
        yield q, ids, scores


def blocks(parts: list, size: int) -> tuple[dict[int, int], list[float]]:
    """From (partition, its first value, rows) the block of each partition, neighbours together up to
    about ``size`` rows, and each block's first value."""
    number: dict[int, int] = {}
    firsts: list[float] = []
    filled = size
    for part, value, rows in sorted(parts):
        if filled >= size:
            firsts.append(value)
            filled = 0
        number[part] = len(firsts) - 1
        filled += rows
    return number, firsts


def top_k(vectors: DataFrame, key: str, vector: str, k: int, is_query: F.Column, scale: int = 1024) -> DataFrame:
    """(query_id, rank, id, score) for the rows of ``vectors`` where ``is_query`` (of column ``id``)."""
    spark = vectors.sparkSession
    held = cut(whole_vectors(vectors, key, vector, scale))
    total, width = held.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = max(1, width or 0)
    count = held.where(is_query).count()
    axes = principal_axes(held, width)
    seed = held.orderBy(F.col("size").desc(), "id").limit(SEED).toArrow()
    seeds = spark.sparkContext.broadcast((seed.column("id").to_numpy(), matrix(seed.column("x"), width), axes))

    def thresholds(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, x, turn = seeds.value
        q = Block(batch.column(0).to_numpy(), matrix(batch.column(1), width), turn)
        least = np.full(len(q.ids), -np.inf)
        for row, _, scores in search(q, Block(ids, x, turn), k, least):
            if len(scores) == k:
                least[row] = float(scores[-1])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=["id", "x", "size", "least"])

    n_query, n_candidate = max(1, math.ceil(count / QUERIES)), max(1, math.ceil(total / CANDIDATES))
    reach = F.when(F.col("size") > 0, F.col("least") / F.col("size")).otherwise(F.when(F.col("least") > 0, F.lit(math.inf)).otherwise(F.lit(-math.inf)))
    queries = map_arrow(held.where(is_query), thresholds, f"{_VECTOR}, least double").withColumn("reach", reach)
    queries = cut(queries.repartitionByRange(n_query, "reach", "id").withColumn("qb", F.spark_partition_id()))
    candidates = cut(held.repartitionByRange(n_candidate, F.col("size").desc(), "id").withColumn("cb", F.spark_partition_id()))
    # Blocks of both sides by number: candidates' lengths fall, queries' reaches rise. A pair meets
    # if the longest candidate is as long as the smallest reach, with a margin for rounding.
    to_c, longest = blocks(candidates.groupBy("cb").agg(F.max("size"), F.count(F.lit(1))).collect(), CANDIDATES)
    to_q, reaches = blocks(queries.groupBy("qb").agg(F.min("reach"), F.count(F.lit(1))).collect(), QUERIES)
    meets = lambda size, least: size * (1 + 1e-6) + 1e-3 >= least
    last_q = [max([j for j, least in enumerate(reaches) if meets(s, least)], default=-1) for s in longest]
    last_c = [max([j for j, s in enumerate(longest) if meets(s, least)], default=-1) for least in reaches]
    of_q = spark.createDataFrame([(part, j, last_c[j]) for part, j in to_q.items()], "qb int, q int, last int")
    of_c = spark.createDataFrame([(part, j, last_q[j]) for part, j in to_c.items()], "cb int, c int, last int")
    left = queries.join(of_q, "qb").where("last >= 0").select("q", F.explode(F.sequence(F.lit(0), "last")).alias("c"), "id", "x", "least")
    right = candidates.join(of_c, "cb").where("last >= 0").select(F.explode(F.sequence(F.lit(0), "last")).alias("q"), "c", "id", "x")

    def pair(q: pa.Table, c: pa.Table) -> pa.Table:
        out = {"query_id": [], "id": [], "score": []}
        if q.num_rows and c.num_rows:
            turn = seeds.value[2]
            asked = Block(q.column("id").to_numpy(), matrix(q.column("x"), width), turn)
            for row, ids, scores in search(asked, Block(c.column("id").to_numpy(), matrix(c.column("x"), width), turn), k, q.column("least").to_numpy()):
                out["query_id"] += [int(asked.ids[row])] * len(ids)
                out["id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(pair, "query_id long, id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 best of every hundredth vector of ``embeddings``."""
    found = top_k(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 10, F.col("id") % 100 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP6_SQL = """
WITH ok AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM ok),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
  GROUP BY ALL
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
