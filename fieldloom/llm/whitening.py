"""Embedding whitening by FEAST contour integration.

Method: vectors become whole numbers, and each distinct one counts once in the fit. Spark sums
their number, the sums of each dimension and then the covariance, centred before it is multiplied;
a d x d matrix is all that reaches the driver, whatever the number of rows. Its leading
eigenpairs come interval by interval: inertia counts (signs of the pivots of V - s) cut the
spectrum into intervals of a few eigenvalues, a quadrature of complex shifted solves along a circle
around each interval projects a block of vectors onto its eigenspace, Rayleigh-Ritz takes the pairs
out, and the pairs found in an interval must be as many as the inertia counts say, else it is
searched again with a wider block. Rows are then projected where they lie, without a shuffle.

The only shuffle is that of distinct vectors, as bytes of the smallest width that holds them
(mostly one a dimension); copies are merged before it, so a vector of a third of all rows is a few
rows there. The distinct vectors are written once to the shared folder and read three times.

Results in odd cases: vectors that are null or hold null or non-finite entries, or entries beyond
2^46 (whose whole numbers a double no longer tells apart), take no part and give no row; shorter
vectors are filled with zeros to the longest, so an empty one is all zeros; repeated rows each give
a row and count once in the fit; a null id is kept; components whose variance is zero to double
precision (fewer distinct vectors than dimensions, constant entries) are left out, so one vector or
an empty table gives no components; the sum of squared deviations is null where it exceeds a long;
extra columns are not read. Vectors longer than ``MAX_WIDTH`` raise: the covariance would not fit
the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, map_arrow, read, ship

#: Longest vector whose covariance the driver takes (128 MB).
MAX_WIDTH = 4096
#: Entries of this size or more have no exact whole number.
LIMIT = 2.0**52
#: Eigenvalues an interval is cut down to; nodes on the upper half of a circle; rounds for an interval.
IN_INTERVAL, NODES, ROUNDS = 6, 8, 30
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def whole(values: np.ndarray, scale: float) -> np.ndarray | None:
    """floor(scale * values) as long, or None where an entry has none."""
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values.astype(np.float64) * scale)
    return x.astype(np.int64) if (np.abs(x) < LIMIT).all() else None  # NaN compares false


def pack_whole(x: np.ndarray) -> bytes:
    """The numbers without the zeros at the end, in the smallest width that holds them: equal
    vectors, filled with zeros or not, have equal bytes."""
    used = np.flatnonzero(x)
    x = x[: used[-1] + 1] if len(used) else x[:0]
    for kind in _WIDTHS:
        info = np.iinfo(kind)
        if not len(x) or (x.min() >= info.min and x.max() <= info.max):
            break
    return bytes([np.dtype(kind).itemsize]) + x.astype(f"<i{np.dtype(kind).itemsize}").tobytes()


def unpack_whole(packed: pa.Array, width: int) -> np.ndarray:
    """The rows of a binary column as whole numbers, filled with zeros to ``width``."""
    out = np.zeros((len(packed), width), np.int64)
    for k, data in enumerate(packed):
        data = data.as_buffer()
        size = data[0]
        size = size if isinstance(size, int) else size[0]
        x = np.frombuffer(data, f"<i{size}", offset=1) if len(data) > 1 else out[k, :0]
        out[k, : len(x)] = x
    return out


def packed_vectors(vectors: DataFrame, vector: str, scale: float, *keep: str) -> DataFrame:
    """(the columns ``keep``, x): the rows that take part, their numbers packed."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, found = [], []
        for k, v in enumerate(batch.column(len(keep))):
            if not v.is_valid or v.values.null_count:
                continue
            x = whole(v.values.to_numpy(zero_copy_only=False), scale) if len(v.values) else np.zeros(0, np.int64)
            if x is not None:
                rows.append(k)
                found.append(pack_whole(x))
        columns = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(keep))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=[*keep, "x"])

    kinds = [f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(vectors.select(*keep, F.col(vector).alias("x")), each, ", ".join([*kinds, "x binary"]))


def summed(rows: DataFrame, size: int, of: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``of``'s ``size`` doubles, added up in tasks, then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                total += of(batch.column(0).slice(at, 1024))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["place", "v"])

    ship(rows.sparkSession)
    found = rows.select("x").mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[found["place"].to_numpy(np.int64)] = found["v"].to_numpy()
    return out


def counts_and_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sums of their dimensions, as many as the longest has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, width = 0, 0
        high, low = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            packed = batch.column(0)
            longest = max((len(d.as_buffer()) - 1 for d in packed), default=0)
            for at in range(0, len(packed), 1024):
                x = unpack_whole(packed.slice(at, 1024), longest)
                x = x[:, : np.flatnonzero(x.any(axis=0))[-1] + 1] if x.any() else x[:, :0]
                if x.shape[1] > width:
                    width = x.shape[1]
                    high, low = (np.concatenate([s, np.zeros(width - len(s), np.int64)]) for s in (high, low))
                high[: x.shape[1]] += (x >> 26).sum(axis=0)  # halves: neither leaves a long
                low[: x.shape[1]] += (x & (2**26 - 1)).sum(axis=0)
            n += len(packed)
        places = np.concatenate([[-1], np.arange(width)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(np.concatenate([[0], high])), pa.array(np.concatenate([[n], low]))],
            names=["place", "high", "low"],
        )

    ship(rows.sparkSession)
    found = (
        rows.select("x").mapInArrow(run, "place long, high long, low long").groupBy("place")
        .agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")])
        .where(F.col("place") < MAX_WIDTH + 1).collect()
    )
    by_place = {r.place: (int(r.high) << 26) + int(r.low) for r in found}
    if MAX_WIDTH in by_place:
        raise ValueError(f"vectors of more than {MAX_WIDTH} entries")
    return by_place.get(-1, 0), [by_place[k] for k in range(len(by_place) - 1)]


# Eigenpairs


def above(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of the symmetric ``v`` exceed ``s``: by Sylvester's law as many as the
    factors of ``v - s`` have positive pivots (single ones, or pairs of one sign each)."""
    a = v - s * np.eye(len(v))
    found, n = 0, len(a)
    while n:
        diagonal = np.abs(np.diagonal(a))
        r = int(diagonal.argmax())
        off = np.abs(np.tril(a, -1))
        i, j = divmod(int(off.argmax()), n)
        if diagonal[r] >= 0.64 * off[i, j]:
            if a[r, r] == 0:
                return found  # what is left is zero
            found += bool(a[r, r] > 0)
            taken = [r]
        else:
            found += 1
            taken = [i, j]
        rest = np.delete(np.arange(n), taken)
        side = a[np.ix_(rest, taken)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(taken, taken)], side.T)
        a = (a + a.T) / 2
        n = len(a)
    return found


def intervals(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues within) from the top down, ``k`` eigenvalues together at least. An
    interval is halved until few are in it or it is as narrow as rounding allows."""
    top = float(np.abs(v).sum(axis=1).max())
    floor = -1e-3 * top
    out, open_ = [], [(floor, top * (1 + 1e-3), len(v))]
    taken = 0
    while open_ and taken < k:
        low, high, n = open_.pop()
        if n == 0:
            continue
        if n <= IN_INTERVAL or high - low <= 1e-10 * top:
            out.append((low, high, n))
            taken += n
            continue
        middle = (low + high) / 2
        upper = above(v, middle) - (0 if high > top else above(v, high))
        open_ += [(low, middle, n - upper), (middle, high, upper)]
    return out


def contour(v: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """``block`` projected onto the eigenvectors of [low, high]: Gauss-Legendre quadrature of the
    resolvent along a circle; its lower half is the conjugate of the upper."""
    middle, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    for t, w in zip(nodes, weights, strict=True):
        turn = np.exp(1j * np.pi * (t + 1) / 2)
        solved = np.linalg.solve((middle + radius * turn) * np.eye(len(v)) - v, block.astype(complex))
        out += w / 2 * (radius * turn * solved).real
    return out


def rayleigh_ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit vectors of ``v`` within the span of ``block``."""
    q, _ = np.linalg.qr(block)
    small = q.T @ v @ q
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (q @ vectors)[:, ::-1]


def pairs_within(v: np.ndarray, low: float, high: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenpairs of [low, high]."""
    size = float(np.abs(v).sum(axis=1).max())
    draw = np.random.default_rng(11)
    width = min(len(v), 2 * n + 6)
    while True:
        block = draw.standard_normal((len(v), width))
        best = np.inf
        for _ in range(ROUNDS):
            values, vectors = rayleigh_ritz(v, contour(v, low, high, block))
            inside = np.flatnonzero((values > low) & (values <= high))
            wrong = np.linalg.norm(v @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0).max(initial=0.0)
            if len(inside) == n and wrong >= best / 2 and wrong <= 1e-11 * size:
                return values[inside], vectors[:, inside]  # residuals no longer fall
            best = min(best, wrong) if len(inside) == n else np.inf
            block = vectors
        if width == len(v):
            raise ArithmeticError(f"{n} eigenvalues were counted in [{low}, {high}], others found")
        width = min(len(v), 2 * width)


def leading_pairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` and their unit vectors as columns; fewer where the
    rest is zero to double precision. An entry of largest size is positive in each vector."""
    if not len(v) or not np.abs(v).max():
        return np.zeros(0), np.zeros((len(v), 0))
    parts = [pairs_within(v, low, high, n) for low, high, n in intervals(v, k)]
    values, vectors = rayleigh_ritz(v, np.concatenate([x for _, x in parts], axis=1))
    real = values[:k] > len(v) * np.finfo(float).eps * values[0]
    values, vectors = values[:k][real], vectors[:, :k][:, real]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


# Fit and projection


class Whitening(NamedTuple):
    """What a fit has learned; ``base`` and ``rest``: n * base + rest are the sums."""

    scale: float
    n: int
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers less their mean."""
        return (x - self.base) - self.rest / max(self.n, 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sum)^2; None beyond a long."""
        near = x - self.base
        if (self.n * (int(np.abs(near).max(initial=0)) + 1)) ** 2 * max(1, len(self.base)) < 2**63:
            return ((self.n * near - self.rest) ** 2).sum(axis=1).tolist()
        rest = self.rest.tolist()
        sums = [sum((self.n * a - b) ** 2 for a, b in zip(row, rest, strict=True)) for row in near.tolist()]
        return [s if s < 2**63 else None for s in sums]


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 16, scale: float = 64.0) -> Whitening:
    """The leading components of the distinct vectors floor(scale * c); adding one number to all
    entries would change none of this."""
    distinct = cut(packed_vectors(vectors, vector, scale).distinct())
    n, sums = counts_and_sums(distinct)
    d = len(sums)
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    model = Whitening(scale, n, base, rest, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0)

    def products(packed: pa.Array) -> np.ndarray:
        x = model.centred(unpack_whole(packed, d))
        return (x.T @ x).ravel()

    v = summed(distinct, d * d, products).reshape(d, d) / max(n, 1)
    values, axes = leading_pairs((v + v.T) / 2, components)
    model = model._replace(values=values, axes=axes, explained=values / max(float(np.trace(v)), np.finfo(float).tiny))
    k = len(values)

    def moments(packed: pa.Array) -> np.ndarray:
        w = model.project(unpack_whole(packed, d))
        return (w.T @ w).ravel()

    error = np.abs(summed(distinct, k * k, moments).reshape(k, k) / max(n, 1) - np.eye(k)).max(initial=0.0) if k else 0.0
    return model._replace(identity_error=float(error))


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened): each row that takes part, ``whitened`` an entry a component.
    Entries beyond the longest vector of the fit are left out."""
    d = len(model.base)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: list[int | None] = []
        flat = []
        for at in range(0, batch.num_rows, 1024):
            x = unpack_whole(batch.column(1).slice(at, 1024), d)
            sums += model.deviations(x)
            flat.append(model.project(x).ravel())
        bounds = np.arange(batch.num_rows + 1, dtype=np.int32) * len(model.values)
        whitened = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(flat or [np.zeros(0)])))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64()), whitened], names=[key, "deviation", "whitened"])

    kind = vectors.schema[key].dataType.simpleString()
    packed = packed_vectors(vectors, vector, model.scale, key)
    return map_arrow(packed, each, f"`{key}` {kind}, deviation long, whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each row and component, with what was learned about the component beside it."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors)
    each = F.posexplode("whitened").alias("place", "whitened")
    rows = whiten(vectors, model).select("vec_id", "deviation", each)
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", shares[F.col("place")].alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
