"""Embedding whitening by components of the covariance.

Vectors become whole numbers, so counts, sums and deviations are exact. Tasks add up the sums of each
dimension, then the products of the centred vectors; what reaches the driver is one matrix of
dimensions by dimensions, whatever the number of vectors. There the matrix is taken apart by spectral
divide and conquer: the polar factor U of the matrix less a shift, from dynamically weighted Halley
iterations (QDWH), gives the projector (U + I) / 2 onto the eigenvectors above the shift. The two
subspaces it splits are taken apart in turn, until a block has one dimension or is diagonal. The
whitening matrix, of dimensions by components, then travels with the job to all rows.

Rows whose vector is NULL, or holds a NULL, a NaN or an infinite entry, are left out, and so are empty
vectors. The others must agree on a length: the one most vectors have (of two, the longer) counts, and
rows of another length are left out. Entries beyond 2^55 count as 2^55. A vector that occurs in many rows
is fitted once; the rows all get a result, repeated and NULL ids too. Components whose eigenvalue is zero
up to rounding cannot be whitened and are left out; so a single vector, or equal ones, give no rows, and
an empty table gives none. A deviation that does not fit 64 bits is NULL. Components of equal eigenvalue
may be any basis of their space. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import read_table
from salesmart.staging import stage

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LIMIT = float(1 << 55)
LOW = (1 << 31) - 1
#: Vectors that a task turns into a matrix at once.
ROWS = 4096


def whole_vectors(rows: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key`` and ``x``, the entries as whole numbers, of the rows with a usable vector."""
    usable = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(
        column, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LIMIT)), F.lit(LIMIT)))
        .cast("long") + SHIFT)
    return rows.where(F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(usable, F.lit(False))) \
        .select(F.col(key).cast("long").alias(key), scaled.alias("x"))


def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Record batches of ROWS rows at most with their vectors as the rows of a matrix."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, x.reshape(part.num_rows, -1)


@dataclass(frozen=True)
class Centre:
    """The number of fitted vectors and the sum of each dimension, as Python integers."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole parts first, so that no digits are lost to large sums."""
        return (x - np.array([s // self.n for s in self.sums])) - np.array([s % self.n / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n*x - S)^2 for each row."""
        far = x - np.array([s // self.n for s in self.sums])
        rest = [s % self.n for s in self.sums]
        most = (float(np.abs(far).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 2.0**62:
            t = far * self.n - np.array(rest)
            return (t * t).sum(axis=1).tolist()
        exact = [sum((self.n * int(f) - r) ** 2 for f, r in zip(row, rest, strict=True)) for row in far]
        return [e if e < 1 << 63 else None for e in exact]


def centre_of(fit: DataFrame, size: int) -> Centre:
    """Exact sums, in a high and a low half so that none passes 64 bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
        for part, x in matrices(batches):
            high += (x >> 31).sum(axis=0)
            low += (x & LOW).sum(axis=0)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int64()), pa.array(high), pa.array(low), pa.array([n] * size, pa.int64())],
            names=["i", "high", "low", "n"])

    sums = fit.mapInArrow(run, "i long, high long, low long, n long").groupBy("i").agg(
        *[F.sum(c).alias(c) for c in ("high", "low", "n")]).collect()
    whole = {r["i"]: (r["high"] << 31) + r["low"] for r in sums}
    return Centre(max((r["n"] for r in sums), default=0), tuple(whole[i] for i in range(size)))


def mean_product(fit: DataFrame, centre: Centre, project: np.ndarray) -> np.ndarray:
    """The covariance of the centred vectors times ``project``: tasks add up their products, and the
    rows of these matrices are added up by number, so no task holds more than a column of them."""
    size = project.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for _, x in matrices(batches):
            z = centre.centred(x) @ project
            total[:size] += z.T @ z
            total[size] += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size + 1), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["i", "products"])

    def added(group: pa.Table) -> pa.Table:
        rows = group.column("products").combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        return pa.table({"i": pa.array([group.column("i")[0].as_py()], pa.int64()),
                         "products": pa.array([rows.sum(axis=0)], pa.list_(pa.float64()))})

    schema = "i long, products array<double>"
    rows = fit.mapInArrow(run, schema).groupBy("i").applyInArrow(added, schema).collect()
    total = np.array([r["products"] for r in sorted(rows, key=lambda r: r["i"])]) / centre.n
    return total[:size] - np.outer(total[size], total[size])


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    size = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    least, eye = np.finfo(float).eps / 2, np.eye(size)
    for _ in range(30):
        square = least * least
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        weight = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            new = b / c * x + (weight - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        else:
            new = b / c * x + (weight - b / c) * np.linalg.solve(eye + c * x.T @ x, x.T).T
        least = min(1.0, least * (weight + b * square) / (1 + c * square))
        change, x = np.linalg.norm(new - x), (new + new.T) / 2
        if change <= 1e-14 * math.sqrt(size) or (least > 1 - 1e-12 and change < 1e-7):
            break
    return x


def split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if one is empty."""
    size = len(a)
    projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < size:
        return None
    above = np.random.default_rng(size).standard_normal((size, rank))
    for _ in range(3):
        above = np.linalg.qr(projector @ above)[0]
    # The last columns of a full basis span what is orthogonal to the first.
    return above, np.linalg.qr(above, mode="complete")[0][:, rank:]


def components_of(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns."""
    values, vectors = np.zeros(len(a)), np.zeros_like(a)
    tiny = np.finfo(float).eps * max(np.linalg.norm(a), np.finfo(float).tiny)
    open_blocks, done = [((a + a.T) / 2, np.eye(len(a)))], 0
    while open_blocks:
        block, basis = open_blocks.pop()
        diagonal = np.diag(block)
        halves = None
        if len(block) > 1 and np.linalg.norm(block - np.diag(diagonal)) > tiny:
            # The mean of the diagonal has eigenvalues on both sides; the median splits evenly.
            halves = split(block, float(np.median(diagonal)))
            if halves is None:
                halves = split(block, float(diagonal.mean()))
        if halves is None:
            values[done:done + len(block)], vectors[:, done:done + len(block)] = diagonal, basis
            done += len(block)
            continue
        for half in halves:
            inner = half.T @ block @ half
            open_blocks.append(((inner + inner.T) / 2, basis @ half))
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(len(a))] < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: the centre, and a column for each component over sqrt(eigenvalue)."""

    centre: Centre
    matrix: np.ndarray
    explained: np.ndarray
    identity_error: float


def common_length(vectors: DataFrame) -> int:
    """The length of most vectors; 0 without any."""
    most = vectors.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else 0


def fit_whitening(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit to the different vectors ``x``, all of length ``size``; None if they do not vary."""
    fit = stage(vectors.select("x").distinct(), "fit")
    centre = centre_of(fit, size)
    covariance = mean_product(fit, centre, np.eye(size))
    values, unit = components_of(covariance)
    trace = float(np.trace(covariance))
    kept = [k for k in range(min(components, size)) if values[k] > size * np.finfo(float).eps * max(values[0], 0.0)]
    if not kept or trace <= 0:
        return None
    matrix = unit[:, kept] / np.sqrt(values[kept])
    white = mean_product(fit, centre, matrix)
    return Whitening(centre, matrix, values[kept] / trace, float(np.abs(white - np.eye(len(kept))).max()))


WHITENED = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component."""
    vectors = whole_vectors(rows, key, column)
    size = common_length(vectors)
    vectors = vectors.where(F.size("x") == size)
    model = fit_whitening(vectors, size, components) if size else None
    schema = f"`{key}` long, {WHITENED}"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    count = len(model.explained)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches):
            each = part.num_rows
            ids = part.column(0).take(pa.array(np.repeat(np.arange(each), count)))
            deviation = pa.array(model.centre.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), each)),
                 pa.array(np.full(each * count, model.centre.n)),
                 deviation.take(pa.array(np.repeat(np.arange(each), count))),
                 pa.array((model.centre.centred(x) @ model.matrix).ravel()),
                 pa.array(np.tile(model.explained, each)),
                 pa.array(np.full(each * count, model.identity_error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings on their first 16 components."""
    return whiten(read_table(spark, sf_dir, "embeddings"))
