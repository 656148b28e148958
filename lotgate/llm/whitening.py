"""Embedding whitening by a bidiagonal qd solver.

Entries are put on an integer grid, so sums are exact and a vector centred by
``(n * x - S) / n`` loses nothing to its mean.

Method
------
1. The *fit list* is each distinct grid vector once (an aggregate that folds
   copies before the shuffle, so a very common vector is one row).
2. *Blockwise QR.* A task folds its centred rows, a block at a time, into one
   upper triangle; triangles are folded in groups of ``FAN`` until one is left.
   A triangle has the size of width x width, whatever the number of rows.
3. On the driver: Householder bidiagonalisation of that triangle, dqds for its
   singular values, twisted factorisations for the directions
   (:mod:`bidiagonal`). ``eigenvalue = singular value ** 2 / n``.
4. Every row is projected by a task that holds the means and directions.

No covariance matrix is formed on the way to the directions. The covariance of
the whitened fit list is then measured, as a check on the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bidiagonal import leading_directions
from .blocks import column
from .tables import keep

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
FAN = 16
BLOCK_ROWS = 4096
#: Grid values end here on either side, so that sums of them stay exact.
EDGE = 1 << 40


def grid(values: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    return np.clip(np.floor(values * scale), -EDGE, EDGE).astype(np.int64) + offset


def _packed(width: int, scale: int, offset: int):
    """(vec_id, x): the grid vector as bytes, in 32-bit numbers where they do."""
    def run(batches):
        for batch in batches:
            values = column(batch, "embedding")
            out = []
            for start in range(0, len(values), BLOCK_ROWS):
                part = values.slice(start, BLOCK_ROWS)
                flat = part.flatten().to_numpy(zero_copy_only=False)
                sizes = np.fromiter(map(len, part), np.int64, len(part)) if len(flat) != width * len(part) else None
                x = np.zeros((len(part), width))
                if sizes is None:
                    x[:] = flat.reshape(-1, width)
                else:
                    row = np.repeat(np.arange(len(part)), sizes)
                    x[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
                x = grid(x, scale, offset)
                small = np.abs(x).max(1, initial=0) < 1 << 31
                out += [r.astype("<i4").tobytes() if s else r.tobytes() for r, s in zip(x, small.tolist())]
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), pa.array(out, pa.binary())], ["vec_id", "x"])
    return run


def _unpacked(values: pa.Array, width: int) -> np.ndarray:
    data = values.to_pylist()
    small = np.fromiter((len(v) == 4 * width for v in data), bool, len(data))
    x = np.empty((len(data), width), np.int64)
    x[small] = np.frombuffer(b"".join(v for v, s in zip(data, small) if s), "<i4").reshape(-1, width)
    x[~small] = np.frombuffer(b"".join(v for v, s in zip(data, small) if not s), "<i8").reshape(-1, width)
    return x


def _blocks(batches, width: int):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            yield part, _unpacked(column(part, "x"), width)


def _sums(width: int):
    """(dimension, sum) of a task's rows, and its number of rows as -1."""
    def run(batches):
        n, total = 0, [0] * width
        for _, x in _blocks(batches, width):
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(0))]  # 4096 rows of 2^40 fit a long
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(width)], pa.int32()), pa.array([Decimal(t) for t in [n, *total]], pa.decimal128(38, 0))],
                                         ["dimension", "total"])
    return run


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: longs, or Python integers where those overflow."""
    most = max([abs(s) for s in sums] + [n * int(np.abs(x).max(initial=0))]) if len(x) else 0
    if most < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(float)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Sum of squares of the numerators, exact."""
    y = _numerators(x, n, sums)
    if y.dtype == np.int64 and np.abs(y).max(initial=0) < (1 << 31) and y.shape[1] * float(np.abs(y).max(initial=0)) ** 2 < 1 << 62:
        return [Decimal(v) for v in (y * y).sum(1).tolist()]
    return [Decimal(sum(v * v for v in row)) for row in y.tolist()]


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR factorisation, with as many rows as columns."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def _folded(n: int, sums: list[int]):
    """(bin, r): the triangle of a task's centred rows."""
    def run(batches):
        r = np.zeros((0, len(sums)))
        for _, x in _blocks(batches, len(sums)):
            r = np.linalg.qr(np.vstack([r, _centred(x, n, sums)]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([_triangle(r).tobytes()], pa.binary())], ["bin", "r"])
    return run


def _merged(width: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            for data in column(batch, "r").to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(data).reshape(-1, width)]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([_triangle(r).tobytes()], pa.binary())], ["bin", "r"])
    return run


def _triangle_of(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    width = len(sums)
    level, _ = keep(fit.mapInArrow(_folded(n, sums), "bin long, r binary"), "whitening_r")
    bins = level.agg(F.max("bin")).first()[0] + 1
    while bins > 1:
        level = level.withColumn("bin", F.floor(F.col("bin") / FAN)).groupBy("bin").applyInArrow(_merged(width), "bin long, r binary")
        bins = -(-bins // FAN)
    return np.frombuffer(level.first()["r"]).reshape(width, width)


def _products(n: int, sums: list[int], directions: np.ndarray, roots: np.ndarray):
    """(i, j, product) summed over a task's whitened rows."""
    def run(batches):
        k = len(roots)
        total = np.zeros((k, k))
        for _, x in _blocks(batches, len(sums)):
            y = _centred(x, n, sums) @ directions / roots
            total += y.T @ y
        i, j = np.indices((k, k)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "product"])
    return run


def _projected(n: int, sums: list[int], directions: np.ndarray, roots: np.ndarray, explained: np.ndarray, error: float):
    def run(batches):
        k = len(roots)
        for part, x in _blocks(batches, len(sums)):
            y = _centred(x, n, sums) @ directions / roots
            deviation = pa.array(_deviations(x, n, sums), pa.decimal128(38, 0))
            row = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                column(part, "vec_id").take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)),
                deviation.take(row), pa.array(y.reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    for each row of *vectors* (vec_id, embedding) and each component.

    ``deviation`` is a decimal of 38 digits. Rows whose embedding is null or holds
    null or non-finite entries are left out. Vectors shorter than the longest
    are filled up with zeros. Repeated rows, and rows with equal or null vec_id,
    come back each, but fit once. Grid values are clipped at 2^40 on either side.
    Components whose eigenvalue is zero to working precision do not exist: a
    single vector, or copies of one, or empty vectors, give no rows, nor does an
    empty table.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], schema)
    packed = rows.mapInArrow(_packed(width, scale, offset), "vec_id long, x binary")
    fit, _ = keep(packed.select("x").distinct(), "whitening_fit")
    found = {r["dimension"]: int(r["total"]) for r in
             fit.mapInArrow(_sums(width), "dimension int, total decimal(38,0)").groupBy("dimension").agg(F.sum("total").alias("total")).collect()}
    n, sums = found[-1], [found[i] for i in range(width)]
    triangle = _triangle_of(fit, n, sums)
    squares, directions = leading_directions(triangle, components)
    if not len(squares):
        return spark.createDataFrame([], schema)
    roots = np.sqrt(squares / n)
    # The rows' mean is zero exactly, so products need no further centring.
    products = fit.mapInArrow(_products(n, sums, directions, roots), "i int, j int, product double").groupBy("i", "j").agg(F.sum("product").alias("s")).collect()
    error = max(abs(r["s"] / n - (r["i"] == r["j"])) for r in products)
    explained = squares / (triangle * triangle).sum()
    return packed.mapInArrow(_projected(n, sums, directions, roots, explained, error), schema)
