"""Embedding whitening (13): an exact scatter matrix from bit planes, eigenvectors of integers, projected rows.

Entries become whole numbers. Each dimension is shifted by its least value, and the bits of the shifted numbers are
packed across rows: one plane for each dimension and bit, one word for 64 rows. The cross-product of two dimensions
is the sum over their planes of popcount(plane AND plane), weighted by the planes' powers of two: exact at any size,
in any order of rows. Tasks send one matrix each; the driver gets the summed one (a number for each pair of
dimensions), centres it as integers, n * sum(xy) - sum(x) * sum(y), and only then goes over to floating point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmood.llm.base import query, stored, table

#: Rows whose planes are held at once: 512 words for each dimension and bit.
BLOCK_ROWS = 32_768
SCALE = 1024.0
SHIFT = 100_000
COMPONENTS = 8
#: Scatter entries travel as high * 2^32 + low, so that sums of longs stay exact.
LOW_BITS = 32


def _entries(vectors: pa.Array, scale: float, shift: int, width: int | None = None) -> np.ndarray:
    """Rows of floor(scale * entry) + shift; shorter rows are filled up with entries of 0."""
    lists = vectors.to_pylist()
    width = max(map(len, lists), default=0) if width is None else width
    out = np.zeros((len(lists), width))
    for i, row in enumerate(lists):
        out[i, : len(row)] = row
    # beyond 61 bits an entry is the nearest number that has 61
    return np.clip(np.floor(scale * out), -(2.0**61), 2.0**61).astype(np.int64) + shift


def _bounds(batches: Iterator[pa.RecordBatch], scale: float, shift: int) -> Iterator[pa.RecordBatch]:
    low: np.ndarray = np.zeros(0, np.int64)
    high, rows, shortest = low, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = [len(v) for v in batch.column("vector")]
        x = _entries(batch.column("vector"), scale, shift)
        width = max(len(low), x.shape[1])
        parts = [(x.min(axis=0), x.max(axis=0))] + ([(low, high)] if rows else [])
        padded = [[np.pad(p, (0, width - len(p)), constant_values=shift) for p in pair] for pair in parts]
        low, high = np.min([p[0] for p in padded], axis=0), np.max([p[1] for p in padded], axis=0)
        rows += len(x)
        shortest = min(lengths) if shortest is None else min(shortest, min(lengths))
    if rows:
        yield pa.RecordBatch.from_pydict(
            {"rows": [rows], "shortest": [shortest], "low": [low.tolist()], "high": [high.tolist()]},
            pa.schema([("rows", pa.int64()), ("shortest", pa.int64()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))]),
        )


def bit_planes(x: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """Words of 64 rows: plane [dimension * bits + bit] of the numbers less their dimension's least one."""
    shifted = (x - low).astype(np.uint64)
    padded = np.zeros((-(-len(x) // 64) * 64, x.shape[1]), np.uint64)
    padded[: len(x)] = shifted
    planes = [np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8), axis=0) for b in range(bits)]
    # (bit, byte of rows, dimension) to (dimension, bit, byte of rows)
    return np.ascontiguousarray(np.transpose(planes, (2, 0, 1))).reshape(x.shape[1] * bits, -1).view(np.uint64)


def scatter(planes: np.ndarray, dims: int, bits: int, counts: np.ndarray) -> None:
    """Add the common set bits of all pairs of planes to ``counts`` [dimension, dimension, sum of the two bits]."""
    for p in range(len(planes)):
        dim, bit = divmod(p, bits)
        common = np.bitwise_count(planes[p] & planes[dim * bits :]).sum(axis=1, dtype=np.int64)
        counts[dim, dim:, bit : bit + bits] += common.reshape(dims - dim, bits)


def _scatter(batches, scale: float, shift: int, low: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    dims = len(low)
    counts = np.zeros((dims, dims, 2 * bits), np.int64)
    sums = np.zeros((dims, bits), np.int64)
    held: list[np.ndarray] = []

    def add() -> None:
        planes = bit_planes(np.concatenate(held), low, bits)
        scatter(planes, dims, bits, counts)
        sums[:] += np.bitwise_count(planes).sum(axis=1, dtype=np.int64).reshape(dims, bits)
        held.clear()

    rows = 0
    for batch in batches:
        held.append(_entries(batch.column("vector"), scale, shift, dims))
        rows += batch.num_rows
        if sum(map(len, held)) >= BLOCK_ROWS:
            add()
    if held:
        add()
    if not rows:
        return
    out = [(i, j, _weighed(counts[i, j])) for i in range(dims) for j in range(i, dims)]
    out += [(i, -1, _weighed(sums[i])) for i in range(dims)]
    i, j, value = zip(*out)
    columns = [i, j, [v >> LOW_BITS for v in value], [v & (1 << LOW_BITS) - 1 for v in value]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["i", "j", "high", "low"])


def _weighed(counts: np.ndarray) -> int:
    return sum(c << s for s, c in enumerate(counts.tolist()))


@dataclass
class Whitening:
    """What whitens a row: integer sums of the fit list, and unit eigenvectors of its covariance by falling value."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        # n * x - S is whole: centred without rounding where it fits 63 bits
        sums = np.array(self.sums, object)
        fits = int(self.rows) * int(np.abs(x).max(initial=0)) < 2**62 and max(map(abs, self.sums), default=0) < 2**62
        if fits:
            centred = (x * self.rows - sums.astype(np.int64)) / float(self.rows)
        else:
            centred = ((x.astype(object) * self.rows - sums) / self.rows).astype(np.float64)
        return centred @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, as n^2 * sum(x^2) - 2 * n * sum(x * S) + sum(S^2) in whole numbers."""
        n, square = self.rows, sum(s * s for s in self.sums)
        top = max([1, *map(abs, self.sums)])
        kind = np.int64 if int(np.abs(x).max(initial=1)) * top * x.shape[1] < 2**62 else object
        wide, own = x.astype(kind), np.array(self.sums, kind)
        squares = (wide if int(np.abs(x).max(initial=1)) ** 2 * x.shape[1] < 2**62 else wide.astype(object)) ** 2
        return [
            n * n * int(a) - 2 * n * int(b) + square for a, b in zip(squares.sum(axis=1), (wide * own).sum(axis=1))
        ]


def fit_whitening(vectors: DataFrame, scale: float = SCALE, shift: int = SHIFT, components: int = COMPONENTS) -> Whitening | None:
    """The fit over all rows of the column ``vector``; None where there are no rows."""
    bounds = vectors.mapInArrow(
        lambda b: _bounds(b, scale, shift), "rows bigint, shortest bigint, low array<bigint>, high array<bigint>"
    )
    # a handful of numbers for each dimension
    per_dim = (
        bounds.select(F.posexplode(F.arrays_zip("low", "high")))
        .groupBy("pos").agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"))
    ).collect()
    totals = bounds.agg(F.sum("rows").alias("rows"), F.min("shortest").alias("shortest")).first()
    if not totals.rows or not per_dim:
        return None
    dims = len(per_dim)
    low, high = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for r in per_dim:
        # rows that end before a dimension have an entry of 0 there, whichever task they are in
        low[r.pos] = r.low if totals.shortest > r.pos else min(r.low, shift)
        high[r.pos] = r.high if totals.shortest > r.pos else max(r.high, shift)
    bits = max(1, *((int(h) - int(l)).bit_length() for l, h in zip(low, high)))
    parts = vectors.mapInArrow(lambda b: _scatter(b, scale, shift, low, bits), "i bigint, j bigint, high bigint, low bigint")
    # one row for each pair of dimensions
    summed = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    value = {(r.i, r.j): (r.high << LOW_BITS) + r.low for r in summed}
    n = totals.rows
    own = [value[i, -1] for i in range(dims)]
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            # shifting a dimension leaves n * sum(xy) - sum(x) * sum(y) as it is; the quotient is rounded once
            covariance[i, j] = covariance[j, i] = (n * value[i, j] - own[i] * own[j]) / (n * n)
    values, unit = np.linalg.eigh(covariance)
    values, unit = values[::-1], unit[:, ::-1]
    # what rounding alone leaves of a direction without spread is no component
    real = int((values > max(values[0], 0) * dims * np.finfo(float).eps * 4).sum())
    kept = min(components, real)
    sums = [s + n * int(l) for s, l in zip(own, low)]
    return Whitening(n, sums, values[:kept].copy(), unit[:, :kept].copy(), float(np.trace(covariance)))


def _whiten(batches, shared, scale: float, shift: int) -> Iterator[pa.RecordBatch]:
    fit: Whitening = shared.value
    for batch in batches:
        x = _entries(batch.column("vector"), scale, shift, len(fit.sums))
        white = np.ascontiguousarray(fit.whiten(x))
        offsets = pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([Decimal(d) if d < 10**38 else None for d in fit.deviation(x)], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(offsets, pa.array(white.ravel(), pa.float64())),
            ],
            names=["id", "deviation", "whitened"],
        )


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: float = SCALE,
    shift: int = SHIFT,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Columns (id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Entries become x = floor(scale * entry) + shift; mean and covariance (divisor n) of x are those of all rows that
    remain, centred exactly. ``whitened`` is x - mean on the component, over the root of its eigenvalue; ``explained``
    its share of the trace; ``deviation`` the exact sum over dimensions of (n * x - sum(x))^2, a decimal, null from
    10^38 on; ``identity_error`` the largest absolute entry of the whitened rows' own covariance minus the identity.

    Rows with a null vector or a null or non-finite entry are dropped. Repeated rows and ids count and return each
    time, a null id stays null. Shorter vectors count as if filled up with entries of 0; empty vectors alone have no
    dimension. A direction without spread is no component, so equal rows, a single row or no rows give no rows.
    Equal eigenvalues have their eigenvectors in any order. Further columns are not read.
    """
    spark = vectors.sparkSession
    entries = F.col(vector_col)
    sound = entries.isNotNull() & F.forall(entries, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(sound).select(F.col(id_col).alias("id"), entries.alias("vector"))
    id_field = T.StructField("id", rows.schema["id"].dataType)
    schema = T.StructType(
        [id_field, *[T.StructField(n, k) for n, k in (("component", T.IntegerType()), ("n", T.LongType()))],
         T.StructField("deviation", T.DecimalType(38, 0)),
         *[T.StructField(n, T.DoubleType()) for n in ("whitened", "explained", "identity_error")]]
    )
    fit = fit_whitening(rows.select("vector"), scale, shift, components)
    if fit is None or not len(fit.values):
        return spark.createDataFrame([], schema)
    # bounded by dimensions times components
    shared = spark.sparkContext.broadcast(fit)
    wide_schema = T.StructType(
        [id_field, T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    )
    wide = stored(rows.mapInArrow(lambda b: _whiten(b, shared, scale, shift), wide_schema), "whitened")
    kept = range(len(fit.values))
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    covariances = wide.agg(
        *[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c_{i}_{j}") for i, j in pairs]
    ).first()
    error = max(abs(covariances[f"c_{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    return wide.select("id", "deviation", F.posexplode("whitened")).select(
        "id", (F.col("pos") + 1).alias("component"), F.lit(fit.rows).cast("long").alias("n"), "deviation",
        F.col("col").alias("whitened"), shares[F.col("pos")].alias("explained"), F.lit(float(error)).alias("identity_error"),
    )


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, directory: str) -> DataFrame:
    white = whiten(table(spark, directory, "embeddings"))
    # a long holds deviations of up to some million rows; beyond that the operator's decimal says more
    deviation = F.col("deviation").try_cast("long")
    return white.withColumnRenamed("id", "vec_id").withColumn("deviation", deviation)
