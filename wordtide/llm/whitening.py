"""Whitened components of embeddings: exact moments by Spark, eigenvectors by contour integration.

Vectors are made whole numbers first, so sums and products are added up exactly, in any order and over any number of
tasks. What reaches the driver is one covariance matrix, whose size depends on the dimension only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.feast import greatest_pairs

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Sums are kept as two decimals, high * LIMB + low, so that no number of rows makes them overflow.
LIMB = 10**30
# Entries that would not fit a long after scaling.
TOO_LARGE = 2.0**62
# Eigenvalues under this share of the greatest can't be told from zero in double precision.
NOTHING = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation. ``sums`` are those of floor(64 c), without the shift, which no result depends on."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float


def usable(vector: Column, dimension: int) -> Column:
    """Whether the vector has all its entries, and all are finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < TOO_LARGE))
    return vector.isNotNull() & (F.size(vector) == dimension) & fine


def usable_vectors(df: DataFrame, vector: str, *keep: str) -> tuple[DataFrame, int]:
    """The remaining rows with their vector of doubles as ``_vector``, and the dimension: the longest vector's length."""
    wide = df.select(*keep, F.col(vector).cast("array<double>").alias("_vector"))
    dimension = wide.agg(F.max(F.size("_vector"))).first()[0] or 0
    return wide.where(usable(F.col("_vector"), dimension)), max(dimension, 0)


def whole_numbers(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    """floor(64 c) of a batch, one row per vector."""
    column = batch.column(batch.schema.get_field_index("_vector"))
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values.reshape(batch.num_rows, dimension) * SCALE).astype(np.int64)


def exact(rows: np.ndarray, bound: int) -> np.ndarray:
    """The rows in the fastest type in which whole results below ``bound`` are exact."""
    return rows.astype(np.float64 if bound < 2**53 else np.int64 if bound < 2**62 else object)


def plain(values: np.ndarray) -> np.ndarray:
    """As Python integers, which have no bound."""
    return values.astype(np.int64).astype(object) if values.dtype != object else values


def moments(dimension: int):
    """Per task: the number of rows (at -1, -1), the sums (at -1, j) and the sums of products (at i <= j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole_numbers(batch, dimension)
            largest = int(np.abs(x).max(initial=0))
            n += len(x)
            sums = sums + plain(exact(x, largest * len(x)).sum(axis=0))
            once = exact(x, largest * largest * len(x))
            products = products + plain(once.T @ once)
        if not n:
            return
        i, j = np.triu_indices(dimension)
        number = [n, *sums, *products[i, j]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1] * (dimension + 1) + i.tolist(), pa.int32()),
                pa.array([-1, *range(dimension), *j.tolist()], pa.int32()),
                pa.array([Decimal(int(v) // LIMB) for v in number], pa.decimal128(38, 0)),
                pa.array([Decimal(int(v) % LIMB) for v in number], pa.decimal128(38, 0)),
            ],
            ["i", "j", "high", "low"],
        )

    return run


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Components of the vectors' covariance (divisor n), by falling eigenvalue."""
    vectors, d = usable_vectors(df, vector)
    parts = vectors.mapInArrow(moments(d), "i INT, j INT, high DECIMAL(38,0), low DECIMAL(38,0)")
    total = {(r.i, r.j): int(r.high) * LIMB + int(r.low) for r in parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n = total.get((-1, -1), 0)
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((d, 0)), 0.0)
    sums = [total[-1, j] for j in range(d)]
    covariance = np.zeros((d, d))
    trace = 0
    for i in range(d):
        for j in range(i, d):
            # The centred sum of products times n, a whole number; the one division is correctly rounded.
            centred = n * total[i, j] - sums[i] * sums[j]
            covariance[i, j] = covariance[j, i] = centred / n**2
            trace += centred if i == j else 0
    values, vectors_ = greatest_pairs(covariance, min(components, d))
    real = values > NOTHING * values[0] if len(values) else np.zeros(0, bool)
    return Whitening(n, tuple(sums), values[real], vectors_[:, real], trace / n**2)


def deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S of every entry, whole."""
    largest = model.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in model.sums), default=0)
    wide = x if largest < 2**62 else x.astype(object)
    return model.n * wide - np.array(model.sums, wide.dtype)


def projected(off: np.ndarray, model: Whitening) -> np.ndarray:
    return (off / model.n).astype(np.float64) @ (model.components / np.sqrt(model.values))


def spread(model: Whitening, dimension: int):
    """Per task: sums of the whitened values (at -1, j) and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        sums, products, any_ = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            if batch.num_rows:
                w = projected(deviations(whole_numbers(batch, dimension), model), model)
                sums, products, any_ = sums + w.sum(axis=0), products + w.T @ w, True
        if any_:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1] * k + i.tolist(), pa.int32()), pa.array([*range(k), *j.tolist()], pa.int32()), pa.array([*sums, *products[i, j]], pa.float64())], ["i", "j", "s"]
            )

    return run


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; 0 without components."""
    if not len(model.values):
        return 0.0
    vectors, d = usable_vectors(df, vector)
    parts = vectors.mapInArrow(spread(model, d), "i INT, j INT, s DOUBLE").groupBy("i", "j").agg(F.sum("s").alias("s"))
    s = {(r.i, r.j): r.s / model.n for r in parts.collect()}
    # Whitened values are centred already; what rounding leaves of their means is taken off.
    return max(abs(v - s[-1, i] * s[-1, j] - (i == j)) for (i, j), v in s.items() if i >= 0)


def whitened_rows(model: Whitening, dimension: int, key_type: pa.DataType | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            off = deviations(whole_numbers(batch, dimension), model)
            largest = int(np.abs(off).max(initial=0))
            exact_off = off.astype(object) if largest * largest * dimension >= 2**63 else off
            total = (exact_off * exact_off).sum(axis=1)
            total = pa.array([int(t) if t < 2**63 else None for t in total.tolist()], pa.int64())
            row = pa.array(np.repeat(np.arange(batch.num_rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pc.take(total, row),
                    pa.array(projected(off, model).ravel()),
                    pa.array(np.tile(model.values / model.trace, batch.num_rows)),
                ],
                ["vec_id", "component", "deviation", "whitened", "explained"],
            )

    return run


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained of each remaining row and component."""
    vectors, d = usable_vectors(df, vector, key)
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.withColumnRenamed(key, "vec_id").mapInArrow(whitened_rows(model, d), f"vec_id {kind}, component INT, deviation BIGINT, whitened DOUBLE, explained DOUBLE")
    return rows.select("vec_id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", "explained")


def whiten_embeddings(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit, whiten and check: the rows of ``whiten`` with the fit's ``identity_error``.

    Every entry c becomes x = floor(64 c) + 1,000,000. Rows whose vector is NULL or holds a NULL or non-finite entry
    go, and so do vectors shorter than the longest one, whose last entries are missing, and entries beyond 2**62 / 64,
    which fit no long. NULL and repeated ids are kept as they are, equal vectors count each, and other columns are not
    read. An empty table, a single vector and equal vectors have no components and give no rows; nor have directions
    with less than 10**-12 of the greatest eigenvalue, which double precision can't tell from none. A deviation that
    fits no long is NULL.
    """
    model = fit_whitening(df, vector, components)
    return whiten(df, model, key, vector).withColumn("identity_error", F.lit(identity_error(df, model, vector)))
