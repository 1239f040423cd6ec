"""Embedding whitening from exact integer moments by a bit-sliced scatter.

Every entry c becomes the integer x = floor(64 c) + ``SHIFT``.  Rows are taken ``ROWS`` at a time: each dimension is shifted by its least value there, and bit k
of that dimension's numbers is packed across the rows into 64-bit words, its bit plane.  The number of rows with bit a of dimension i and
bit b of dimension j is the popcount of the two planes' AND; weighted by 2^(a+b) these counts add up to the exact cross-products.  Tasks
report sums and cross-products of x - SHIFT, which Spark adds up exactly; on the driver (a number for each pair of dimensions) they are
centred as integers, n * M - S S', and only then divided by n^2 and decomposed.

Components are unit eigenvectors of the covariance by falling eigenvalue; the largest entry of each is positive.  Whitened values are (x - S / n) projected on
a component over the root of its eigenvalue.  The identity error is measured on the whitened values of all rows in a pass of its own.

Defined results: rows whose vector is null, or holds a null or an entry that is not finite or whose 64 c no long holds, are dropped, as are vectors shorter than the
longest one (their missing entries count as nulls).  Null ids and repeated rows are rows like others.  Components whose eigenvalue is zero to double
precision (constant or dependent dimensions, one row only) can't be whitened and have no rows; so a table without usable
vectors gives none.  ``deviation`` is null if no long holds it; ``deviation_exact`` (38 digits) is there for these.
"""

from __future__ import annotations

import dataclasses
import decimal
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHIFT, SCALE, MOST_COMPONENTS = 1_000_000, 64, 32
#: Rows whose planes are packed together.
ROWS = 8192
#: 64 c has to be below 2 ** LONG_BITS in size.
LONG_BITS = 62
#: Sums travel as (high, low) with high * LIMB + low, so that decimals of 38 digits add them up exactly.
LIMB = 10**18
_EXACT = decimal.Context(prec=60)


@dataclasses.dataclass
class Whitening:
    """n, sums of x - SHIFT, the eigenvalues above zero by size, their unit vectors as columns, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def _usable(vector: Column) -> Column:
    large = float(1 << LONG_BITS) / SCALE
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce((F.abs(c.cast("double")) < large) & ~F.isnan(c.cast("double")), F.lit(False)))


def usable(rows: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that can be taken, all of one length."""
    v = F.col(f"`{vector}`")
    kept = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.cast("array<double>").alias("v")).where(_usable(F.col("v")))
    longest = kept.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    return kept.where(F.size("v") == longest)


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    """floor(64 c) of each entry."""
    column = batch.column("v")
    d = len(column[0]) if batch.num_rows else 0
    c = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * c).astype(np.int64).reshape(batch.num_rows, d)


# the scatter


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, width): the bit planes of the columns of y (uint64), lowest bit first, packed across rows, and the number of planes of each column."""
    top = y.max(axis=0)
    width = np.array([int(t).bit_length() for t in top.tolist()], np.int64)
    rows = -len(y) % 64
    out = np.zeros((int(width.sum()), (len(y) + rows) // 64), np.uint64)
    at = 0
    for j, w in enumerate(width.tolist()):
        column = y[:, j]
        bits = (column >> np.arange(w, dtype=np.uint64)[:, None]).astype(np.uint8) & 1
        packed = np.packbits(np.pad(bits, ((0, 0), (0, rows))), axis=1, bitorder="little")
        out[at : at + w] = packed.view(np.uint64)
        at += w
    return out, width


def cross_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of the columns of y (uint64), as exact Python integers."""
    words, width = planes(y)
    d = y.shape[1]
    start = np.cumsum(width) - width
    bit = np.concatenate([np.zeros(0, np.int64), *(np.arange(w) for w in width)])
    narrow = 2 * int(width.max(initial=0)) + len(y).bit_length() < 62
    weight = (1 << bit) if narrow else np.array([1 << int(b) for b in bit], object)
    own = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    column = np.repeat(np.arange(d), width)
    kind = np.int64 if narrow else object
    products, sums = np.zeros((d, d), kind), np.zeros(d, kind)
    np.add.at(sums, column, own * weight)
    for i in range(d):
        row = np.zeros(d - i, kind)
        for a in range(int(start[i]), int(start[i] + width[i])):
            both = np.bitwise_count(words[a] & words[start[i] :]).sum(axis=1, dtype=np.int64)
            np.add.at(row, column[start[i] :] - i, both * weight[start[i] :] * weight[a])
        products[i, i:] = products[i:, i] = row
    return sums.astype(object), products.astype(object)


def _block(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of the columns of z (signed), as exact Python integers."""
    base = z.min(axis=0)
    s, p = cross_products(z.astype(np.uint64) - base.astype(np.uint64))  # modulo 2^64, so exact
    base, n = base.astype(object), len(z)
    return s + n * base, p + np.outer(base, s) + np.outer(s, base) + n * np.outer(base, base)


def scatter(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, products) of floor(64 c) over all vectors, as exact Python integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, 0, 0
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                z = _integers(batch.slice(a, ROWS))
                s, p = _block(z)
                n, sums, products = n + len(z), sums + s, products + p
        if not n:
            return
        d = len(sums)
        i, j = np.triu_indices(d)
        entry = [(-1, -1, n), *((k, -1, v) for k, v in enumerate(sums.tolist())), *zip(i.tolist(), j.tolist(), products[i, j].tolist())]
        high, low = zip(*(divmod(e[2], LIMB) for e in entry))
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[0] for e in entry], pa.int32()), pa.array([e[1] for e in entry], pa.int32()),
             pa.array(list(map(decimal.Decimal, high)), pa.decimal128(38, 0)), pa.array(list(map(decimal.Decimal, low)), pa.decimal128(38, 0))], names=["i", "j", "high", "low"])

    parts = vectors.select("v").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow().to_pylist()  # a row for each pair of dimensions
    value = {(r["i"], r["j"]): int(r["high"]) * LIMB + int(r["low"]) for r in total}
    n = value.pop((-1, -1), 0)
    d = sum(j < 0 for _, j in value)
    products = np.zeros((d, d), object)
    for (i, j), v in value.items():
        if j >= 0:
            products[i, j] = products[j, i] = v
    return n, [value[i, -1] for i in range(d)], products


def fit(vectors: DataFrame, components: int = MOST_COMPONENTS) -> Whitening:
    """The components of the covariance (divisor n) of the vectors."""
    n, sums, products = scatter(vectors)
    if not n or not sums:
        return Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    s = np.array(sums, object)
    centred = n * products - np.outer(s, s)  # n^2 times the covariance
    covariance = np.array([[v / (n * n) for v in row] for row in centred.tolist()], np.float64)
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    held = int((values > len(s) * np.finfo(np.float64).eps * max(values[0], 0)).sum())
    values, vectors_ = values[: min(held, components)], vectors_[:, : min(held, components)]
    if len(values):
        vectors_ = vectors_ * np.where(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0)
    return Whitening(n, sums, values.copy(), vectors_, int(np.trace(centred)) / (n * n))


# the transform


def _centred(z: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S, exact: as longs where they fit, else as Python integers."""
    most = max(abs(int(z.min(initial=0))), abs(int(z.max(initial=0)))) * model.n + max(map(abs, model.sums))
    if most < 1 << LONG_BITS:
        return z * model.n - np.array(model.sums, np.int64)
    return z.astype(object) * model.n - np.array(model.sums, object)


def _whitened(apart: np.ndarray, model: Whitening) -> np.ndarray:
    return (apart / model.n).astype(np.float64) @ model.vectors / np.sqrt(model.values)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened values' covariance less the identity."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _whitened(_centred(_integers(batch), model), model)
            sums += w.sum(axis=0)
            products += w.T @ w
        i, j = np.indices((k + 1, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.vstack([products, sums]).reshape(-1))], names=["i", "j", "v"])

    if not k:
        return 0.0
    total = vectors.select("v").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pylist()
    got = np.zeros((k + 1, k))
    for r in total:
        got[r["i"], r["j"]] = r["v"]
    mean = got[k] / model.n
    return float(np.abs(got[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, deviation_exact and the whitened values (array<double>) of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                apart = _centred(_integers(part), model)
                w = _whitened(apart, model)
                most = int(np.abs(apart).max(initial=0))
                apart = apart if most**2 * apart.shape[1] < 1 << LONG_BITS else apart.astype(object)
                far = [int(x) for x in (apart * apart).sum(axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array([x if x < 1 << 63 else None for x in far], pa.int64()),
                     pa.array([_EXACT.create_decimal(x) if x < 10**38 else None for x in far], pa.decimal128(38, 0)),
                     pa.FixedSizeListArray.from_arrays(pa.array(w.reshape(-1)), w.shape[1]).cast(pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "deviation_exact", "whitened"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, deviation long, deviation_exact decimal(38,0), whitened array<double>")


def digest(rows: DataFrame, *, vector: str = "embedding", vec_id: str = "vec_id", components: int = MOST_COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error, deviation_exact."""
    vectors = usable(rows, vector, vec_id)
    model = fit(vectors, components)
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    if not len(model.values):
        return rows.sparkSession.createDataFrame([], empty)
    error = identity_error(vectors, model)
    share = F.array(*(F.lit(float(x)) for x in model.explained))
    out = transform(vectors, model).select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact")
