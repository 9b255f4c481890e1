"""Whitening of embeddings from an exact integer covariance, by bit-sliced scatter.

Entries become integers x = floor(64 c) + 1000000. The cross-products of all pairs of
dimensions are counted from bits: each task shifts every dimension by its least value,
packs each bit plane of each dimension across its rows into 64-bit words, and for every
pair of planes adds popcount(a AND b) weighted by 2^(bit a + bit b). Tasks send one row
per pair of dimensions; the driver receives a matrix of dimension x dimension integers,
whatever the number of rows, centres it as integers (n P - S S^T, the covariance times
n^2) and takes its eigenvectors. Tasks whiten their rows for the output, and once more
to send the sums of products of the whitened values, from which the covariance of the
output is measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import pick

# Fixed values of the contract.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32

WORD_BITS = 64
# A task flushes its cross-products before they could leave int64.
INT64_LIMIT = 1 << 62

SUMS_SCHEMA = "i int, j int, total decimal(38,0)"
ROWS_SCHEMA = "vec_id long, component int, deviation long, whitened double"


def integer_rows(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, x: floor(scale * c) + offset per entry, of rows whose vector is present and
    holds only finite entries."""
    rows = pick(embeddings, "vec_id", "embedding")
    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))

    # The guard inside the transform keeps filters that the optimizer moves ahead of the
    # one below from meeting infinite entries.
    return rows.where(F.col("embedding").isNotNull() & F.forall("embedding", finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda c: F.when(finite(c), F.floor(c.cast("double") * scale) + offset).cast("long")).alias("x"),
    )


def matrix(column: pa.Array, rows: int, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, dimension)


def bit_planes(u: np.ndarray, bits: int) -> np.ndarray:
    """(dimension * bits, words) uint64: bit b of dimension i over all rows, packed."""
    rows, dimension = u.shape
    words = -(-rows // WORD_BITS)
    planes = ((u.T[:, None, :] >> np.arange(bits)[None, :, None]) & 1).astype(np.uint8)
    padded = np.zeros((dimension, bits, words * WORD_BITS), np.uint8)
    padded[:, :, :rows] = planes
    packed = np.packbits(padded, axis=2, bitorder="little")
    return packed.view(np.uint64).reshape(dimension * bits, words)


def plane_cross_products(u: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of u_i u_j over rows (dimension x dimension) and of u_i, from weighted
    popcounts of ANDed bit planes."""
    dimension = u.shape[1]
    planes = bit_planes(u, bits)
    count = len(planes)
    popcounts = np.zeros((count, count), np.int64)
    for q in range(count):
        popcounts[q, q:] = np.bitwise_count(planes[q] & planes[q:]).sum(axis=1, dtype=np.int64)
    popcounts = np.triu(popcounts) + np.triu(popcounts, 1).T
    weights = np.left_shift(1, np.arange(bits), dtype=np.int64)
    blocks = popcounts.reshape(dimension, bits, dimension, bits)
    cross = np.einsum("ibjc,b,c->ij", blocks, weights, weights)
    sums = (np.bitwise_count(planes).sum(axis=1, dtype=np.int64).reshape(dimension, bits) * weights).sum(axis=1)
    return cross, sums


def scattered(vectors: DataFrame, low: np.ndarray, bits: int) -> DataFrame:
    """Per task: (i, j, sum of u_i u_j), (i, -1, sum of u_i) and (-1, -1, rows), u = x - low."""
    dimension = len(low)
    per_row = max(1, (1 << (2 * bits)) * max(1, dimension))
    flush_rows = max(1, INT64_LIMIT // per_row)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross, totals, rows = np.zeros((dimension, dimension), np.int64), np.zeros(dimension, np.int64), 0

        def flushed():
            i, j = np.triu_indices(dimension)
            keys_i = np.concatenate([i, np.arange(dimension), [-1]]).astype(np.int32)
            keys_j = np.concatenate([j, np.full(dimension, -1), [-1]]).astype(np.int32)
            values = [int(v) for v in np.concatenate([cross[i, j], totals, [rows]])]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys_i), pa.array(keys_j), pa.array(values, pa.decimal128(38, 0))], ["i", "j", "total"]
            )

        for batch in batches:
            u = matrix(batch.column("x"), batch.num_rows, dimension) - low
            for start in range(0, len(u), flush_rows):
                part = u[start : start + flush_rows]
                if rows + len(part) > flush_rows:
                    yield flushed()
                    cross[:], totals[:], rows = 0, 0, 0
                c, s = plane_cross_products(part, bits)
                cross += c
                totals += s
                rows += len(part)
        yield flushed()

    return vectors.select("x").mapInArrow(sums, SUMS_SCHEMA)


class Whitening:
    """Exact moments and the eigenvectors of the covariance they give."""

    def __init__(self, n: int, low: np.ndarray, cross: list[list[int]], sums: list[int], components: int):
        self.n, self.low, self.dimension = n, low, len(low)
        self.sums_u = np.array(sums, dtype=object)
        centred = [[n * cross[i][j] - sums[i] * sums[j] for j in range(self.dimension)] for i in range(self.dimension)]
        self.covariance = np.array([[float(v) for v in row] for row in centred]) / float(n) ** 2
        values, vectors = np.linalg.eigh(self.covariance)
        order = np.argsort(-values, kind="stable")[:components]
        values, vectors = values[order], vectors[:, order]
        signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
        self.values, self.vectors = values, vectors * np.where(signs == 0, 1, signs)
        floor = (abs(values).max() if len(values) else 0.0) * max(1, self.dimension) * np.finfo(float).eps
        self.usable = values > floor
        self.trace = float(np.trace(self.covariance))

    def whiten(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """deviation (exact) and whitened values (rows x components; null where e <= 0)."""
        centred = self.n * (x - self.low) - self.sums_u.astype(np.int64)
        squares = (centred.astype(np.float64) ** 2).sum(axis=1)
        if len(squares) and squares.max() >= 2.0 ** 62:
            raise ValueError("a deviation does not fit in a long")
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.sqrt(np.where(self.usable, self.values, np.nan))
            whitened = (centred.astype(np.float64) / self.n) @ self.vectors / scale
        return (centred * centred).sum(axis=1), whitened

    def rows(self, vec_id: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        deviation, whitened = self.whiten(x)
        k = self.vectors.shape[1]
        return pa.RecordBatch.from_pydict({
            "vec_id": vec_id.take(pa.array(np.repeat(np.arange(len(x)), k))),
            "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(vec_id)),
            "deviation": np.repeat(deviation, k),
            "whitened": pa.array(whitened.ravel(), pa.float64(), from_pandas=True),
        }, schema=pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("deviation", pa.int64()), ("whitened", pa.float64())]))


def fitted(vectors: DataFrame, components: int) -> Whitening | None:
    """The moments of all rows: ranges by dimension first, then the bit-sliced scatter."""
    spread = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    ranges = sorted(spread.collect())
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    if not shape["n"]:
        return None
    if shape["a"] != shape["b"]:
        raise ValueError(f"vectors of {shape['a']} to {shape['b']} entries")
    low = np.array([r["low"] for r in ranges], np.int64)
    bits = max([int(r["high"] - r["low"]).bit_length() for r in ranges] + [1])
    moments = scattered(vectors, low, bits).groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    dimension = len(low)
    cross = [[0] * dimension for _ in range(dimension)]
    sums = [0] * dimension
    n = 0
    for row in moments:
        i, j, total = row["i"], row["j"], int(row["total"])
        if i < 0:
            n = total
        elif j < 0:
            sums[i] = total
        else:
            cross[i][j] = cross[j][i] = total
    return Whitening(n, low, cross, sums, min(components, dimension))


def whitened_rows(vectors: DataFrame, model: Whitening) -> DataFrame:
    dimension = model.dimension

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield model.rows(batch.column("vec_id"), matrix(batch.column("x"), batch.num_rows, dimension))

    return vectors.mapInArrow(rows, ROWS_SCHEMA)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance (divisor n) minus the identity,
    over components with a positive eigenvalue. Tasks whiten their rows as the output does
    and send the k x k sums of products."""
    k = int(model.usable.sum())
    if not k:
        return None
    dimension = model.dimension

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = model.whiten(matrix(batch.column("x"), batch.num_rows, dimension))[1][:, :k]
            total += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "total": total[i, j]})

    sums = vectors.select("x").mapInArrow(products, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    return max(abs(r["total"] / model.n - (r["i"] == r["j"])) for r in sums.collect())


def whitening(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per
    valid row and component (the first `components` by falling eigenvalue).

    Rows whose vector is null or holds a null, NaN or infinite entry are dropped; all
    others, repeated and null vec_ids too, are fitted and returned. An empty table gives no
    row; vectors of different lengths raise ValueError; so does a deviation beyond a long.
    Components whose eigenvalue is not above rounding (all of them for one row or equal
    rows) have a null `whitened`, and `explained` is null when the trace is 0;
    identity_error covers the other components and is null without any. Eigenvectors are
    signed so that their largest entry is positive. Other input columns are ignored.
    """
    vectors = integer_rows(embeddings, scale, offset)
    model = fitted(vectors, components)
    if model is None:
        empty = embeddings.sparkSession.createDataFrame([], ROWS_SCHEMA)
        return empty.select("vec_id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened",
                            F.lit(None).cast("double").alias("explained"), F.lit(None).cast("double").alias("identity_error"))
    error = identity_error(vectors, model)
    shares = [float(e / model.trace) if model.trace > 0 else None for e in model.values]
    explained = F.element_at(F.array(*[F.lit(v).cast("double") for v in shares]), F.col("component"))
    return whitened_rows(vectors, model).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
