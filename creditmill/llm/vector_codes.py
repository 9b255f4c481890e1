"""Product codes of vectors: k-means per part, distances from an exact limb-split GEMM.

Vectors become integers (floor of 1024 times each component) and are cut into equal
consecutive parts; each part position has its own codebook. Distances need the dot
products of integer matrices. Each integer is split into limbs small enough that float64
matrix products of limbs are exact (every sum of products stays below 2^53); the limb
products are recombined in int64, and the first index of the least distance wins.

All passes read the embeddings where they lie. A task adds up, over all its batches, the
parts given to each entry and sends one row per used (part, entry, position): what
crosses the network and reaches the driver is bounded by the codebooks, not by the rows,
so an entry that takes a third of all vectors costs no more than any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import pick
from creditmill.operators.dims import keyed_join
from creditmill.operators.materialize import computed_once

# Fixed values of the contract.
SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4

INT64_BITS = 63
EXACT_BITS = 53

SUMS_SCHEMA = "part int, entry int, position int, total long, count long"
CODES_SCHEMA = "vec_id long, label int, code string, error long"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: floor(scale * x) per component, of rows whose vector is present and
    holds only finite components; other rows are dropped."""
    rows = pick(embeddings, "vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
    )


def limb_width(width: int) -> int:
    """Bits per limb so that `width` products of two limbs sum below 2^53."""
    return (EXACT_BITS - max(1, width).bit_length()) // 2


def limbs(values: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """int64 values as `count` float64 limbs: low ones in [0, 2^bits), the top one signed."""
    out, rest = [], values.copy()
    for _ in range(count - 1):
        low = rest & ((1 << bits) - 1)
        out.append(low.astype(np.float64))
        rest = (rest - low) >> bits
    out.append(rest.astype(np.float64))
    return out


def exact_products(x: np.ndarray, c: np.ndarray, bits: int, count: int) -> np.ndarray:
    """x @ c.T in int64, from float64 GEMMs of limbs that are exact."""
    xs, cs = limbs(x, bits, count), limbs(c, bits, count)
    total = np.zeros((len(x), len(c)), np.int64)
    for i, a in enumerate(xs):
        for j, b in enumerate(cs):
            total += (a @ b.T).astype(np.int64) << ((i + j) * bits)
    return total


def nearest(x: np.ndarray, c: np.ndarray, bits: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (first of equals) and its squared distance, per row."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    dist = (x * x).sum(axis=1)[:, None] - 2 * exact_products(x, c, bits, count) + (c * c).sum(axis=1)[None, :]
    best = np.argmin(dist, axis=1)
    return best, dist[np.arange(len(x)), best]


class Plan:
    """Shape and limbs of one fit: parts of `width` integers of magnitude below `bound`."""

    def __init__(self, dimension: int, bound: int, parts: int = PARTS):
        if dimension % parts:
            raise ValueError(f"vectors of {dimension} components do not cut into {parts} equal parts")
        self.parts, self.width = parts, dimension // parts
        if self.width * (2 * bound) ** 2 >= 1 << INT64_BITS:
            raise ValueError(f"squared distances of parts of {self.width} integers up to {bound} exceed int64")
        self.bits = limb_width(self.width)
        self.count = 1
        while bound >= 1 << (self.bits * self.count - 1):
            self.count += 1

    def split(self, v: np.ndarray) -> list[np.ndarray]:
        return [v[:, p * self.width : (p + 1) * self.width] for p in range(self.parts)]

    def assign(self, v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x parts) and squared distances (rows x parts)."""
        found = [nearest(x, books[p], self.bits, self.count) for p, x in enumerate(self.split(v))]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def matrix(column: pa.Array, rows: int, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(rows, dimension)


def entry_sums(vectors: DataFrame, plan: Plan, books: np.ndarray) -> DataFrame:
    """Per used (part, entry, position): sum of the assigned parts and their number,
    added up in each task over all its batches."""
    dimension, entries = plan.parts * plan.width, books.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((plan.parts, entries, plan.width), np.int64)
        counts = np.zeros((plan.parts, entries), np.int64)
        for batch in batches:
            v = matrix(batch.column("v"), batch.num_rows, dimension)
            codes, _ = plan.assign(v, books)
            for p, x in enumerate(plan.split(v)):
                np.add.at(totals[p], codes[:, p], x)
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        width = max(plan.width, 1)
        yield pa.RecordBatch.from_pydict({
            "part": np.repeat(part, width).astype(np.int32),
            "entry": np.repeat(entry, width).astype(np.int32),
            "position": np.tile(np.arange(width) if plan.width else np.array([-1]), len(part)).astype(np.int32),
            "total": (totals[part, entry] if plan.width else np.zeros((len(part), 1), np.int64)).ravel(),
            "count": np.repeat(counts[part, entry], width),
        })

    return vectors.select("v").mapInArrow(sums, SUMS_SCHEMA)


def updated(books: np.ndarray, sums: list) -> np.ndarray:
    """Each used entry becomes floor(sum / count) per position; unused entries stay."""
    books = books.copy()
    for part, entry, position, total, count in sums:
        if position >= 0:
            books[part, entry, position] = total // count
    return books


def fit_codebooks(vectors: DataFrame, plan: Plan, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        totals = entry_sums(vectors, plan, books).groupBy("part", "entry", "position").agg(
            F.sum("total").alias("total"), F.sum("count").alias("count")
        )
        books = updated(books, totals.collect())
    return books


def codebook_digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def assigned(vectors: DataFrame, plan: Plan, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits per part), error (distances summed over parts)."""
    dimension = plan.parts * plan.width

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), batch.num_rows, dimension)
            found, dist = plan.assign(v, books)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"),
                "label": batch.column("label"),
                "code": ["".join(f"{int(e):02x}" for e in row) for row in found],
                "error": dist.sum(axis=1).astype(np.int64),
            }, schema=pa.schema([("vec_id", pa.int64()), ("label", pa.int32()), ("code", pa.string()), ("error", pa.int64())]))

    return vectors.mapInArrow(codes, CODES_SCHEMA)


def vector_codes(embeddings: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256, label: product codes of all valid rows.

    Rows with a null vector, or a null, NaN or infinite component, are dropped; all others,
    repeated rows included, get a code. Codebooks start as the parts of the `entries`
    smallest vec_ids (nulls last; equal ids by their integer vector), so fewer rows give
    fewer entries, and an empty table gives no row. Every round assigns each part to the
    nearest entry, ties to the lower index, and moves each used entry to floor(sum/count).
    A null label counts as one label of its own for `label_error`. All valid vectors
    must have one length that `parts` divides, and squared distances must fit in int64
    (|floor(scale * x)| below about 2^28 for parts of 16); otherwise ValueError.
    Columns of other names in the input are ignored.
    """
    vectors = integer_vectors(embeddings, scale)
    shape = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("shortest"), F.max(F.size("v")).alias("longest"),
        F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))).alias("bound"),
    ).first()
    spark = embeddings.sparkSession
    if not shape["n"]:
        empty = spark.createDataFrame([], CODES_SCHEMA)
        return empty.select("vec_id", "code", "error", F.lit(0).cast("long").alias("label_error"),
                            F.lit(None).cast("string").alias("codebooks_sha256"), "label")
    if shape["shortest"] != shape["longest"]:
        raise ValueError(f"vectors of {shape['shortest']} to {shape['longest']} components")
    plan = Plan(shape["longest"], int(shape["bound"]) + 1, parts)
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    first = np.array([row["v"] for row in seeds], np.int64).reshape(len(seeds), shape["longest"])
    books = np.stack([first[:, p * plan.width : (p + 1) * plan.width] for p in range(parts)])
    books = fit_codebooks(vectors, plan, books, rounds)
    codes = computed_once(assigned(vectors, plan, books))
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = keyed_join(codes, by_label, F.col("label"), "_label", "left", null_keys_match=True)
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"), "label"
    )
