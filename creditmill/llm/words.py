"""Words of many texts at once, as numpy arrays over one byte buffer.

The texts of an Arrow batch are cut to chunks of about a megabyte. In a chunk, words
and their 64-bit hashes come from a handful of array operations, so nothing in Python
is done per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20
# Fixed odd multipliers of the two independent hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Cache(dict):
    """Kept within a process, and left out where a function is sent to a task."""

    def __reduce__(self):
        return Cache, ()


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = Cache()


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..n and their inverses modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 4096)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 4 * CHUNK_BYTES:  # one very long text does not stay in memory
            _powers[base] = have
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of values[start:end] for each pair: the same slice gives the same hash
    wherever it stands."""
    up, down = powers(base, len(values))
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """Words of a chunk of texts. A space stands behind each text, so no word crosses
    texts and each word is followed by a byte of white space."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", " ").cast(pa.large_binary())
        offsets, data = texts.buffers()[1:]
        self.offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        base, end = int(self.offsets[0]), int(self.offsets[-1])
        self.offsets = self.offsets - base
        self.bytes = np.frombuffer(data, np.uint8, end - base, base) if end > base else np.zeros(0, np.uint8)
        if lower:
            self.bytes = _LOWER[self.bytes]
        space = _SPACE[self.bytes]
        edge = np.empty(len(space) + 1, np.int8)
        edge[0] = edge[-1] = 0
        np.logical_not(space, out=edge[1:].view(bool))
        edge = np.diff(edge[:], prepend=np.int8(0))[1:] if len(space) else np.zeros(0, np.int8)
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        # words of text i: first[i] to first[i + 1]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, base: int = BASES[0]) -> np.ndarray:
        return sequence_hashes(self.bytes, self.starts, self.ends, base)


def windows(words: Words, size: int) -> np.ndarray:
    """Index of the first word of each run of `size` words inside one text."""
    n = len(words.starts) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    left = np.repeat(words.first[1:], words.counts) - np.arange(len(words.starts))
    return np.flatnonzero(left[:n] >= size)


def chunks(batch: pa.RecordBatch | pa.Table, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The batch in pieces of at most `limit` bytes of text, or of one text above it."""
    table = pa.table(batch) if not isinstance(batch, pa.Table) else batch
    table = table.combine_chunks()
    if not len(table):
        return
    sizes = pc.fill_null(pc.binary_length(table.column(column)), 0).to_numpy().astype(np.int64)
    total = np.cumsum(sizes)
    at = 0
    while at < len(table):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
        yield table.slice(at, end - at)
        at = end


def texts_of(table: pa.Table, column: str = "text") -> pa.Array:
    array = table.column(column)
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def memory_returned() -> None:
    """Gives freed memory of a worker back to the system. Workers outlive their tasks, and
    what one stage has freed would else stand beside what the next one needs."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def rows_kept(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray], column: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, for whose texts `keep` gives true.

    `keep` gets the texts of a chunk. Columns go by place, so their names may clash.
    """
    names = docs.columns
    at = [i for i, c in enumerate(names) if c == column] or [i for i, c in enumerate(names) if c.lower() == column.lower()]
    plain, place = docs.toDF(*[f"c{i}" for i in range(len(names))]), f"c{at[0]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, place):
                yield from piece.filter(pa.array(keep(pc.fill_null(texts_of(piece, place), "")), pa.bool_())).to_batches()
            batch = piece = None
            memory_returned()

    return plain.mapInArrow(run, plain.schema).toDF(*names)
