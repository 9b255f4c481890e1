"""Benchmark passages in documents, by CGK embedding and bit-sampling LSH.

A random walk reads a sequence of words: at step t it writes down the word under it, and
a random bit of (t, word) says whether it moves on. Two sequences that differ by few
edits give walks that mostly write the same words at the same steps, so edit distance
becomes Hamming distance. Walks start at every word of a document and, all along an item,
at every few of its words: wherever the edits of a passage gather, some walk of the item
runs through words with no more than the usual share of them. A sample of steps, hashed,
is the key of a table. Where a document and an item share a key in one of the tables, the
place of that walk in the item says about where the whole item would begin, and all
windows that begin up to the limit of edits before or behind are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import Words, chunks, mixed, rows_kept, texts_of

# Edits per word of an item, at most.
EDIT_SHARE = 0.2
# Walks, tables per walk, and steps sampled per table. With six of ten steps equal a table
# finds a window with probability 0.6^4, and 32 tables miss it with (1 - 0.6^4)^32 = 1 %.
WALKS, TABLES, SAMPLED = 8, 4, 4
# Shortest items of a class of lengths, steps its walks take (about as many as keep a walk
# inside the shortest item), and words from one walk of an item to the next.
CLASSES = ((1, 1, 1), (3, 4, 1), (6, 9, 1), (12, 18, 4))
# Words that the last walk of an item has before it, at least.
TAIL = 2
# Text of items that goes along with a task; more items are searched for in several passes.
BLOCK_BYTES = 8 << 20
BITMAP, BAG = 1 << 19, 1 << 22
# Words that a walk handles at once, so that its arrays stay near the processor.
BLOCK_WORDS = 1 << 16
# Cells of all windows that are compared at once.
CELLS = 1 << 17
SEED, SPREAD = 11, np.uint64(0xD6E8FEB86659FD93)


class Walk:
    """Steps of one walk over an array of word hashes."""

    def __init__(self, number: int, steps: int, seed: int):
        random = np.random.default_rng((seed, number, steps))
        self.steps = steps
        self.salt = np.uint64(random.integers(1 << 62))
        self.samples = [np.sort(random.choice(steps, min(SAMPLED, steps), replace=False)) for _ in range(TABLES)]
        self.last = max(int(sample[-1]) for sample in self.samples)
        self.factors = (random.integers(1 << 62, size=steps).astype(np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)

    def keys(self, hashes: np.ndarray, n: int) -> Iterator[list[np.ndarray]]:
        """A key per table of the windows at each of the first `n` words, block by block;
        behind the end stands the word 0, `steps` times at least.

        The steps are taken from the last to the first: what a walk writes from step t on
        depends on t and the word under it alone, so all walks that meet there share it.
        """
        for first in range(0, n, BLOCK_WORDS):
            size = min(BLOCK_WORDS, n - first)
            part = hashes[first : first + size + self.last]
            words = (part >> np.uint64(32)).astype(np.uint32)
            # The bit of step t is moved to the sign, which then fills the whole mask.
            bits = mixed(part ^ self.salt).astype(np.uint32).view(np.int32)
            keys: list[np.ndarray | None] = [None] * len(self.samples)
            mask, other = np.empty(len(part), np.int32), np.empty(len(part), np.uint32)
            for t in range(self.last, -1, -1):
                length = size + t
                if t < self.last:
                    np.left_shift(bits[:length], 31 - t, out=mask[:length])
                    np.right_shift(mask[:length], 31, out=mask[:length])
                    moves = mask[:length].view(np.uint32)
                    for key in keys:
                        if key is not None:  # key = key moved by one word where the bit is set
                            np.bitwise_xor(key[1 : length + 1], key[:length], out=other[:length])
                            np.bitwise_and(other[:length], moves, out=other[:length])
                            np.bitwise_xor(key[:length], other[:length], out=key[:length])
                written = None
                for k, sample in enumerate(self.samples):
                    if t in sample:
                        written = words[:length] * self.factors[t] if written is None else written
                        if keys[k] is None:
                            keys[k] = written.copy()
                        else:
                            keys[k][:length] += written
            yield [key[:size] for key in keys]


class Items:
    """Items of one class of lengths, with their keys in all tables."""

    def __init__(self, numbers: list[int], sequences: list[np.ndarray], steps: int, stride: int, seed: int):
        self.numbers = np.array(numbers, np.int64)
        self.sizes = np.array([len(s) for s in sequences], np.int64)
        self.limits = np.floor(self.sizes * EDIT_SHARE).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(sequences)
        self.walks = [Walk(i, steps, seed) for i in range(WALKS)]
        # Without edits the first walk is enough.
        count = np.where(self.limits > 0, np.maximum(1, (self.sizes - TAIL - 1) // stride + 1), 1)
        self.item = np.repeat(np.arange(len(sequences)), count)  # of each walk, and the word it starts at
        self.offset = (np.arange(len(self.item)) - np.repeat(np.cumsum(count) - count, count)) * stride
        padding = np.zeros(steps + 1, np.uint64)
        flat = np.concatenate([np.concatenate((s, padding)) for s in sequences])
        starts = (np.cumsum(self.sizes + steps + 1) - (self.sizes + steps + 1))[self.item] + self.offset
        self.tables = []  # sorted keys, their walks of items, and a bitmap of them, per table
        for walk in self.walks:
            for blocks in zip(*walk.keys(flat, len(flat) - steps)):
                keys = np.concatenate(blocks)[starts]
                order = np.argsort(keys, kind="stable")
                marked = np.zeros(BITMAP, bool)
                marked[keys & np.uint32(BITMAP - 1)] = True
                self.tables.append((keys[order], order.astype(np.int32), marked))
        own = np.repeat(np.arange(len(sequences)), self.sizes)
        self.bag = np.zeros(BAG, bool)
        self.bag[self.bag_place(own, self.words * SPREAD)] = True

    def bag_place(self, item: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Of words that are multiplied by SPREAD."""
        spread = words + item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) * SPREAD
        return (spread >> np.uint64(65 - BAG.bit_length())).view(np.int64)

    def candidates(self, hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items, and the first of `limit` + 1 words at which a walk that shares a key would
        have its item begin, each pair once. `firsts` has the first word of each word's text;
        what would begin before it begins there."""
        found = []
        for w, walk in enumerate(self.walks):
            for block, tables in enumerate(walk.keys(hashes, len(firsts))):
                for (ordered, order, marked), keys in zip(self.tables[w * TABLES :], tables):
                    near = np.flatnonzero(marked.take((keys & np.uint32(BITMAP - 1)).view(np.int32)))
                    low = np.searchsorted(ordered, keys[near])
                    count = np.searchsorted(ordered, keys[near], "right") - low
                    near, low, count = near[count > 0], low[count > 0], count[count > 0]
                    if not len(near):
                        continue
                    near += block * BLOCK_WORDS
                    met = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
                    near, item = np.repeat(near, count), self.item[met]
                    first, wide = firsts[near], self.limits[item] + 1
                    begin = first + np.maximum(0, near - self.offset[met] - first) // wide * wide
                    found.append(np.unique(begin * len(self.sizes) + item))
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs % len(self.sizes), pairs // len(self.sizes)

    def verified(self, hashes: np.ndarray, items: np.ndarray, begins: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits between each item and a window around its begin, -1 above the limit,
        and the first word of the first window that has them. `firsts` and `ends` are the
        bounds of the texts."""
        edits, starts = np.full(len(items), -1, np.int64), np.zeros(len(items), np.int64)
        spread = hashes * SPREAD
        order = np.argsort(self.sizes[items], kind="stable")
        ordered, first = self.sizes[items][order], 0
        for size in np.unique(ordered).tolist():
            end, step = int(np.searchsorted(ordered, size, "right")), max(1, CELLS // (2 * size))
            for at in range(first, end, step):
                part = order[at : min(at + step, end)]
                edits[part], starts[part] = self.compared(hashes, spread, size, items[part], begins[part], firsts[part], ends[part])
            first = end
        return edits, starts

    def compared(self, hashes: np.ndarray, spread: np.ndarray, size: int, items: np.ndarray, begins: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As `verified`, for items of one size."""
        limit = int(self.limits[items[0]])
        # Windows begin at up to `limit` words on both sides of the limit + 1 words.
        left, width = begins - limit, 3 * limit + size + limit
        places = left[:, None] + np.arange(width)
        inside = (places >= firsts[:, None]) & (places < ends[:, None])
        places = np.clip(places, 0, len(hashes) - 1)
        # At least size - limit words of some window must be words of the item.
        common = np.zeros((len(items), width + 1), np.int32)
        np.cumsum(self.bag.take(self.bag_place(items[:, None], spread.take(places))) & inside, axis=1, out=common[:, 1:])
        reach = size + limit
        own = np.flatnonzero((common[:, reach:] - common[:, :-reach]).max(axis=1) >= size - limit)
        edits, starts = np.full(len(items), -1, np.int64), np.zeros(len(items), np.int64)
        if not len(own):
            return edits, starts
        given = self.words[self.first[items[own]][:, None] + np.arange(size)]
        seen = np.where(inside[own], hashes[places[own]], np.uint64(0))
        # A cell holds the edits and the window's first column as one number, so the least
        # number is that of the first window with the least edits.
        one = width + 1
        column = np.arange(one)
        border = left[own][:, None] + column
        out_of_text = (border < firsts[own][:, None]) | (border > ends[own][:, None])
        row = np.where(out_of_text, one * (size + width), column[None, :]).astype(np.int64)
        for i in range(size):
            step = row + one
            np.minimum(step[:, 1:], row[:, :-1] + one * (seen != given[:, i : i + 1]), out=step[:, 1:])
            row = np.minimum.accumulate(step - column * one, axis=1) + column * one
        row[out_of_text] = one * (size + width)
        best = row.min(axis=1)
        near = best // one <= limit
        edits[own[near]], starts[own[near]] = best[near] // one, left[own[near]] + best[near] % one
        return edits, starts


class Benchmark:
    """All items that one pass looks for."""

    def __init__(self, ids: list, texts: list[str], seed: int = SEED):
        words = Words(pa.array(texts, pa.string()), lower=True)
        hashes = words.hashes() | np.uint64(1)
        sequences = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.ids, self.classes = ids, []
        for k, (least, steps, stride) in enumerate(CLASSES):
            most = CLASSES[k + 1][0] if k + 1 < len(CLASSES) else np.inf
            numbers = [i for i, s in enumerate(sequences) if least <= len(s) < most]
            if numbers:
                self.classes.append(Items(numbers, [sequences[i] for i in numbers], steps, stride, seed))

    def find(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(text, item, first word, edits) of the best place of every item in every text."""
        words = Words(texts, lower=True)
        n = len(words.starts)
        if not n:
            return []
        hashes = np.concatenate((words.hashes() | np.uint64(1), np.zeros(CLASSES[-1][1] + 1, np.uint64)))
        rows = words.rows()
        firsts, ends = words.first[:-1][rows], words.first[1:][rows]
        hits: list[tuple[int, int, int, int]] = []
        for items in self.classes:
            met, begins = items.candidates(hashes, firsts)
            edits, starts = items.verified(hashes, met, begins, firsts[begins], ends[begins])
            kept = np.flatnonzero(edits >= 0)
            hits += zip(rows[begins[kept]].tolist(), items.numbers[met[kept]].tolist(), edits[kept].tolist(), starts[kept].tolist())
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for text, item, edits, start in hits:
            best[text, item] = min(best.get((text, item), (edits, start)), (edits, start))
        return [(text, item, start - int(words.first[text]), edits) for (text, item), (edits, start) in sorted(best.items())]


def benchmarks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Benchmark]:
    """The items in blocks of about `block_bytes` of text, one block at a time."""
    rows = pick(items, "item_id", "text").select("item_id", text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        found = [(r["item_id"], r["text"]) for r in own.toLocalIterator()]
        yield Benchmark([i for i, _ in found], [t for _, t in found])


def find_leaks(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, word_start, n_edits: every item that a document of `docs` holds.

    An item (item_id, text) is held by a document if some run of its words, read from
    `word_start`, comes from the item by at most EDIT_SHARE of its words inserted, removed
    or exchanged; n_edits is the least number, at the first place that has it. Words are
    lower-cased in A-Z. Every match is exact; matches at the limit are missed with the
    probability that WALKS and TABLES leave. Null and empty texts and items hold and are
    nothing; items that repeat are items of their own, and rows that repeat give rows that
    repeat. Empty tables give an empty result. Other columns are ignored. No shuffle; the
    items of one pass go along with the task, larger benchmarks take several passes.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    kind, of_item = (df.schema[c].dataType.simpleString() for df, c in ((rows, "doc_id"), (pick(items, "item_id"), "item_id")))
    schema = f"doc_id {kind}, item_id {of_item}, word_start bigint, n_edits bigint"

    def search(benchmark: Benchmark):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in chunks(batch):
                    hits = benchmark.find(texts_of(piece))
                    ids = texts_of(piece, "doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([benchmark.ids[h[1]] for h in hits], item_type), pa.array([h[2] for h in hits], pa.int64()), pa.array([h[3] for h in hits], pa.int64())],
                        ["doc_id", "item_id", "word_start", "n_edits"],
                    )

        return run

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(pick(items, "item_id").schema["item_id"].dataType)
    found = None
    for benchmark in benchmarks(items, block_bytes):
        part = rows.mapInArrow(search(benchmark), schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold none of the items."""

    def clean(benchmark: Benchmark):
        def keep(texts: pa.Array) -> np.ndarray:
            stays = np.ones(len(texts), bool)
            stays[[hit[0] for hit in benchmark.find(texts)]] = False
            return stays

        return keep

    for benchmark in benchmarks(items, block_bytes):
        docs = rows_kept(docs, clean(benchmark))
    return docs
