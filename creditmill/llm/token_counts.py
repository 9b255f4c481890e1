"""Token counts by rank-synchronous merging of ragged arrays.

The different pre-tokens of a batch stand one behind the other in one array of
symbols. In each round every sequence applies its lowest-ranked pair, at all its places,
together with all other sequences; a sequence without a known pair is done. Left are the
tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.pretokens import Pretokenizer, split_words
from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import chunks, texts_of

# Text bytes taken together.
CHUNK_BYTES = 4 << 20
NONE = np.iinfo(np.int64).max


class Merges:
    """The merge table: ranks and results of symbol pairs, by binary search on pair keys."""

    def __init__(self, spec: dict):
        self.vocab = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"]
        self.width = max(self.vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        result = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(left * self.width + right)
        self.keys, self.ranks, self.results = (left * self.width + right)[order], order, result

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def count(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token, all of them non-empty."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if not len(sizes):
            return sizes
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        plain, last = self.alphabet()
        symbols = plain[points]
        symbols[first + sizes - 1] = last[points[first + sizes - 1]]
        return self.merge(symbols, np.repeat(np.arange(len(sizes)), sizes), len(sizes))

    def alphabet(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single characters, inside a word and at its end."""
        if not hasattr(self, "_alphabet"):
            singles = [t for t in self.vocab if len(t) == 1]
            size = max(map(ord, singles)) + 1
            plain, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for t in singles:
                plain[ord(t)], last[ord(t)] = self.vocab[t], self.vocab[t + self.end]
            self._alphabet = plain, last
        return self._alphabet

    def merge(self, symbols: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Symbols left of each of the n sequences."""
        counts = np.bincount(owner, minlength=n)
        while len(symbols) > 1:
            inside = owner[:-1] == owner[1:]
            ranks = np.where(inside, self.rank(symbols[:-1], symbols[1:]), NONE)
            lowest = np.full(n, NONE)
            heads = np.flatnonzero(np.concatenate(([True], ~inside)))
            lowest[owner[heads]] = np.minimum.reduceat(np.append(ranks, NONE), heads)
            active = lowest[owner] != NONE
            hit = (ranks == lowest[owner[:-1]]) & (ranks != NONE)
            # Of places that overlap ("aaa") every second one counts, from the left.
            places = np.flatnonzero(hit)
            if not len(places):
                break
            run = np.concatenate(([True], np.diff(places) > 1))
            starts = places[run][np.cumsum(run) - 1]
            places = places[(places - starts) % 2 == 0]
            symbols[places] = self.results[ranks[places]]
            counts -= np.bincount(owner[places], minlength=n)
            stay = active
            stay[places + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return counts


class Counter:
    """Token counts of texts under one vocabulary file."""

    def __init__(self, path: str):
        self.split = Pretokenizer(path)
        self.merges = Merges(self.split.spec)

    def count(self, texts: pa.Array) -> np.ndarray:
        first, codes, words = split_words(texts)
        owner, pieces, distinct = self.split.split(words)
        sizes = np.ones(len(distinct), np.int64)  # of special strings
        plain = [i for i, p in enumerate(distinct) if isinstance(p, str)]
        sizes[plain] = self.merges.count([distinct[i] for i in plain])
        each = np.bincount(owner, sizes[pieces], minlength=len(words)).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(each[codes])))
        return total[first[1:]] - total[first[:-1]]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row.

    `vocabulary` is a file that every executor has. Whole texts count, without begin and
    end tokens; strings of special tokens inside a text are one token each, as the library
    has it by default. A null or empty text has 0 tokens. Rows are counted one by one, so
    repeated rows stay, and an empty table gives an empty result. Other columns are
    ignored. No shuffle; memory is bound by one text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            for piece in chunks(batch, limit=CHUNK_BYTES):
                texts = texts_of(piece)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": texts_of(piece, "doc_id"),
                    "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                    "n_tokens": pa.array(counter.count(texts), pa.int64()),
                })

    rows = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
