"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its words and the beginnings of its words, hashed to a fixed
number of buckets; a text has a term or not. The machine's score is

    bias + sum of w[i] + sum over pairs i < j of <v[i], v[j]>

over the terms i that a text has, so a pair of terms can say more than both alone, and
costs no more than the terms, by the usual rewriting of the pair sum. It is trained on
terms that a bounded sample of labelled rows shows to go with a label; other terms weigh
nothing, so the length of a text does not change its score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import BASES, Words, chunks, rows_kept, sequence_hashes, texts_of

BUCKETS = 1 << 22
# Bytes of the beginnings of words that are terms.
PREFIXES = (3, 4, 5, 6, 7, 8)
# Labelled rows that the machine is fitted on, at most: clean ones, toxic ones.
SAMPLE = (7_000, 3_000)
# Terms it keeps, factors of each, passes over the sample.
TERMS, FACTORS, PASSES = 20_000, 8, 40
# A kept term is in so many rows, and its label differs from chance by so many nats.
LEAST_ROWS, LEAST_GAIN = 4, 10.0
THRESHOLD = 0.7


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every term occurrence."""
    rows = words.rows()
    # Punctuation at the end of a word is not part of it.
    ends = words.ends.copy()
    for _ in range(8):
        last = words.bytes[np.maximum(ends - 1, 0)]
        ends -= ((last < 0x30) | ((last >= 0x3A) & (last < 0x41)) | ((last >= 0x5B) & (last < 0x61))) & (ends - words.starts > 1)
    found_rows, found = [rows], [sequence_hashes(words.bytes, words.starts, ends, BASES[0])]
    for size in PREFIXES:
        long = np.flatnonzero(ends - words.starts > size)
        starts = words.starts[long]
        found_rows.append(rows[long])
        found.append(sequence_hashes(words.bytes, starts, starts + size, BASES[0]) ^ np.uint64(0x5851F42D4C957F2D))
    return np.concatenate(found_rows), (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)


def distinct_terms(words: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and term, each pair once; with `keep` (bucket to number, or -1) only kept terms."""
    rows, found = terms(words)
    if keep is not None:
        number = keep[found]
        known = number >= 0
        rows, found = rows[known], number[known]
    both = np.unique(rows * np.int64(BUCKETS) + found)
    return both // BUCKETS, both % BUCKETS


class Machine:
    """A factorization machine over numbered terms."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.buckets, self.bias, self.weights, self.factors = buckets, bias, weights, factors

    def numbers(self) -> np.ndarray:
        keep = np.full(BUCKETS, -1, np.int32)
        keep[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        return keep

    def raw(self, rows: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(rows, self.weights[found], minlength=n)
        sums = np.zeros((n, self.factors.shape[1]))
        np.add.at(sums, rows, self.factors[found])
        squares = np.bincount(rows, (self.factors**2).sum(axis=1)[found], minlength=n)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)

    def scores(self, rows: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows, found, n), -30, 30)))


def train(labels: np.ndarray, rows: np.ndarray, found: np.ndarray, seed: int = 7) -> Machine:
    """The machine for texts `0..n-1` with labels 0 or 1 and (text, bucket) pairs.

    Without rows, or with one label only, it has a bias and no terms.
    """
    n, positive = len(labels), int(labels.sum())
    bias = float(np.log((positive + 1) / (n - positive + 1)))
    nothing = Machine(np.zeros(0, np.int64), bias, np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < positive < n:
        return nothing
    total = np.bincount(found, minlength=BUCKETS)
    with_label = np.bincount(found[(labels > 0)[rows]], minlength=BUCKETS)
    # Likelihood ratio of each term with the label.
    share = positive / n
    inside = np.clip(with_label / np.maximum(total, 1), 1e-9, 1 - 1e-9)
    gain = total * (inside * np.log(inside / share) + (1 - inside) * np.log((1 - inside) / (1 - share)))
    gain[total < LEAST_ROWS] = 0
    chosen = np.flatnonzero(gain > LEAST_GAIN)
    chosen = chosen[np.argsort(-gain[chosen], kind="stable")[:TERMS]]
    if not len(chosen):
        return nothing
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    known = place[found] >= 0
    rows, found = rows[known], place[found[known]]
    del total, with_label, inside, gain, known
    random = np.random.default_rng(seed)
    machine = Machine(chosen, bias, np.zeros(len(chosen)), random.normal(0, 0.01, (len(chosen), FACTORS)))
    order = np.argsort(rows, kind="stable")
    rows, found = rows[order], found[order]
    first = np.searchsorted(rows, np.arange(n + 1))
    sums = [1e-8, np.full(len(chosen), 1e-8), np.full(machine.factors.shape, 1e-8)]
    for _ in range(PASSES):  # mini-batches with per-parameter step sizes
        mixed = random.permutation(n)
        for at in range(0, n, 512):
            texts = mixed[at : at + 512]
            sizes = first[texts + 1] - first[texts]
            own = np.repeat(np.arange(len(texts)), sizes)
            index = np.repeat(first[texts] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            # Each step sees half the terms, so that one alone can tell as well.
            seen = random.random(len(index)) < 0.5
            own, t = own[seen], found[index[seen]]
            v = machine.factors[t]
            total_v = np.zeros((len(texts), FACTORS))
            np.add.at(total_v, own, v)
            raw = machine.bias + np.bincount(own, machine.weights[t], minlength=len(texts)) + 0.5 * (
                (total_v**2).sum(axis=1) - np.bincount(own, (v**2).sum(axis=1), minlength=len(texts)))
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[texts]
            used, back = np.unique(t, return_inverse=True)
            step_w = np.bincount(back, error[own], minlength=len(used)) + 0.002 * machine.weights[used]
            step_v = np.zeros((len(used), FACTORS))
            np.add.at(step_v, back, error[own][:, None] * (total_v[own] - v))
            step_v += 0.02 * machine.factors[used]
            sums[0] += error.sum() ** 2
            sums[1][used] += step_w**2
            sums[2][used] += step_v**2
            machine.bias -= 0.1 * error.sum() / np.sqrt(sums[0])
            machine.weights[used] -= 0.3 * step_w / np.sqrt(sums[1][used])
            machine.factors[used] -= 0.03 * step_v / np.sqrt(sums[2][used])
    return machine


def labelled(labels: DataFrame, may_learn: Column) -> DataFrame:
    """One row per doc_id that may be learned from, with its label."""
    marked = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").where(may_learn)
    return marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled_terms(docs: DataFrame, marked: DataFrame, sample: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels and (text, bucket) pairs of at most `sample[label]` rows of each label.

    Rows are taken by the hash of their doc_id, so reruns take the same ones.
    """
    chosen = None
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample[label])
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most sum(sample) ids.
    texts = pick(docs, "doc_id", "text").where("doc_id is not null").select(F.col("doc_id").alias("_doc"), text_of().alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("doc_id")).select("doc_id", "toxic", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                words = Words(texts_of(piece), lower=True)
                rows, found = distinct_terms(words)
                cuts = np.searchsorted(rows, np.arange(len(piece) + 1))
                packed = [found[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": texts_of(piece, "doc_id"), "toxic": texts_of(piece, "toxic"), "terms": pa.array(packed, pa.binary())})

    kind = joined.schema["doc_id"].dataType.simpleString()
    found = joined.mapInArrow(hashed, f"doc_id {kind}, toxic int, terms binary")
    taken = sorted((r["doc_id"], bytes(r["terms"]), r["toxic"]) for r in found.toLocalIterator())
    labels_of = np.array([t for _, _, t in taken], np.float64)
    each = [np.frombuffer(b, "<i4") for _, b, _ in taken]
    sizes = np.array([len(e) for e in each], np.int64)
    numbers = np.repeat(np.arange(len(each), dtype=np.int32), sizes)
    return labels_of, numbers, np.concatenate(each) if each else np.zeros(0, np.int32)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column | bool = True, sample: tuple[int, int] = SAMPLE) -> Machine:
    """A machine learned from the labels in `labels` (doc_id, toxic 0 or 1).

    `may_learn` is a condition on doc_id. At most `sample[label]` rows of a label are
    used; their hashed terms come to the driver, so that number bounds its memory. A doc_id that
    is labelled twice counts as toxic if one label says so; null or other labels are left
    out.
    """
    condition = may_learn if isinstance(may_learn, Column) else F.lit(may_learn)
    marked = labelled(labels, condition)
    machine = train(*labelled_terms(docs, marked, sample))
    rows = {r["toxic"]: min(r["n"], 10**9) for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = rows.get(0, 0), rows.get(1, 0)
    # The sample may hold more toxic rows than their share; the bias is set right for that.
    machine.bias += np.log((toxic + 1) / (clean + 1)) - np.log((min(toxic, sample[1]) + 1) / (min(clean, sample[0]) + 1))
    return machine


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score (0 to 1) of every row, from its whole text alone.

    A null or empty text has no terms and gets the bias of the machine. Rows are scored
    one by one: repeated rows stay, an empty table gives an empty result, other columns
    are ignored. No shuffle; the machine, of at most TERMS terms, goes along with the task.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = machine.numbers()
        for batch in batches:
            for piece in chunks(batch):
                words = Words(texts_of(piece), lower=True)
                rows, found = distinct_terms(words, keep)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": texts_of(piece, "doc_id"),
                    "score": pa.array(machine.scores(rows, found, len(piece)), pa.float64()),
                })

    rows = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that score below `threshold`."""

    def keep(texts: pa.Array) -> np.ndarray:
        rows, found = distinct_terms(Words(texts, lower=True), machine.numbers())
        return machine.scores(rows, found, len(texts)) < threshold

    return rows_kept(docs, keep)
