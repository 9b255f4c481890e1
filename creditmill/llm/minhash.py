"""Near duplicates by circulant MinHash.

A signature has two permutations only. The first scatters the shingles of a text over
32 bits; coordinate k is the least value of the second over the scattered shingles
shifted by k in a circle. Texts with one set of shingles are one class. Classes that
agree in all coordinates of a band are compared by their signatures in groups of bounded
size, and pairs that may be similar are verified on the full sets.

No group is expanded into all its pairs: a group first gives the heaviest spanning forest
of its signature similarities. Once these pairs are verified and joined to components,
only links between different components are left to find, and only such links leave a
group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.components import connected_components
from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import BASES, Words, chunks, mixed, sequence_hashes, texts_of, windows
from creditmill.operators.dims import broadcast_if_small
from creditmill.operators.materialize import computed_once

SHINGLE = 5
SIMILARITY = 80  # per cent
# A pair of similarity 0.8 shares no band with probability (1 - 0.8^6)^40 < 1e-5.
BANDS, BAND_ROWS = 40, 6
COORDINATES = BANDS * BAND_ROWS
# Standard deviations that a pair's signatures may fall short of its similarity.
SLACK = 4.5
# Members of a group: above the first number it is split by the next band, above the
# second by chance; and of a block where all of a group meet all others.
SPLIT_ABOVE, HOT_ABOVE, BLOCK = 256, 2048, 512
# Shingles of a block, about.
BLOCK_SHINGLES = 1_000_000

_SPREAD, _STIR = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_SHIFTS = (np.arange(COORDINATES, dtype=np.uint32) * _SPREAD)[:, None]


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    hashes = words.hashes(BASES[0])
    at = windows(words, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    starts = np.concatenate((at, words.first[short]))
    ends = np.concatenate((at + size, words.first[short + 1]))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    found = sequence_hashes(hashes, starts, ends, BASES[0])
    cuts = np.searchsorted(starts, words.first)
    return [np.unique(found[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low byte of each coordinate."""
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    scattered = (mixed(shingles) >> np.uint64(32)).astype(np.uint32) * _SPREAD
    for at in range(0, len(scattered), 512):
        # The second permutation of (x + k): its first multiplication is spread over both.
        x = scattered[at : at + 512] + _SHIFTS
        x ^= x >> np.uint32(15)
        x *= _STIR
        np.minimum(low, x.min(axis=1), out=low)
    low ^= low >> np.uint32(16)
    low *= np.uint32(0xC2B2AE35)
    return (low >> np.uint32(24)).astype(np.uint8)


def class_of(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest()


def text_prints(rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class and signature of each text."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                sets = shingle_sets(Words(texts_of(piece), lower=True))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": texts_of(piece, "doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "class": pa.array([class_of(s) for s in sets], pa.binary()),
                    "sig": pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                })

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(prints, f"doc_id {kind}, n_shingles bigint, class binary, sig binary")


def text_sets(rows: DataFrame) -> DataFrame:
    """class and shingle set (sorted 64-bit hashes) of each text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                found = shingle_sets(Words(texts_of(piece), lower=True))
                yield pa.RecordBatch.from_pydict({
                    "class": pa.array([class_of(s) for s in found], pa.binary()),
                    "shingles": pa.array([s.tobytes() for s in found], pa.binary()),
                })

    return rows.mapInArrow(sets, "class binary, shingles binary")


def least_equal(similarity: int) -> float:
    """Coordinates that two signatures of that similarity share at least."""
    share = similarity / 100
    return (share - SLACK * np.sqrt(share * (1 - share) / COORDINATES)) * COORDINATES


class Members:
    """The classes of a group: names, sizes, signatures, and component labels that merge."""

    def __init__(self, table: pa.Table):
        self.names = table.column("class").to_pylist()
        self.sizes = table.column("n_shingles").to_numpy()
        self.sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(table), COORDINATES)
        labels = table.column("label").to_pylist()
        place = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([place[label] for label in labels], np.int64)

    def likely(self, i: int, rest: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of `rest` in other components that i may be similar to, and how many
        coordinates they share with it."""
        small, large = np.minimum(self.sizes[rest], self.sizes[i]), np.maximum(self.sizes[rest], self.sizes[i])
        rest = rest[(self.labels[rest] != self.labels[i]) & (100 * small >= similarity * large)]
        equal = (self.sigs[rest] == self.sigs[i]).sum(axis=1)
        near = equal >= least_equal(similarity)
        return rest[near], equal[near]

    def join(self, i: int, j: int) -> None:
        self.labels[self.labels == self.labels[j]] = self.labels[i]


LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def links_table(pairs: list[tuple[bytes, bytes]]) -> pa.Table:
    both = [(min(p), max(p)) for p in pairs]
    return pa.Table.from_arrays([pa.array([a for a, _ in both], pa.binary()), pa.array([b for _, b in both], pa.binary())], schema=LINKS)


def likely_forest(similarity: int):
    """The heaviest spanning forest of a group by its signatures."""

    def forest(table: pa.Table) -> pa.Table:
        members = Members(table)
        left, right, same = [], [], []
        for i in range(len(table) - 1):
            rest, equal = members.likely(i, np.arange(i + 1, len(table)), similarity)
            left.append(np.full(len(rest), i))
            right.append(rest)
            same.append(equal)
        if not left:
            return links_table([])
        left, right, same = np.concatenate(left), np.concatenate(right), np.concatenate(same)
        pairs = []
        for k in np.argsort(-same, kind="stable").tolist():
            i, j = int(left[k]), int(right[k])
            if members.labels[i] != members.labels[j]:
                members.join(i, j)
                pairs.append((members.names[i], members.names[j]))
        return links_table(pairs)

    return forest


def similar(one: np.ndarray, two: np.ndarray, similarity: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= similarity * (len(one) + len(two) - both)


def exact_links(similarity: int):
    """Links between the components of a group, verified on the full sets, until none is
    left: at most one less than components. Of a pair that shares several bands only the
    first one's group takes care."""

    def links(table: pa.Table) -> pa.Table:
        members = Members(table)
        bands = members.sigs.reshape(len(table), BANDS, BAND_ROWS)
        sets = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
        side, band = table.column("side").to_numpy(), table.column("band")[0].as_py()
        crossed = side.any()  # two blocks meet: pairs lie between them
        pairs = []
        for i in range(len(table) - 1):
            rest = np.arange(i + 1, len(table))
            rest, equal = members.likely(i, rest[side[rest] != side[i]] if crossed else rest, similarity)
            rest = rest[np.argsort(-equal, kind="stable")]
            rest = rest[~(bands[rest, :band] == bands[i, :band]).all(axis=2).any(axis=1)]
            for j in rest.tolist():
                if members.labels[i] != members.labels[j] and similar(sets[i], sets[j], similarity):
                    members.join(i, j)
                    pairs.append((members.names[i], members.names[j]))
        return links_table(pairs)

    return links


def sets_of(nodes: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """class, shingles of the classes in `nodes`, from one text of each."""
    ids = computed_once(classes.join(nodes, "class", "left_semi").select("rep").distinct())
    wanted = rows.join(broadcast_if_small(ids), F.col("doc_id") == F.col("rep"), "left_semi")
    return computed_once(text_sets(wanted).dropDuplicates(["class"]))


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar: 100 * common >= similarity * all."""
    sets = sets_of(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), classes, rows)
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("_one"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("_two"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "_one", "_two")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("_one"), batch.column("_two")):
                good.append(similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(compare, "a binary, b binary")


def band_key(band: Column) -> Column:
    return F.substring(F.col("sig"), band * BAND_ROWS + 1, F.lit(BAND_ROWS))


def near_components(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs`.

    The set of a text holds its distinct runs of five words, A-Z lower-cased; with fewer
    words the whole text is one run. Texts are linked if common shingles are at least
    `similarity` per cent of all shingles of both, confirmed on the full sets (64-bit
    hashes). component_id is the smallest doc_id that links reach, kept says that it is the
    row's own. A null or empty text has an empty set and is linked with nothing; a row
    without doc_id takes no part, has no component and is kept. Rows that repeat a doc_id
    are texts of their own. An empty table gives an empty result. Other columns are ignored.

    Every link between texts counts that shares a band, which links at the limit miss with
    the probability stated at BANDS.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    prints = computed_once(text_prints(rows))
    real = prints.where("doc_id is not null and n_shingles > 0")
    classes = computed_once(
        real.groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    )
    exploded = classes.select("class", F.posexplode(F.array(*[F.xxhash64(F.lit(b), band_key(F.lit(b))) for b in range(BANDS)])).alias("band", "bucket"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = computed_once(exploded.join(shared, "bucket").select("class", "band", "bucket", "members"))
    rows = rows.where("doc_id is not null")

    # First the forests of small groups: large buckets are split by their next band, and
    # what is still large by chance, another way in each band.
    placed = members.join(classes.select("class", "sig", "n_shingles"), "class")
    following = F.pmod(F.xxhash64(band_key((F.col("band") + 1) % BANDS)), F.ceil(F.col("members") / (SPLIT_ABOVE / 2)))
    by_chance = F.pmod(F.xxhash64("class", "band"), F.ceil(F.col("members") / HOT_ABOVE))
    small = F.when(F.col("members") <= SPLIT_ABOVE, F.col("bucket")).otherwise(F.xxhash64("bucket", following, by_chance))
    groups = placed.select(small.alias("group"), "class", F.col("class").alias("label"), "sig", "n_shingles")
    likely = groups.groupBy("group").applyInArrow(likely_forest(similarity), "a binary, b binary")
    links = computed_once(verified(computed_once(likely.distinct()), classes, rows, similarity))
    labels = connected_components(links)

    # Then all that may link different components, block against block with the full sets,
    # so that only links leave a group.
    labelled = members.join(labels, F.col("class") == F.col("node"), "left").select(
        "class", "band", "bucket", F.coalesce("label", "class").alias("label")
    ).join(classes.select("class", "sig", "n_shingles"), "class")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    open_buckets = labelled.groupBy("bucket").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), blocks.alias("_blocks")
    ).where("_low != _high").select("bucket", "_blocks")
    left = computed_once(labelled.join(open_buckets, "bucket"))
    left = left.join(sets_of(left.select("class").distinct(), classes, rows), "class")
    left = left.withColumn("_own", F.pmod(F.xxhash64("class"), "_blocks").cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    )
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(F.col("_own") < F.col("_other"), 1).when(F.col("_own") > F.col("_other"), 2).otherwise(0)
    meeting = left.select(
        F.xxhash64("bucket", low, high).alias("group"), "band", "class", "label", "sig", "n_shingles", "shingles", side.alias("side")
    )
    more = meeting.groupBy("group").applyInArrow(exact_links(similarity), "a binary, b binary")
    labels = connected_components(links.union(more))

    found = classes.join(labels, F.col("class") == F.col("node"), "left").select("class", "rep", F.coalesce("label", "class").alias("label"))
    found = computed_once(found)
    lowest = found.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = computed_once(found.join(lowest, "label").select("class", "component_id"))
    result = prints.join(found, "class", "left")
    taken = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(taken, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `docs`, with all their columns, but of each component only its smallest
    doc_id. Rows without doc_id stay. Rows that repeat doc_id and text stay once; rows that
    repeat a doc_id with other texts all stay if one of them does."""
    near = computed_once(near_components(docs, similarity))
    ids = near.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).where("doc_id is not null")
    ids = computed_once(ids.where("not kept or rows > 1"))
    names = docs.columns
    place = {n: ([i for i, c in enumerate(names) if c == n] or [i for i, c in enumerate(names) if c.lower() == n])[0] for n in ("doc_id", "text")}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{place['doc_id']}", f"c{place['text']}"
    dropped = ids.where("not kept").select(F.col("doc_id").alias("_id"))
    kept = plain.join(broadcast_if_small(dropped), F.col(key) == F.col("_id"), "left_anti")
    if not ids.where("kept").isEmpty():
        kept = kept.where(f"{key} is null").union(kept.where(f"{key} is not null").dropDuplicates([key, text]))
    return kept.toDF(*names)
