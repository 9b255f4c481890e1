"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every part of the corpus sends, to the owner of each range of the fingerprint space,
the sorted distinct fingerprints it has there, as Golomb-Rice coded gaps. An owner
decodes its lists and answers each with a bitmap of those that another part has too.
Only rows whose fingerprint is marked, or repeats within its part, are suspects: their
texts alone are shuffled, and compared byte for byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.bitcodes import golomb_decode, golomb_encode, pack, rice_parameter, unpack
from creditmill.llm.tables import SPACE, pick, text_of
from creditmill.operators.dims import BROADCAST_LIMIT_BYTES
from creditmill.operators.materialize import computed_once

# Fingerprints one part sends and one owner receives, about.
PART_ROWS = 250_000
LEAST_PARTS = 64
# Hash set entry of a broadcast fingerprint.
PRINT_BYTES = 48


def by_owner(prints: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of sorted fingerprints: each owner has an equal range of their high half."""
    owner = ((prints >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    cuts = np.searchsorted(owner, np.arange(owners + 1, dtype=np.uint64))
    for i in np.flatnonzero(np.diff(cuts)):
        yield int(i), prints[cuts[i] : cuts[i + 1]]


def range_start(owner: int, owners: int) -> np.uint64:
    return np.uint64((-(-(owner << 32) // owners)) << 32)


def send_lists(owners: int):
    schema = pa.schema([("owner", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("code", pa.binary())])

    def send(table: pa.Table) -> pa.Table:
        prints = np.unique(table.column("h").to_numpy().view(np.uint64))
        part, rows = table.column("part")[0].as_py(), []
        for owner, own in by_owner(prints, owners):
            k = rice_parameter(2.0**64 / owners / len(own))
            rows.append((owner, part, len(own), k, golomb_encode(own - range_start(owner, owners), k)))
        return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return send, "owner bigint, part bigint, n bigint, k bigint, code binary"


def answer_lists(owners: int):
    schema = pa.schema([("part", pa.int64()), ("owner", pa.int64()), ("bitmap", pa.binary())])

    def answer(table: pa.Table) -> pa.Table:
        lists = table.to_pylist()
        decoded = [golomb_decode(r["code"], r["n"], r["k"]) for r in lists]
        values, counts = np.unique(np.concatenate(decoded), return_counts=True)
        shared = values[counts > 1]
        rows = []
        for r, own in zip(lists, decoded):
            flags = np.isin(own, shared, assume_unique=True)
            if flags.any():
                rows.append({"part": r["part"], "owner": r["owner"], "bitmap": pack(flags)})
        return pa.Table.from_pylist(rows, schema)

    return answer, "part bigint, owner bigint, bitmap binary"


def apply_bitmaps(owners: int):
    def apply(rows: pa.Table, bitmaps: pa.Table) -> pa.Table:
        prints, counts = np.unique(rows.column("h").to_numpy().view(np.uint64), return_counts=True)
        marks = {r["owner"]: r["bitmap"] for r in bitmaps.to_pylist()}
        suspect, at = counts > 1, 0
        for owner, own in by_owner(prints, owners):
            if owner in marks:
                suspect[at : at + len(own)] |= unpack(marks[owner], len(own))
            at += len(own)
        return pa.table({"h": prints[suspect].view(np.int64)})

    return apply, "h bigint"


def duplicated_prints(prints: DataFrame, rows: int) -> DataFrame:
    """The distinct fingerprints `h` that more than one row of (part, h) has."""
    count = max(LEAST_PARTS, -(-rows // PART_ROWS))
    parts = prints.select(F.pmod("part", F.lit(count)).cast("bigint").alias("part"), "h")
    send, sent = send_lists(count)
    answer, answered = answer_lists(count)
    apply, found = apply_bitmaps(count)
    lists = parts.groupBy("part").applyInArrow(send, sent)
    bitmaps = lists.groupBy("owner").applyInArrow(answer, answered)
    return parts.groupBy("part").cogroup(bitmaps.groupBy("part")).applyInArrow(apply, found).distinct()


def exact_dedup(docs: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of `docs`.

    Texts are equal when they are identical after each run of white space is replaced by
    one space; a null text counts as empty. The smallest doc_id of a group stays. Rows
    that repeat both doc_id and text are all marked kept, and all counted in group_size;
    a row without doc_id stays only if no row of its group has one. An empty table gives
    an empty result. Other columns are ignored. Copies need no salting: within a part a
    text is sent once, and the comparison aggregates each task's copies before its
    shuffle.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", F.regexp_replace(text_of(), SPACE, " ").alias("plain"))
    rows = rows.select("doc_id", "plain", F.xxhash64("plain").alias("h"))
    prints = computed_once(
        rows.select("doc_id", "h", F.sha2("plain", 256).alias("text_sha256"), F.spark_partition_id().alias("part"))
    )
    shared = computed_once(duplicated_prints(prints, prints.count()))
    if shared.count() * PRINT_BYTES <= broadcast_limit:
        shared = F.broadcast(shared)
    groups = (
        rows.join(shared, "h", "left_semi")
        .groupBy("h", "plain")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("plain", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    joined = prints.join(computed_once(groups), "text_sha256", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )
