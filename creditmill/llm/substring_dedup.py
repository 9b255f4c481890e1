"""Repeated passages, found exactly behind a count-min prefilter.

The texts are dealt to parts of some megabytes. Each part sketches its windows of words:
a window adds one to a cell in each of two rows of a count-min sketch. A part's sketch
goes, as sorted cells in Golomb code with a flag for cells met twice, to the owners of
ranges of cells. These add the sketches up and answer with a bitmap of the cells whose
sum is two or more. A sum is never below a window's true count, so only windows with two
such cells can repeat; their 128-bit digests are then grouped exactly, again by owner,
and a second bitmap tells each part which of its windows do.

Rows and ranges of the sketch grow with the number of windows, so the share of windows
that pass without repeating stays the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.bitcodes import golomb_decode, golomb_encode, pack, rice_parameter, unpack
from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import BASES, Words, chunks, mixed, sequence_hashes, texts_of, windows
from creditmill.operators.materialize import computed_once

WINDOW = 35
# Text bytes of a part, about, and the least number of parts.
PART_BYTES = 8 << 20
LEAST_PARTS = 32
# Cells of a sketch row per byte of text: about 8 per window.
CELLS_PER_BYTE = 1.25
ROWS = 2

EXCHANGE = pa.schema([("to", pa.int64()), ("part", pa.int64()), ("row", pa.int32()), ("n", pa.int64()), ("k", pa.int64()), ("code", pa.binary())])
EXCHANGE_SQL = "to bigint, part bigint, row int, n bigint, k bigint, code binary"


def message(to: int, part: int, row: int, n: int, k: int, code: bytes) -> dict:
    return {"to": to, "part": part, "row": row, "n": n, "k": k, "code": code}


class Passages:
    """Windows of a part: for each text chunk its words, window starts and window hashes."""

    def __init__(self, table: pa.Table, size: int):
        self.size, self.chunks = size, []
        for piece in chunks(table):
            words = Words(texts_of(piece))
            at = windows(words, size)
            first = sequence_hashes(words.hashes(BASES[0]), at, at + size, BASES[0])
            self.chunks.append((piece, words, at, first))
        self.first = np.concatenate([c[3] for c in self.chunks]) if self.chunks else np.zeros(0, np.uint64)

    def digests(self, chosen: np.ndarray) -> np.ndarray:
        """The second half of the 128-bit digests of the chosen windows."""
        out, before = [], 0
        for _, words, at, first in self.chunks:
            own = at[chosen[(chosen >= before) & (chosen < before + len(at))] - before]
            if len(own):
                out.append(sequence_hashes(words.hashes(BASES[1]), own, own + self.size, BASES[1]))
            before += len(at)
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def cells_of(first: np.ndarray, row: int, cells: int) -> np.ndarray:
    """The sketch cell of each window in a row: a power of two many."""
    return mixed(first ^ np.uint64((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)[row])) >> np.uint64(64 - cells.bit_length() + 1)


def slices(values: np.ndarray, parts: int, bits: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Sorted values below 2^bits, cut to `parts` (a power of two) equal ranges."""
    shift = bits - parts.bit_length() + 1
    cuts = np.searchsorted(values, np.arange(parts + 1, dtype=np.uint64) << np.uint64(shift)) if shift < 64 else [0, len(values)]
    if parts > 1 and bits == 64:  # the last border does not fit into 64 bits
        cuts[-1] = len(values)
    for i in range(parts):
        if cuts[i + 1] > cuts[i]:
            yield i, values[cuts[i] : cuts[i + 1]], int(cuts[i])


def sketch(size: int, cells: int, owners: int):
    """First message of a part: its cells and which of them it met twice."""
    bits = cells.bit_length() - 1

    def send(table: pa.Table) -> pa.Table:
        part, rows = table.column("part")[0].as_py(), []
        first = Passages(table, size).first
        for row in range(ROWS):
            values, counts = np.unique(cells_of(first, row, cells), return_counts=True)
            for owner, own, at in slices(values, owners, bits):
                start = np.uint64(owner << (bits - owners.bit_length() + 1))
                k = rice_parameter(cells / owners / len(own))
                code = golomb_encode(own - start, k)
                twice = pack(counts[at : at + len(own)] > 1)
                rows.append(message(owner, part, row, len(own), k, len(code).to_bytes(4, "little") + code + twice))
        return pa.Table.from_pylist(rows, EXCHANGE)

    return send


def add_sketches(cells: int, owners: int):
    """Answer of an owner: for each part, which of its cells sum up to two or more."""
    width = cells // owners

    def answer(table: pa.Table) -> pa.Table:
        rows = []
        lists = table.to_pylist()
        for row in range(ROWS):
            own = [r for r in lists if r["row"] == row]
            total = np.zeros(width, np.uint8)  # saturates at two
            decoded = []
            for r in own:
                split = 4 + int.from_bytes(r["code"][:4], "little")
                values = golomb_decode(r["code"][4:split], r["n"], r["k"]).astype(np.int64)
                total[values] = np.minimum(total[values] + 1 + unpack(r["code"][split:], r["n"]), 2)
                decoded.append(values)
            for r, values in zip(own, decoded):
                flags = total[values] > 1
                if flags.any():
                    rows.append(message(r["to"], r["part"], row, r["n"], 0, pack(flags)))
        return pa.Table.from_pylist(rows, EXCHANGE)

    return answer


def suspects(first: np.ndarray, answers: list[dict], cells: int, owners: int) -> np.ndarray:
    """Windows whose cells are marked in every row."""
    bits = cells.bit_length() - 1
    suspect = np.ones(len(first), bool)
    for row in range(ROWS):
        marks = {r["to"]: r["code"] for r in answers if r["row"] == row}
        values, inverse = np.unique(cells_of(first, row, cells), return_inverse=True)
        flags = np.zeros(len(values), bool)
        for owner, own, at in slices(values, owners, bits):
            if owner in marks:
                flags[at : at + len(own)] = unpack(marks[owner], len(own))
        suspect &= flags[inverse]
    return np.flatnonzero(suspect)


DIGEST = np.dtype([("a", "<u8"), ("b", "<u8")])


def distinct_digests(passages: Passages, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests of the chosen windows in order, the number of each, and the place
    of each chosen window among them."""
    pairs = np.empty(len(chosen), DIGEST)
    pairs["a"], pairs["b"] = passages.first[chosen], passages.digests(chosen)
    order = np.lexsort((pairs["b"], pairs["a"]))
    ordered = pairs[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, bool)
    place = np.empty(len(chosen), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], np.bincount(place, minlength=int(new.sum())), place


def send_suspects(size: int, cells: int, owners: int):
    """Second message of a part: digests of its suspects, and which it holds twice."""

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return pa.Table.from_pylist([], EXCHANGE)
        part, rows = table.column("part")[0].as_py(), []
        passages = Passages(table, size)
        chosen = suspects(passages.first, answers.to_pylist(), cells, owners)
        found, counts, _ = distinct_digests(passages, chosen)
        for owner, own, at in slices(found["a"], owners, 64):
            whole = found[at : at + len(own)]
            rows.append(message(owner, part, 0, len(own), 0, whole.tobytes() + pack(counts[at : at + len(own)] > 1)))
        return pa.Table.from_pylist(rows, EXCHANGE)

    return send


def group_suspects(table: pa.Table) -> pa.Table:
    """Answer of an owner: for each part, which of its digests occur twice anywhere."""
    lists = table.to_pylist()
    digests = [np.frombuffer(r["code"], DIGEST, r["n"]) for r in lists]
    joined = np.concatenate(digests)
    twice = np.concatenate([unpack(r["code"][16 * r["n"] :], r["n"]) for r in lists])
    order = np.lexsort((joined["b"], joined["a"]))
    ordered = joined[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    group = np.cumsum(new) - 1
    repeated = (np.bincount(group, 1 + twice[order]) > 1)[group]
    flags = np.empty(len(joined), bool)
    flags[order] = repeated
    rows, at = [], 0
    for r in lists:
        own = flags[at : at + r["n"]]
        at += r["n"]
        rows.append(message(r["to"], r["part"], ROWS, r["n"], 0, pack(own)))
    return pa.Table.from_pylist(rows, EXCHANGE)


def covered(words: Words, repeated: np.ndarray, size: int) -> np.ndarray:
    """Words inside a repeated window, by the windows' first words."""
    edge = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(edge, repeated, 1)
    np.subtract.at(edge, repeated + size, 1)
    return np.cumsum(edge[:-1]) > 0


def remove_passages(size: int, cells: int, owners: int, id_type: pa.DataType, with_text: bool):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = [("doc_id", id_type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        schema = pa.schema(out + ([("kept_text", pa.string())] if with_text else []))
        if not len(table):
            return schema.empty_table()
        marks = answers.to_pylist()
        passages = Passages(table, size)
        chosen = suspects(passages.first, [m for m in marks if m["row"] < ROWS], cells, owners)
        found, _, place = distinct_digests(passages, chosen)
        flags = np.zeros(len(found), bool)
        by_owner = {m["to"]: m["code"] for m in marks if m["row"] == ROWS}
        for owner, own, at in slices(found["a"], owners, 64):
            if owner in by_owner:
                flags[at : at + len(own)] = unpack(by_owner[owner], len(own))
        repeated = chosen[flags[place]]
        results, before = [], 0
        for piece, words, at, _ in passages.chunks:
            own = at[repeated[(repeated >= before) & (repeated < before + len(at))] - before]
            before += len(at)
            gone = covered(words, own, size)
            # Each kept word with the one byte of white space behind it, as a space.
            edge = np.zeros(len(words.bytes) + 1, np.int8)
            kept = ~gone
            edge[words.starts[kept]] += 1
            edge[words.ends[kept] + 1] -= 1
            keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
            bytes_ = words.bytes.copy()
            bytes_[words.ends] = 0x20
            data = memoryview(bytes_[keep].tobytes())
            cuts = np.concatenate(([0], np.cumsum(keep)))[words.offsets]
            texts = [data[a : max(a, b - 1)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            removed = np.concatenate(([0], np.cumsum(gone)))[words.first]
            columns = [
                texts_of(piece, "doc_id"), pa.array(words.counts, pa.int64()), pa.array(np.diff(removed), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ]
            if with_text:
                columns.append(pa.array([bytes(t) for t in texts], pa.binary()).cast(pa.string()))
            results.append(pa.Table.from_arrays(columns, schema=schema))
        return pa.concat_tables(results)

    return remove


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


def substring_dedup(docs: DataFrame, size: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (and kept_text) of every row of `docs`.

    Words are runs of other characters than white space, unchanged. Each word inside a
    window of `size` words goes whose words also start anywhere else, in the same document
    too; windows are judged on the input. The kept words are joined by one space. A null
    text counts as empty and has no words; texts with fewer than `size` words keep all.
    Rows that repeat, with or without the same doc_id, are documents of their own, so they
    lose all their windows. An empty table gives an empty result. Other columns are
    ignored. Two windows are the same if 128 bits of hash agree.

    Parts are dealt by a hash of doc_id and text, so no source or group of copies fills one,
    and a window is sent once per part, so a passage of all documents costs each owner one
    entry per part.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(LEAST_PARTS, -(-total // PART_BYTES))
    cells, owners = power_of_two(max(total * CELLS_PER_BYTE, 1 << 16)), power_of_two(count)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count))
    parts = rows.withColumn("part", part.cast("bigint"))
    by_part = parts.groupBy("part")
    first = by_part.applyInArrow(sketch(size, cells, owners), EXCHANGE_SQL).groupBy("to").applyInArrow(add_sketches(cells, owners), EXCHANGE_SQL)
    first = computed_once(first)
    second = by_part.cogroup(first.groupBy("part")).applyInArrow(send_suspects(size, cells, owners), EXCHANGE_SQL)
    second = second.groupBy("to").applyInArrow(group_suspects, EXCHANGE_SQL)
    answers = first.unionByName(computed_once(second))
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    remove = remove_passages(size, cells, owners, to_arrow_type(kind), with_text)
    more = ", kept_text string" if with_text else ""
    return by_part.cogroup(answers.groupBy("part")).applyInArrow(
        remove, f"doc_id {kind.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string{more}"
    )
