"""Language-model scores from a trigram backoff automaton that is spread over parts.

Training counts every trigram of the learning rows (two begin marks, the words, one end
mark). Smoothing is interpolated absolute discounting (discounts from counts of counts,
n1 / (n1 + 2 n2) per order) over the add-half unigram of the base score, whose unknown
class takes the mass left over. In backoff form each seen n-gram is an arc carrying
its interpolated log10 probability, and each history a state whose failure arc carries
log10 of its interpolation weight, which is exactly its backoff weight.

A traversal reads a text left to right; the state after two tokens is the longest suffix
that is a history of the model, so each step depends only on its trigram (h2, h1, w): take
the trigram's arc if there is one, else the failure arc of (h2, h1), then the bigram's arc,
else the failure arc of h1 and the unigram.

Texts are taken in chunks. A chunk asks for each of its distinct trigrams once, of the part
of h1, with what it counted of it in learning rows; the part adds up what all chunks counted
and answers with counts: of the trigram, its history, its bigram and h1. As each token but
the end is the h1 of one step and the begin mark that of one step a text, the counts of h1
are those of all words. An h1 with more steps than half a part, by a sample, is dealt by
(h1, h2) instead; its bigrams are asked for apart, by (h1, w). The sample moves trigrams
between parts and changes no result. What cannot be divided is one (h2, h1). The chunk's own
texts, as numbers, wait in the first exchange for the answers, which come by the second, and
are scored there as a whole. So what is exchanged follows the steps, however many parts there
are, and nothing but a few sums is sent to all.

A word is the low 64 bits of its XXH3-128 hash; 32 of the others go along with each h1, and
two words that differ in them under one hash raise an error. The words of the sample, up to
a fixed number, are known to all tasks, and go to the parts as their rank among these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import WORD, pick, text_of
from creditmill.llm.words import Cache, chunks, memory_returned, mixed, texts_of
from creditmill.operators.materialize import batches_within, computed_once

# Fixed values of the contract: remainder of crc32(doc_id) mod 5 that is held out.
FOLDS = 5
HELD_OUT = 1
HALF = 0.5

# Marks hold a space, which no word can.
BEGIN, END = " <s>", " </s>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bounds of a discount from counts of counts.
LEAST_DISCOUNT, MOST_DISCOUNT, PLAIN_DISCOUNT = 0.05, 0.95, 0.5

# Text bytes whose trigrams make a part, and that are split into words together, about.
PART_BYTES = 12 << 20
CHUNK_BYTES = 12 << 20
LEAST_PARTS = 8
# Text bytes of the sample that names frequent words, about, and how many it names at most.
SAMPLE_BYTES = 16 << 20
NAMED = 1 << 18
# Bits of a sort key; questions that go on together.
KEY_BITS = 63
ROWS = 32
# Trigrams that are scored at once.
BLOCK = 1 << 18

# A chunk's question to a part: its h1, the histories of each and the words behind each
# history, then the h1 and words of its bigrams; or, with n_docs, the chunk itself.
STEPS = "keys binary, checks binary, n_own int, own binary, numbers binary, h2 binary, w binary, held binary, n_docs int"
COUNTS = ("n", "v", "ones3", "twos3", "ones2", "twos2")
ANSWERS = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("source", pa.int32()), *((n, pa.binary()) for n in ("c3", "c2", "histories", "own", "pairs")),
    *((n, pa.int64()) for n in COUNTS), ("shared", pa.binary()),
])
ANSWERS_SQL = ("part int, chunk bigint, source int, c3 binary, c2 binary, histories binary, own binary, pairs binary, n bigint, v bigint, "
               "ones3 bigint, twos3 bigint, ones2 bigint, twos2 bigint, shared binary")
TOTALS = pa.schema([("rank", pa.int64()), ("total", pa.int64()), ("kinds", pa.int64()), *((n, pa.int64()) for n in COUNTS)])
TOTALS_SQL = "rank bigint, total bigint, kinds bigint, n bigint, v bigint, ones3 bigint, twos3 bigint, ones2 bigint, twos2 bigint"

_coders: dict[str, object] = Cache()


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def discount(ones: int, twos: int) -> float:
    if ones + 2 * twos == 0:
        return PLAIN_DISCOUNT
    return min(MOST_DISCOUNT, max(LEAST_DISCOUNT, ones / (ones + 2 * twos)))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte of as few bytes as the largest needs, compressed."""
    import zstandard

    coder = _coders.get("in") or _coders.setdefault("in", zstandard.ZstdCompressor(level=1))
    width = 0 if not len(values) else max(1, -(-int(values.max()).bit_length() // 8))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)[:, :width]
    return bytes([width]) + (coder.compress(np.ascontiguousarray(planes.T).tobytes()) if width else b"")


def unpacked(data: bytes) -> np.ndarray:
    """In 32 bits each where these do."""
    import zstandard

    coder = _coders.get("out") or _coders.setdefault("out", zstandard.ZstdDecompressor())
    if not data[0]:
        return np.zeros(0, np.int32)
    planes = np.frombuffer(coder.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    size = 4 if data[0] < 4 else 8
    out = np.zeros((planes.shape[1], size), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(f"<i{size}").ravel()


def hashes(words: list[str | bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Key and check of each word."""
    from xxhash import xxh3_128_digest

    halves = np.frombuffer(b"".join([xxh3_128_digest(w) for w in words]), ">u8").reshape(-1, 2)
    return halves[:, 1].astype(np.uint64), halves[:, 0].astype(np.uint64).astype(np.uint32)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each run of equal values, and the run of each place."""
    head = np.ones(len(values), bool)
    head[1:] = values[1:] != values[:-1]
    run = np.cumsum(head, dtype=np.int32)
    run -= 1
    return np.flatnonzero(head), run


def distinct_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each."""
    order = np.argsort(values)
    ordered = values[order]
    heads, run = runs(ordered)
    place = np.empty(len(values), np.int32)
    place[order] = run
    return ordered[heads], place


def agreed(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and the place of each; equal keys must have equal checks."""
    distinct, place = distinct_of(keys)
    first = np.empty(len(distinct), checks.dtype)
    first[place] = checks
    if (checks != first[place]).any():
        raise ValueError("two different tokens share a hash")
    return distinct, place


def joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays])


def ones_twos(counts: np.ndarray) -> tuple[int, int]:
    return int((counts == 1).sum()), int((counts == 2).sum())


class Frequent:
    """Frequent words by falling number, of a sample of the texts: their keys, and the
    number of shares that the trigrams of each as h1 are dealt to."""

    checks: np.ndarray | None = None

    def __init__(self, rows: DataFrame, size: int, parts: int):
        sample = rows.sample(min(1.0, SAMPLE_BYTES / max(1, size)), seed=1)
        tokens = sample.select(F.explode(F.concat(F.array(F.lit(BEGIN)), words_of(F.col("text")))).alias("t"))
        found = tokens.rollup("t").count().orderBy(F.desc("count"), F.asc_nulls_first("t")).limit(NAMED + 1).toArrow()
        # The first row is that of all tokens. The end mark is the h1 of none.
        numbers = np.append(found.column("count").to_numpy()[1:], 0)
        total = found.column("count")[0].as_py() or 1 if len(found) else 1
        self.keys, self.checks = hashes([*found.column("t").to_pylist()[1:], END])
        # More than half a part is shared out.
        self.shares = np.maximum(1, -(-2 * parts * numbers // total)).astype(np.int32)
        self.order = np.argsort(self.keys).astype(np.int32)

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each key; their number for one that is not among them."""
        if not len(self.keys):
            return np.zeros(len(keys), np.uint32)
        known = self.keys[self.order]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, self.order[at], len(known)).astype(np.uint32)

    def shares_of(self, ranks: np.ndarray) -> np.ndarray:
        """Of words by their rank; one that has none is not shared out."""
        return np.append(self.shares, 1)[np.minimum(ranks, len(self.keys))].astype(np.uint64)


class Grams:
    """The distinct trigrams of steps, ordered by h1, h2 and w: these three of each, the
    history of each, their places among the steps in order, and the trigram of each step."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray, n_words: int, bits: int = KEY_BITS):
        b = np.int64(max(1, (n_words - 1).bit_length()))
        mask = (np.int64(1) << b) - 1
        step = h1.astype(np.int64)
        step <<= b
        step |= h2
        pairs = None
        if 3 * b > bits:
            pairs, step = distinct_of(step)
            step = step.astype(np.int64)
        step <<= b
        step |= w
        self.order = np.argsort(step).astype(np.int32)
        step = step[self.order]
        self.heads, run = runs(step)
        self.place = np.empty(len(step), np.int32)
        self.place[self.order] = run
        del run
        step = step[self.heads]
        self.w = (step & mask).astype(np.int32)
        step >>= b
        self.first, self.history = runs(step)  # first trigram of each history
        if pairs is not None:
            step = pairs[step]
        self.h2 = (step & mask).astype(np.int32)
        step >>= b
        self.h1 = step.astype(np.int32)

    def counts(self, values: np.ndarray) -> np.ndarray:
        """Sum of the steps' values for each trigram."""
        return np.add.reduceat(values[self.order], self.heads, dtype=np.int64) if len(values) else values.astype(np.int64)


def deal_steps(parts: int, frequent: Frequent, chunk_bytes: int, schema: pa.Schema):
    """A function that cuts texts into steps: one row per chunk of texts and part it asks,
    and one for the chunk itself."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh3_64

        number, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for piece in chunks(batch, limit=chunk_bytes):
                steps = ChunkSteps(texts_of(piece), frequent)
                # A repeated task gives the same chunks only if it reads the same rows.
                content = xxh3_64(seed=(task << 24) + number)
                for part in (steps.keys, steps.sizes, steps.w):
                    content.update(np.ascontiguousarray(part))
                chunk = np.array([content.intdigest()], np.uint64).view(np.int64)[0]
                number += 1
                yield from steps.rows(int(chunk), piece, parts, frequent, schema)
                del steps
            batch = piece = None
            memory_returned()

    return deal


class ChunkSteps:
    """The steps of a chunk of texts, as places among its distinct tokens by rank."""

    def __init__(self, texts: pa.Array, frequent: Frequent):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.large_binary()).to_pylist()
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        if b"" in words:  # beside white space at an end of a text
            real = codes != words.index(b"")
            offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
            codes = codes[real]
            del real
        words += [BEGIN, END]
        del lists, coded
        keys, checks = hashes(words)
        del words
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two different tokens share a hash")
        ranks = frequent.ranks(keys)
        order = np.argsort(ranks, kind="stable")
        self.keys, self.checks, self.ranks = keys[order], checks[order], ranks[order].astype(np.int32)
        self.known = int((self.ranks < len(frequent.keys)).sum())
        if frequent.checks is not None and (self.checks[: self.known] != frequent.checks[self.ranks[: self.known]]).any():
            raise ValueError("two different tokens share a hash")
        place = np.empty(len(keys), np.int32)
        place[order] = np.arange(len(keys))
        self.begin, self.end = place[-2:].tolist()
        self.lay_out(place[codes], np.diff(offsets) + 1)
        self.route(self.keys)

    def lay_out(self, codes: np.ndarray, sizes: np.ndarray) -> None:
        """Tokens of the steps, from the words of the texts and the number of steps of each."""
        self.sizes, last = sizes, np.cumsum(sizes) - 1
        self.w = np.empty(int(sizes.sum()), np.int32)
        self.inside = np.ones(len(self.w), bool)
        self.inside[last] = False
        self.w[last], self.w[self.inside] = self.end, codes
        first = last - sizes + 1
        self.h1, self.h2 = np.empty_like(self.w), np.empty_like(self.w)
        self.h1[1:], self.h2[2:] = self.w[:-1], self.w[:-2]
        self.h1[first] = self.h2[first] = self.begin
        self.h2[(first + 1)[sizes > 1]] = self.begin

    def route(self, keys: np.ndarray) -> None:
        """What decides on the part of a word: 32 bits of its key."""
        self.way = keys.astype(np.uint64) & np.uint64(0xFFFFFFFF)

    @classmethod
    def read(cls, row: dict, frequent: Frequent) -> ChunkSteps:
        """The chunk from its own row; it has no checks, and 32 bits of each unnamed key."""
        self = cls.__new__(cls)
        ways, named = np.frombuffer(row["keys"], np.uint32), np.cumsum(unpacked(row["own"]))
        self.known, self.ranks = len(named), np.concatenate((named, np.full(len(ways), len(frequent.keys)))).astype(np.int32)
        numbers = unpacked(row["numbers"])
        self.begin, self.end = numbers[:2].tolist()
        self.lay_out(unpacked(row["w"]), numbers[2:])
        self.route(np.concatenate((frequent.keys[named], ways)))
        return self

    def asked(self, parts: int, frequent: Frequent) -> None:
        """Distinct trigrams, and bigrams of the h1 that are shared out, with the part of each."""
        self.grams = g = Grams(self.h1, self.h2, self.w, len(self.ranks))
        del self.h1, self.h2
        spread, count = np.uint64(0x9E3779B97F4A7C15), np.uint64(parts)
        self.shares = frequent.shares_of(self.ranks)
        part = (mixed(self.way.copy()) % count).astype(np.int32)[g.h1]
        self.some = np.flatnonzero((self.shares > 1)[g.h1])
        h1 = g.h1[self.some]
        share = mixed(self.way ^ spread)[g.h2[self.some]] % self.shares[h1]
        part[self.some] = mixed(self.way[h1] + (share + np.uint64(1)) * spread) % count
        # The trigrams of each part, in the order of rows.
        self.by_part = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable").astype(np.int32)
        self.starts = np.append(0, np.cumsum(np.bincount(part, minlength=parts)))
        b = np.int64(32)
        self.pairs, self.pair = distinct_of(h1.astype(np.int64) << b | g.w[self.some])
        a, w = self.pairs >> b, self.pairs & ((np.int64(1) << b) - 1)
        part = (mixed(mixed(self.way[a] ^ spread) + self.way[w]) % count).astype(np.int32)
        self.pairs_by_part = np.argsort(part, kind="stable")
        self.pair_starts = np.searchsorted(part[self.pairs_by_part], np.arange(parts + 1))

    def filled(self) -> list[int]:
        return np.flatnonzero(np.diff(self.starts) + np.diff(self.pair_starts)).tolist()

    def rows(self, chunk: int, piece: pa.Table, parts: int, frequent: Frequent, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple], docs: pa.Array) -> pa.RecordBatch:
            part, *others = zip(*rows)
            columns = [pa.array(part, pa.int32()), pa.array([chunk] * len(rows), pa.int64()), docs]
            return pa.RecordBatch.from_arrays(columns + [pa.array(c, t) for c, t in zip(others, schema.types[3:])], schema=schema)

        held = texts_of(piece, "held_out").to_numpy(zero_copy_only=False).astype(bool)
        ids = texts_of(piece, "doc_id")
        # Sent to where its answers will be sent.
        own = (home_of(chunk, parts), self.way[self.known :].astype(np.uint32).tobytes(), b"", 0, packed(np.diff(self.ranks[: self.known], prepend=0)),
               packed(np.concatenate(([self.begin, self.end], self.sizes))), b"", packed(self.w[self.inside]), np.packbits(held).tobytes(), len(self.sizes))
        yield batch([own], pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
        self.asked(parts, frequent)
        g, b = self.grams, np.int64(32)
        learned = g.counts(np.repeat((~held).view(np.int8), self.sizes)).astype(np.int32)
        of_pairs = np.bincount(self.pair, learned[self.some], len(self.pairs)).astype(np.int64)
        g.order = g.heads = g.place = None
        rows, names, none = [], len(frequent.keys), schema.field("docs").type
        at, seen = np.zeros(len(self.ranks), np.int32), np.zeros(len(self.ranks), np.uint8)
        at[: self.known] = self.ranks[: self.known]
        for p in self.filled():
            if len(rows) == ROWS:
                yield batch(rows, pa.nulls(len(rows), none))
                rows = []
            own, pair = self.by_part[self.starts[p] : self.starts[p + 1]], self.pairs_by_part[self.pair_starts[p] : self.pair_starts[p + 1]]
            h1, h2, w = g.h1[own], g.h2[own], g.w[own]
            a, pair_w = self.pairs[pair] >> b, self.pairs[pair] & ((np.int64(1) << b) - 1)
            first = runs(g.history[own])[0]
            heads, pair_heads = runs(h1[first])[0], runs(a)[0]
            own_h1, own_a = h1[first[heads]], a[pair_heads]
            # Unnamed tokens of the row: those that are an h1, then the others.
            n_own = int((own_h1 >= self.known).sum())
            rare = np.concatenate((h2[first], w, pair_w))
            rare = rare[rare >= self.known]
            seen[rare] = 1
            seen[own_h1] = 0
            others = rare[seen[rare] == 1]
            others = others[np.sort(np.unique(others, return_index=True)[1])]
            seen[rare] = 0
            tokens = np.concatenate((own_h1[len(own_h1) - n_own :], others))
            at[tokens] = names + np.arange(len(tokens))
            named = own_h1[: len(own_h1) - n_own]
            numbers = (np.diff(heads, append=len(first)), np.diff(first, append=len(own)), learned[own], np.diff(pair_heads, append=len(pair)), of_pairs[pair])
            rows.append((p, self.keys[tokens].tobytes(), self.checks[tokens[:n_own]].tobytes(), n_own,
                         b"".join(sized(packed(np.diff(x, prepend=0))) for x in (at[named], at[own_a])),
                         b"".join(sized(packed(x)) for x in numbers), packed(at[h2[first]]), packed(np.concatenate((at[w], at[pair_w]))), b"", 0))
        yield batch(rows, pa.nulls(len(rows), none))


def home_of(chunk: int, parts: int) -> int:
    """A number that is no part."""
    return parts + chunk % ((1 << 31) - 1 - parts)


def sized(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + data


def cut(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(unpacked(data[at + 4 : at + 4 + n]))
        at += 4 + n
    return out


class PartSteps:
    """What the chunks ask of a part: its distinct trigrams, and its own counts of these."""

    def __init__(self, table: pa.Table, frequent: Frequent, bits: int = KEY_BITS):
        columns = [f.split()[0] for f in STEPS.split(", ")]
        rows = [r for r in table.select(columns).to_pylist() if not r["n_docs"]]
        names = len(frequent.keys)
        each = [(*cut(r["own"]), *cut(r["numbers"])) for r in rows]
        h2, all_w = (joined([unpacked(r[c]) for r in rows], np.int32) for c in ("h2", "w"))
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        n_own = np.array([r["n_own"] for r in rows], np.int64)
        n_keys = np.array([len(k) for k in keys], np.int64)
        offsets = np.cumsum(n_keys) - n_keys
        # Keys of h1 come with checks, the others are compared where they are an h1.
        first = np.concatenate([np.arange(o, o + n) for o, n in zip(offsets, n_own)])
        keys = joined(keys, np.uint64)
        agreed(keys[first], joined([np.frombuffer(r["checks"], np.uint32) for r in rows], np.uint32))
        n_rows = len(rows)
        del rows, first
        self.keys, place = distinct_of(keys)
        del keys
        self.names, self.n_words = names, names + len(self.keys)

        def found(ids: np.ndarray, lengths: list[int]) -> np.ndarray:
            """Numbers of the part's tokens from those of the rows."""
            rare = np.flatnonzero(ids >= names)
            row = np.repeat(np.arange(n_rows, dtype=np.int32), lengths)[rare]
            ids[rare] = names + place[offsets[row] + ids[rare] - names]
            return ids

        # Of each row: h1, their histories, the trigrams of these, and the bigrams asked apart.
        unnamed = [names + np.arange(n) for n in n_own]
        own = found(np.concatenate([np.concatenate((np.cumsum(e[0]), u)) for e, u in zip(each, unnamed)]), [len(e[2]) for e in each]).astype(np.int32)
        self.n_own, self.n_histories, self.n_steps, self.n_pairs = ([len(e[k]) for e in each] for k in (2, 3, 4, 6))
        n2, n3, counted, pair_n, pair_counts = (joined([e[k] for e in each], np.int32) for k in range(2, 7))
        a = np.repeat(joined([np.cumsum(e[1]) for e in each], np.int64), pair_n)
        del each
        h2 = found(h2, self.n_histories)
        # The words of a row's trigrams, then of its pairs.
        lengths = np.stack((self.n_steps, self.n_pairs), axis=1).ravel()
        of_pairs = np.repeat(np.arange(2 * n_rows) % 2 == 1, lengths)
        all_w = found(all_w, lengths.reshape(-1, 2).sum(axis=1))
        w, pair_w = all_w[~of_pairs], all_w[of_pairs]
        del all_w, of_pairs
        self.asked_h1 = own
        h1 = np.repeat(np.repeat(own, n2), n3)
        self.asked_first = np.cumsum(n3) - n3  # first trigram of each history that is asked for
        h2 = np.repeat(h2, n3)
        del n2, n3
        grams = Grams(h1, h2, w, self.n_words, bits)
        del h1, h2, w
        self.trigram, self.history = grams.place, grams.history  # of each that is asked for, of each distinct one
        self.c3 = grams.counts(counted)
        del counted, grams.order, grams.heads
        self.ch2 = np.add.reduceat(self.c3, grams.first) if len(self.c3) else self.c3
        self.t2 = np.add.reduceat(self.c3 > 0, grams.first, dtype=np.int64) if len(self.c3) else self.c3
        b = np.int64(max(1, (self.n_words - 1).bit_length()))
        bigrams, self.bigram = distinct_of(grams.h1.astype(np.int64) << b | grams.w)
        del grams
        self.h1, self.w = bigrams >> b, bigrams & ((np.int64(1) << b) - 1)
        self.c2 = np.bincount(self.bigram, self.c3, len(bigrams)).astype(np.int64)
        self.ch1 = np.bincount(self.h1, self.c2, self.n_words).astype(np.int64)
        self.t1 = np.bincount(self.h1, self.c2 > 0, self.n_words).astype(np.int64)
        # Those of shared h1 are counted by the parts of their bigrams.
        self.alone = frequent.shares_of(self.h1) == 1
        self.asked_alone = frequent.shares_of(own) == 1
        pairs, self.pair = distinct_of(a << b | pair_w)
        self.pair_h1, self.pair_c2 = pairs >> b, np.bincount(self.pair, pair_counts, len(pairs)).astype(np.int64)

    def totals(self) -> tuple[dict[str, int], np.ndarray]:
        """Sums for the corpus; rank, number and number of different words of shared h1."""
        own = np.unique(self.h1[self.alone])
        ones3, twos3 = ones_twos(self.c3)
        ones2, twos2 = np.add(ones_twos(self.c2[self.alone]), ones_twos(self.pair_c2)).tolist()
        heads = runs(self.pair_h1)[0]
        shared = np.zeros((3, len(heads)), np.int64)
        if len(heads):
            shared[:] = self.pair_h1[heads], np.add.reduceat(self.pair_c2, heads), np.add.reduceat((self.pair_c2 > 0).astype(np.int64), heads)
        return {"n": int(self.ch1[own].sum()), "v": int((self.ch1[own] > 0).sum()), "ones3": ones3, "twos3": twos3, "ones2": ones2, "twos2": twos2}, shared


def answer_steps(parts: int, frequent: Frequent):
    """A function that adds up what the chunks counted, and answers each."""

    def answer(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part >= parts:  # a chunk itself
            return ANSWERS.empty_table()
        steps = PartSteps(table, frequent)
        sums, shared = steps.totals()
        trigram, c3, c2, alone = steps.trigram, steps.c3, steps.c2[steps.bigram], steps.alone[steps.bigram]
        c2 -= c3
        history = steps.history[steps.trigram[steps.asked_first]]
        ch2, t2 = steps.ch2[history], steps.t2[history]
        ch1, t1, own_alone = steps.ch1[steps.asked_h1], steps.t1[steps.asked_h1], steps.asked_alone
        pairs = steps.pair_c2[steps.pair]
        sizes = [np.cumsum([0, *n]) for n in (steps.n_steps, steps.n_histories, steps.n_own, steps.n_pairs)]
        del steps
        rows = []
        for i, chunk in enumerate(table.column("chunk").to_pylist()):
            of3, of2, of1, of_pairs = (slice(s[i], s[i + 1]) for s in sizes)
            known = own_alone[of1]
            own3 = trigram[of3]
            rows.append([home_of(chunk, parts), chunk, part, packed(c3[own3]), packed(c2[own3[alone[own3]]]),
                         b"".join(map(sized, (packed(ch2[of2] - t2[of2]), packed(t2[of2])))),
                         b"".join(map(sized, (packed((ch1[of1] - t1[of1])[known]), packed(t1[of1][known])))), packed(pairs[of_pairs]),
                         *sums.values(), shared.tobytes()])
            sums, shared = dict.fromkeys(sums, 0), shared[:, :0]
        del trigram, c3, c2, alone, history, ch2, t2, ch1, t1, pairs
        memory_returned()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), ANSWERS.types)], schema=ANSWERS)

    return answer


def add_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the parts' sums for the corpus: a row of rank -1, and one per word that is
    shared out."""
    sums, shared = [0] * len(COUNTS), [np.zeros((3, 0), np.int64)]
    for batch in batches:
        sums = [s + (pc.sum(batch.column(c)).as_py() or 0) for s, c in zip(sums, COUNTS)]
        shared += [np.frombuffer(d, np.int64).reshape(3, -1) for d in batch.column("shared").to_pylist() if d]
    rank, *numbers = np.concatenate(shared, axis=1)
    rank, place = distinct_of(rank)
    columns = [np.append(-1, rank), *(np.append(0, np.bincount(place, n, len(rank)).astype(np.int64)) for n in numbers)]
    columns += [np.append(s, np.zeros(len(rank), np.int64)) for s in sums]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=TOTALS)


def score_steps(parts: int, frequent: Frequent, schema: pa.Schema):
    """A function that walks the steps of chunks: the scores of their texts."""

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        if table.num_rows and table.column("part")[0].as_py() < parts:  # questions
            return schema.empty_table()
        chunks_, answering = table.column("chunk").to_pylist(), answers.column("chunk")
        if len(set(chunks_)) < len(chunks_) or set(answering.to_pylist()) - set(chunks_):
            raise ValueError("a chunk of texts was read twice and was not the same")
        names = [f.split()[0] for f in STEPS.split(", ")]
        for i, chunk in enumerate(chunks_):
            row = table.slice(i, 1)
            own = answers.filter(pc.equal(answering, chunk)).sort_by("source")
            values = row.select([*names, "shared", *COUNTS]).to_pylist()[0]
            out.append(pa.Table.from_arrays([texts_of(row, "docs").flatten(), *chunk_scores(values, own, parts, frequent)], schema=schema))
        memory_returned()
        return pa.concat_tables(out)

    return score


def chunk_scores(row: dict, answers: pa.Table, parts: int, frequent: Frequent) -> list[pa.Array]:
    steps = ChunkSteps.read(row, frequent)
    steps.asked(parts, frequent)
    g, names = steps.grams, len(frequent.keys)
    if answers.column("source").to_pylist() != steps.filled():
        raise ValueError("a chunk of texts was read twice and was not the same")

    def gathered(column: str, places: np.ndarray, size: int) -> np.ndarray:
        """The answers of all parts, put in their places."""
        return put([unpacked(v) for v in answers.column(column).to_pylist()], places, size)

    def put(values: list[np.ndarray], places: np.ndarray, size: int) -> np.ndarray:
        values = joined(values, np.int32)
        if len(values) != len(places):
            raise ValueError("a chunk of texts was read twice and was not the same")
        out = np.zeros(size, values.dtype)
        out[places] = values
        return out

    alone = steps.shares == 1
    c3 = gathered("c3", steps.by_part, len(g.w))
    c2 = gathered("c2", steps.by_part[alone[g.h1[steps.by_part]]], len(g.w))
    pairs = gathered("pairs", steps.pairs_by_part, len(steps.pairs))
    c2 = (c2 + c3).astype(np.promote_types(np.promote_types(c2.dtype, c3.dtype), pairs.dtype))
    c2[steps.some] = pairs[steps.pair]
    # A history lies in one part, and so does an h1 that is not shared out.
    first = steps.by_part[runs(g.history[steps.by_part])[0]]
    both = [cut(v) for v in answers.column("histories").to_pylist()]
    ch2, t2 = (put([v[k] for v in both], g.history[first], len(g.first)) for k in (0, 1))
    ch2 = ch2 + t2
    own = g.h1[first]
    own = own[runs(own)[0]]
    own = own[alone[own]]
    both = [cut(v) for v in answers.column("own").to_pylist()]
    ch1, t1 = (put([v[k] for v in both], own, len(steps.ranks)).astype(np.int64) for k in (0, 1))
    ch1 += t1
    del both, own, first, pairs, steps.by_part, steps.starts, steps.some, steps.pair
    h1, w, history = g.h1, g.w, g.history
    total, shared = {c: row[c] for c in COUNTS}, np.zeros((2, names), np.int64)
    for one in row["shared"]:
        shared[:, one["rank"]] = one["total"], one["kinds"]
    total["n"] += int(shared[0].sum())
    total["v"] += int((shared[0] > 0).sum())
    ch1[~alone], t1[~alone] = shared[:, steps.ranks[~alone]]
    # Each token but the end is an h1 once, and the begin mark stands for the end.
    c1 = ch1.copy()
    c1[steps.end] = ch1[steps.begin]
    d3, d2 = discount(total["ones3"], total["twos3"]), discount(total["ones2"], total["twos2"])
    p1 = (c1 + HALF) / (total["n"] + HALF * (total["v"] + 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        weight1, weight2 = d2 * t1 / ch1, d3 * t2 / ch2
        fail1, fail2 = np.where(ch1 > 0, np.log10(weight1), 0.0), np.where(ch2 > 0, np.log10(weight2), 0.0)
        lp = np.empty(len(w))
        for at in range(0, len(w), BLOCK):
            one = slice(at, at + BLOCK)
            a, b, h = h1[one], w[one], history[one]
            p2 = (c2[one] - d2) / ch1[a] + weight1[a] * p1[b]
            lower = np.where(c2[one] > 0, np.log10(p2), fail1[a] + np.log10(p1[b]))
            p3 = (c3[one] - d3) / ch2[h] + weight2[h] * p2
            lp[one] = np.where(c3[one] > 0, np.log10(p3), fail2[h] + lower)
    del c2, c3, ch2, t2, weight2, fail2, h1, w, history, g.h1, g.h2, g.w, g.history, g.order, g.heads
    n = len(steps.sizes)
    doc = np.repeat(np.arange(n), steps.sizes)
    known = np.bincount(doc, (c1 > 0)[steps.w], n).astype(np.int64)
    base, score = np.bincount(doc, np.log10(p1)[steps.w], n), np.bincount(doc, lp[g.place], n)
    held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=n).astype(bool)
    return [pa.array(v) for v in (held, steps.sizes.astype(np.int64), known, np.full(n, total["n"], np.int64), base, score)]


def backoff_scores(
    documents: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, part_bytes: int = PART_BYTES, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per row.

    Texts are lower-cased in A-Z only and split into words of non-space characters; an
    end mark follows, counted as a token, so an empty or null text has one token. Rows
    whose crc32(doc_id as text) mod `folds` is `held_out` are scored but not learned from;
    a null doc_id learns. Repeated rows are each scored and each learned from. Unseen
    tokens share the add-half unigram's unknown class; with no training row at all both
    scores are 0 (N = V = 0: the unknown class holds all the mass). Other columns are ignored.
    `score` is the model's log10 probability of the text, end included.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = pick(documents, "doc_id", "text").select("doc_id", text_of().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-size // part_bytes))
    frequent = Frequent(rows, size, parts)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_out, F.lit(False))
    kind = rows.schema["doc_id"].dataType
    ids = to_arrow_type(kind)
    binary, i32, i64 = pa.binary(), pa.int32(), pa.int64()
    dealt = pa.schema([("part", i32), ("chunk", i64), ("docs", pa.list_(ids))] + [
        (f.split()[0], binary if f.endswith("binary") else i32) for f in STEPS.split(", ")])
    result = pa.schema([("doc_id", ids), ("held_out", pa.bool_()), ("n_tokens", i64), ("n_known", i64), ("train_tokens", i64), ("base_score", pa.float64()), ("score", pa.float64())])
    name = kind.simpleString()

    # Two shuffles, each read twice: what is asked, by the parts and by the chunks that wait
    # in it; what is answered, for the corpus-wide sums and by the chunks.
    steps = rows.select("doc_id", "text", held.alias("held_out")).mapInArrow(
        deal_steps(parts, frequent, chunk_bytes, dealt), f"part int, chunk bigint, docs array<{name}>, {STEPS}").repartition(2 * parts, "part")
    answers = steps.groupBy("part").applyInArrow(answer_steps(parts, frequent), ANSWERS_SQL).repartition(2 * parts, "part")
    sums = answers.mapInArrow(add_totals, TOTALS_SQL).groupBy("rank").agg(*[F.sum(c).alias(c) for c in ("total", "kinds", *COUNTS)])
    sums = sums.agg(F.collect_list(F.when(F.col("rank") >= 0, F.struct("rank", "total", "kinds"))).alias("shared"), *[F.sum(c).alias(c) for c in COUNTS])
    # Only a chunk's own row has n_docs, and so gets the sums.
    chunks_ = steps.join(F.broadcast(sums.withColumn("waits", F.lit(True))), (F.col("n_docs") > 0) == F.col("waits"), "left")
    scores = chunks_.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        score_steps(parts, frequent, result), f"doc_id {name}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    with batches_within(documents.sparkSession, chunk_bytes):
        return computed_once(scores)
