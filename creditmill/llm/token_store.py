"""Token ids in seekable zstandard files.

A file holds the ids of a range of documents in ascending doc_id order. It is a row of
independent zstandard frames, each with some whole documents, and ends with the seek
table of the zstandard seekable format: sizes and an XXH64 checksum per frame, in a
skippable frame. A reader takes the seek table from the end of the file and decompresses
only the frames it needs.

A frame's content, little-endian: number of documents (uint32), ids per document
(uint32 each), then all ids (uint32 each).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmill.llm.pretokens import Pretokenizer, gather, split_words
from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import chunks, memory_returned, texts_of
from creditmill.operators.materialize import batches_within, checkpoint_root, computed_once

END_ID = 1
# Text bytes per file, and ids per frame, about; a document is never split.
FILE_BYTES = 32 << 20
FRAME_IDS = 128 * 1024
LEVEL = 3
# Text bytes encoded together.
CHUNK_BYTES = 2 << 20
# Bytes in one Arrow batch of documents, about: a little less than four chunks, so that no
# small chunk is left over.
BATCH_BYTES = 15 << 19
# Different pre-tokens a task keeps.
KEPT_PIECES = 300_000
# Fixed values of the seekable format: magic numbers, and the flag for checksums.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80


def open_store(path: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes frames, then the seek table."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.entries = stream, []
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, counts: np.ndarray, ids: np.ndarray) -> None:
        raw = struct.pack("<I", len(counts)) + counts.astype("<u4").tobytes() + ids.astype("<u4").tobytes()
        data = self.compressor.compress(raw)
        self.stream.write(data)
        self.entries.append((len(data), len(raw), checksum(raw)))

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *e) for e in self.entries)
        body += struct.pack("<IBI", len(self.entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.stream.close()


class FrameReader:
    """Reads single frames by the seek table of a file."""

    def __init__(self, path: str):
        store, name = open_store(path)
        self.path, self.file = path, store.open_input_file(name)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError(f"{path} does not end with a seek table with checksums")
        table = np.frombuffer(self.file.read_at(12 * count, size - 9 - 12 * count), "<u4").reshape(count, 3)
        self.sizes, self.sums = table[:, :2].astype(np.int64), table[:, 2]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))

    def read(self, frame: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids per document and all ids of a frame, after its checksum agreed."""
        import zstandard

        data = self.file.read_at(int(self.sizes[frame, 0]), int(self.starts[frame]))
        raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.sizes[frame, 1]))
        if checksum(raw) != self.sums[frame]:
            raise ValueError(f"{self.path}: frame {frame} does not agree with its checksum")
        (n,) = struct.unpack_from("<I", raw)
        return np.frombuffer(raw, "<u4", n, 4), np.frombuffer(raw, "<u4", offset=4 + 4 * n)


class Encoder:
    """Ids of texts; the library encodes every different pre-token of a task once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.split = Pretokenizer(path)
        # The library's model over ready pre-tokens, which hold no white space.
        self.library = Tokenizer(self.split.library.model)
        self.library.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.split.spec["model"]["end_of_word_suffix"]
        self.split.spec = None  # the parsed file is not needed any more
        self.closing = np.zeros(self.library.get_vocab_size(), bool)
        self.closing[[i for t, i in self.library.get_vocab().items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.plain, self.odd = pa.array([], pa.large_string()), {}
        # Of the known pre-tokens: places in `sizes` of the plain ones, sizes, ids.
        self.plain_at, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def pieces(self, plain: pa.Array, odd: list[str | int]) -> np.ndarray:
        """Place of each pre-token in `sizes`, after new ones were added there."""
        if len(self.sizes) > KEPT_PIECES:
            self.forget()
        at = pc.fill_null(pc.index_in(plain, value_set=self.plain), -1).to_numpy()
        fresh = (at < 0) & pc.not_equal(plain, "\n").to_numpy(zero_copy_only=False)
        places = np.zeros(len(plain), np.int64)
        places[at >= 0] = self.plain_at[at[at >= 0]]
        places[fresh] = len(self.sizes) + np.arange(int(fresh.sum()))
        new = plain.filter(pa.array(fresh))
        self.plain = pa.concat_arrays([self.plain, new])
        self.plain_at = np.concatenate((self.plain_at, places[fresh]))
        others = [p for p in odd if p not in self.odd]
        strings, special = [p for p in others if isinstance(p, str)], [p for p in others if isinstance(p, int)]
        self.odd.update(zip(strings + special, range(len(self.sizes) + len(new), len(self.sizes) + len(new) + len(others))))
        text = " ".join([self.split.all_mapped(new), *strings])
        if text:
            encoded = self.library.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, np.uint32)
            # A pre-token ends with the one of its tokens that closes a word.
            self.sizes = np.concatenate((self.sizes, np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)))
            self.flat = np.concatenate((self.flat, ids))
        self.sizes = np.concatenate((self.sizes, np.ones(len(special), np.int64)))
        self.flat = np.concatenate((self.flat, np.array(special, np.uint32)))
        return np.concatenate((places, np.array([self.odd[p] for p in odd], np.int64)))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text and all ids; each text is closed by `end`."""
        first, codes, words = split_words(texts)
        owner, pieces, plain, odd = self.split.cut(words)
        places = self.pieces(plain, odd)[pieces]
        own = self.sizes[places]
        flat = gather(self.flat, (np.cumsum(self.sizes) - self.sizes)[places], own)
        sizes = np.bincount(owner, own, minlength=len(words)).astype(np.int64)
        each = sizes[codes]
        before = np.concatenate(([0], np.cumsum(each)))
        counts = before[first[1:]] - before[first[:-1]] + 1
        ids = np.full(int(counts.sum()), end, np.uint32)
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(counts) - 1] = False
        ids[inside] = gather(flat, (np.cumsum(sizes) - sizes)[codes], each)
        return counts, ids


def write_tokens(docs: DataFrame, vocabulary: str, root: str, end: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Store the ids of all texts under `root`; one row per frame: shard, file, frame,
    before (ids of the shard in front of it), n_ids, docs (doc_ids in order).

    Documents are ranged by doc_id (a missing one first), equal doc_ids by a hash of
    their text, so reruns store the same order. A null text counts as empty and has the
    end id alone. An empty table stores no file. Each attempt of a task writes a file
    name of its own, and only files of finished tasks are in the result, so lost executors
    and repeated tasks do no harm. Other columns are ignored.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(8, -(-size // FILE_BYTES))
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(files, "doc_id", "tie")
    ranged = ranged.sortWithinPartitions("doc_id", "tie").select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = [("shard", pa.int32()), ("file", pa.string()), ("frame", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64())]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = path = None
        before = held = 0
        doc_ids: list = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def frame(shard: int) -> pa.RecordBatch:
            nonlocal before, held
            writer.add(np.concatenate(counts), np.concatenate(ids))
            docs = pa.concat_arrays(doc_ids)
            columns = [pa.array([v], t) for v, (_, t) in zip((shard, path, len(writer.entries) - 1, before, held), fields)]
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs))
            before, held = before + held, 0
            for kept in (doc_ids, counts, ids):
                kept.clear()
            return pa.RecordBatch.from_arrays(columns, [n for n, _ in fields] + ["docs"])

        shard = 0
        for batch in batches:
            for piece in chunks(batch, limit=chunk_bytes):
                if writer is None:
                    shard = piece.column("shard")[0].as_py()
                    path = f"{root}/ids-{shard:06d}-{uuid.uuid4().hex}.zst"
                    store, name = open_store(path)
                    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    encoder, writer = Encoder(vocabulary), FrameWriter(store.open_output_stream(name, compression=None))
                n, own = encoder.encode(texts_of(piece), end)
                total, at, start = np.cumsum(n), 0, 0
                while at < len(n):  # whole documents, up to the size of a frame
                    stop = max(at + 1, int(np.searchsorted(total, start + FRAME_IDS - held, "right")))
                    doc_ids.append(texts_of(piece, "doc_id").slice(at, stop - at))
                    counts.append(n[at:stop])
                    ids.append(own[start : total[stop - 1]])
                    held += int(total[stop - 1]) - start
                    at, start = stop, int(total[stop - 1])
                    if held >= FRAME_IDS or at < len(n):
                        yield frame(shard)
            batch = piece = own = None
            memory_returned()
        if writer is not None:
            if counts:
                yield frame(shard)
            writer.close()
        encoder = writer = None
        memory_returned()

    return ranged.mapInArrow(write, f"shard int, file string, frame int, before bigint, n_ids bigint, docs array<{kind}>")


def read_tokens(frames: DataFrame, wanted: DataFrame | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of stored documents, out of their files.

    `start` is the number of ids of all documents before; with `with_ids` the ids come as
    an array. `wanted` is a table of doc_ids: then only frames that hold one are read.
    """
    shards = frames.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("_ids").over(ahead), F.lit(0)).alias("_start"))
    kind = frames.schema["docs"].dataType.elementType.simpleString()
    if wanted is not None:
        ids = pick(wanted, "doc_id").distinct()
        held = frames.select("file", "frame", F.explode("docs").alias("_doc"))
        hit = held.join(ids, held["_doc"].eqNullSafe(ids["doc_id"]), "left_semi").select("file", "frame").distinct()
        frames = frames.join(hit, ["file", "frame"], "left_semi")
    placed = frames.join(F.broadcast(shards), F.col("shard") == F.col("_shard")).select(
        "file", "frame", (F.col("_start") + F.col("before")).alias("start"), "docs"
    )
    # The index is small and lies in few files; spread, its frames are read by all tasks.
    n = max(8, placed.sparkSession.sparkContext.defaultParallelism * 4)
    spread = placed.repartition(n, "file", "frame")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            for i, row in enumerate(batch.select(["file", "frame", "start"]).to_pylist()):
                if reader is None or reader.path != row["file"]:
                    reader = FrameReader(row["file"])
                counts, ids = reader.read(row["frame"])
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                data = memoryview(ids.tobytes())
                columns = {
                    "doc_id": batch.column("docs")[i].values,
                    "start": pa.array(row["start"] + starts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(starts, ends)], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.LargeListArray.from_arrays(np.append(starts, ends[-1:]), pa.array(ids.astype(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    more = ", ids array<bigint>" if with_ids else ""
    result = spread.mapInArrow(read, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint{more}")
    if wanted is not None:
        result = result.join(ids.select(F.col("doc_id").alias("_id")), result["doc_id"].eqNullSafe(F.col("_id")), "left_semi")
    return result


def store_tokens(docs: DataFrame, vocabulary: str, end: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The index of the documents' ids, stored in the shared folder of the session. Smaller
    chunks, and batches with them, take less memory and more time for the same ids."""
    root = f"{checkpoint_root(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    with batches_within(docs.sparkSession, BATCH_BYTES * chunk_bytes // CHUNK_BYTES):
        return computed_once(write_tokens(docs, vocabulary, root, end, chunk_bytes))
