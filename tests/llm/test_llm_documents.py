"""Operators over documents against brute force, on odd rows, and on empty tables."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from creditmill.llm import decontaminate, minhash, mixing, queries, token_store
from creditmill.llm.bitcodes import golomb_decode, golomb_encode, pack, rice_parameter, unpack
from creditmill.llm.components import connected_components
from creditmill.llm.decontaminate import find_leaks, without_leaks
from creditmill.llm.exact_dedup import exact_dedup
from creditmill.llm.minhash import near_components, one_of_each
from creditmill.llm.mixing import mix_plan, mixed_documents, shard_quotas
from creditmill.llm.substring_dedup import substring_dedup
from creditmill.llm.token_counts import Merges, count_tokens
from creditmill.llm.token_store import FrameReader, read_tokens, store_tokens
from creditmill.llm.toxicity import fit, score_toxicity, without_toxic

# Further columns bear names that the operators use inside.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, part int, size string, "
    "label int, kept string, class string, `order` int, tie int, shard int, sig binary, _id int"
)
EXTRA = (7, 1, "s", 2, "k", "c", 3, 4, 5, b"x", 6)


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows], SCHEMA)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


LONG = prose(1, 60_000, 5_000)
PASSAGE = prose(2, 50)
ODD = [
    (1, "Same text  here", "a"), (2, "Same\ttext here", "a"), (3, "same text here", None), (4, None, "b"), (5, "", "b"),
    (6, " \n ", ""), (7, LONG, "c"), (8, prose(3, 60) + "\n" + PASSAGE, "c"), (9, PASSAGE + " " + prose(4, 60), "d"),
    (10, prose(5, 200), "d"), (11, prose(5, 200) + " tail", "e"), (12, "  Ünï cödé 日本語 \U0001f600 <|endoftext|>'s ", "e"),
    (13, "x", None), (13, "x", None), (14, "one id", "a"), (14, "two texts", "a"), (None, "no id", "f"), (None, "no id", "f"),
    (15, prose(6, 30) + " " + prose(6, 30), "g"), (16, "a " * 400, "g"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return made(spark, ODD).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return made(spark, [])


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def vocabulary():
    return queries.vocabulary()


# --- exact dedup


def test_exact_dedup_of_odd_rows(odd):
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(odd).collect()}
    assert {(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True)} <= found
    assert {(4, 4, 2, True), (5, 4, 2, False), (6, 6, 1, True)} <= found  # null and empty are equal, a space is not
    assert {(13, 13, 2, True), (14, 14, 1, True), (None, None, 2, True)} <= found
    assert exact_dedup(odd).count() == len(ODD)


def test_exact_dedup_without_broadcast_is_the_same(odd):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows_of(exact_dedup(odd, broadcast_limit=-1), *columns) == rows_of(exact_dedup(odd), *columns)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_golomb_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 50, n).astype(np.uint64))
    for k in (0, rice_parameter(2.0**50 / max(1, n)), 45):
        if k or not n:
            assert (golomb_decode(golomb_encode(values, k), len(values), k) == values).all()
    flags = values % np.uint64(3) == 0
    assert (unpack(pack(flags), len(flags)) == flags).all()


# --- mixing


def test_mix_targets_and_shares(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = mix_plan(docs).toPandas()
    per = plan.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    wanted = brute.targets(per["size"].to_dict())
    assert all(abs(per.target[s] - t) < 1e-6 for s, t in wanted.items())
    assert (abs(per.taken - per.target) <= 1).all()
    assert (plan.taken <= 2 * plan["size"]).all() and (plan.taken == plan.passes * plan["size"] + plan.cut_to - plan.cut_from).all()
    again = mix_plan(docs.repartition(5)).toPandas()
    key = ["doc_id", "taken", "passes", "cut_from", "cut_to"]
    assert sorted(map(tuple, plan[key].values)) == sorted(map(tuple, again[key].values))


def test_quotas_are_the_highest_quotients(spark):
    goals = {"a": 70.0, "b": 20.0, "c": 9.5, "d": 0.5}
    table = spark.createDataFrame([(s, i, t) for i, (s, t) in enumerate(goals.items())], "source string, rank int, target double")
    found = shard_quotas(table, shards=5, blocks=20).toPandas()
    assert (found.groupby("shard").quota.sum() == 20).all()
    seats, held = {}, dict.fromkeys(goals, 0)
    for seat in range(100):
        best = max(goals, key=lambda s: goals[s] / (2 * held[s] + 1))
        held[best] += 1
        seats[best, seat // 20] = seats.get((best, seat // 20), 0) + 1
    assert {(r.source, r.shard): r.quota for r in found.itertuples()} == seats


def test_mix_of_odd_rows(odd):
    plan = mix_plan(odd)
    assert plan.count() == len(ODD)
    rows = plan.collect()
    assert all(r["size"] == 0 and r.taken == 0 for r in rows if r.doc_id in (4, 5, 6))
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert sum(len(brute.words(r.text)) for r in mixed.select("text").collect()) == sum(r.taken for r in rows)


def test_parts_follow_the_quotas_of_the_shards(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    shards, blocks = 16, 32
    rows = mix_plan(docs, shards=shards, blocks=blocks).collect()
    assert all(r.taken == sum(p.words_to - p.words_from for p in r.parts) for r in rows)
    assert all(0 <= p.words_from < p.words_to <= r["size"] for r in rows for p in r.parts)
    # Dealt one by one: the block goes to the highest quotient.
    order = sorted({(r.source is None, r.source or "") for r in rows})
    goals = {s: next(r.target for r in rows if (r.source is None, r.source or "") == s) for s in order}
    block = sum(goals.values()) / (shards * blocks)
    quota, held = {}, dict.fromkeys(order, 0)
    for seat in range(shards * blocks):
        best = max(order, key=lambda s: goals[s] / (2 * held[s] + 1))
        held[best] += 1
        quota[best, seat // blocks] = quota.get((best, seat // blocks), 0) + 1
    words = {}
    for r in rows:
        for p in r.parts:
            at = (r.source is None, r.source or ""), p.shard
            words[at] = words.get(at, 0) + p.words_to - p.words_from
    last = {s: max((i for o, i in quota if o == s), default=shards - 1) for s in order}
    for s, i in quota | words:
        if i == last[s]:  # closed at the target, by less than a block
            assert abs(words.get((s, i), 0) - quota.get((s, i), 0) * block) <= block + 2
        else:
            assert abs(words.get((s, i), 0) - quota.get((s, i), 0) * block) <= 1
    # The rows of the mix are the parts, in their shards.
    mixed = mixed_documents(docs, shard="shard", shards=shards, blocks=blocks)
    found = {}
    for r in mixed.select("source", "shard", "text").collect():
        at = (r.source is None, r.source or ""), r.shard
        found[at] = found.get(at, 0) + len(brute.words(r.text))
    assert found == words
    texts = {r.doc_id: brute.words(r.text) for r in docs.select("doc_id", "text").collect()}
    wanted = sorted((r.doc_id, p.shard, tuple(texts[r.doc_id][p.words_from : p.words_to])) for r in rows for p in r.parts)
    assert sorted((r.doc_id, r.shard, tuple(brute.words(r.text))) for r in mixed.select("doc_id", "shard", "text").collect()) == wanted


# --- substring dedup


def test_passages_against_brute_force(odd):
    found = rows_of(substring_dedup(odd), "doc_id", "n_words", "n_removed", "kept_sha256")
    wanted = [(i, *x) for (i, _, _), x in zip(ODD, brute.repeated_passages([t for _, t, _ in ODD], 35))]
    assert found == sorted(wanted, key=repr)
    assert sum(x[2] for x in found) > 0
    with_text = {r.doc_id: r.kept_text for r in substring_dedup(odd, with_text=True).collect()}
    assert with_text[1] == "Same text here" and with_text[16] == "" and with_text[4] == ""


@pytest.mark.parametrize("size", [1, 3])
def test_short_windows(spark, size):
    r = random.Random(size)
    texts = [" ".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(9))) for _ in range(60)]
    docs = made(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = rows_of(substring_dedup(docs, size), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted([(i, *x) for i, x in enumerate(brute.repeated_passages(texts, size))], key=repr)


# --- near duplicates


def chain(seed, n, length=150):
    """Texts of which each differs a little from an earlier one: links, but no centre."""
    r, out = random.Random(seed), [prose(seed, length, 10_000).split()]
    for _ in range(n):
        w = list(r.choice(out))
        for _ in range(r.randrange(1, 3)):
            w[r.randrange(len(w))] = f"v{r.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("similarity", [85, 80])
def test_components_against_brute_force(spark, monkeypatch, similarity):
    monkeypatch.setattr(minhash, "SPLIT_ABOVE", 16)
    monkeypatch.setattr(minhash, "HOT_ABOVE", 24)
    monkeypatch.setattr(minhash, "BLOCK", 20)
    texts = chain(1, 150) + chain(2, 60, 80) + [prose(3, 100)] * 30 + [t for _, t, _ in ODD]
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    docs = made(spark, [(i, t, "s") for i, t in rows])
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, similarity).collect()}
    assert found == brute.components(rows, similarity)


def test_near_duplicates_of_odd_rows(odd):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_components(odd).collect()}
    assert found[1, 1] == (1, True) and found[2, 1] == (1, False) and found[3, 1] == (1, False)
    assert found[4, 0] == (4, True) and found[6, 0] == (6, True) and found[None, 1] == (None, True)
    assert found[10, 196] == (10, True) and found[11, 197] == (10, False) and found[16, 1] == (16, True)
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert rows_of(kept.where("doc_id in (1, 2, 3, 10, 11, 13) or doc_id is null"), "doc_id") == [(1,), (10,), (13,), (None,), (None,)]


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    errors = []
    for share in (0.5, 0.8, 0.9):
        for _ in range(30):
            both = r.integers(0, 1 << 63, 2000).astype(np.uint64)
            cut = int(2000 * share)
            a, b = both[: (2000 + cut) // 2], np.concatenate((both[:cut], both[(2000 + cut) // 2 :]))
            errors.append((minhash.signature(np.unique(a)) == minhash.signature(np.unique(b))).mean() - share)
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.12


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300)]
    labels = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert all(labels[i] == 0 for i in range(41)) and all(labels[i] == 100 for i in range(100, 160))
    assert labels[301] == 300 and 200 not in labels


# --- decontamination


def test_walks_taken_backwards_write_what_single_walks_do(monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 64)
    random = np.random.default_rng(3)
    for steps in (1, 4, 9, 18):
        walk = decontaminate.Walk(2, steps, 7)
        hashes = np.concatenate((random.integers(1 << 62, size=150).astype(np.uint64) * np.uint64(4) | np.uint64(1), np.zeros(steps + 1, np.uint64)))
        bits = decontaminate.mixed(hashes ^ walk.salt).tolist()
        found = [np.concatenate(blocks).tolist() for blocks in zip(*walk.keys(hashes, 150))]
        for start in range(150):
            at, path = start, []
            for t in range(steps):
                path.append(at)
                at += bits[at] >> t & 1
            for table, sample in enumerate(walk.samples):
                wanted = sum((int(hashes[path[t]]) >> 32) * int(walk.factors[t]) for t in sample) % (1 << 32)
                assert found[table][start] == wanted


def test_leaks_against_brute_force(spark):
    r = random.Random(9)
    items = [(k, prose(50 + k, n, 3000)) for k, n in enumerate((1, 2, 4, 8, 15, 30, 40))] + [(90, None), (91, ""), (4, prose(54, 15, 3000))]
    docs = []
    for i in range(40):
        w = items[r.randrange(7)][1].split()
        for _ in range(int(len(w) * r.choice((0, 0.1, 0.15)))):
            w[r.randrange(len(w))] = "other"
        docs.append((i, " ".join([prose(900 + i, 20, 3000), *w, prose(990 + i, 20, 3000)]).upper().replace("W", "w")))
    docs += [(50, None), (51, ""), (52, items[5][1]), (52, items[5][1])]
    table = made(spark, [(i, t, "s") for i, t in docs])
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = find_leaks(table, benchmark).collect()
    wanted = brute.leaks(docs, [(k, t) for k, t in items if t], 0.2)
    assert {(x.doc_id, x.item_id): x.n_edits for x in found} == wanted
    assert sum(x.doc_id == 52 and x.item_id == 5 for x in found) == 2
    several = find_leaks(table, benchmark, block_bytes=60)
    assert rows_of(several, "doc_id", "item_id", "n_edits") == rows_of(find_leaks(table, benchmark), "doc_id", "item_id", "n_edits")
    clean = without_leaks(table, benchmark)
    assert {x.doc_id for x in clean.select("doc_id").collect()} == {i for i, _ in docs} - {d for d, _ in wanted}


def test_recall_at_the_limit():
    from creditmill.llm.decontaminate import Benchmark

    r = random.Random(5)
    items = [prose(k, r.randrange(15, 56), 5000) for k in range(60)]
    texts = []
    for k in range(300):
        w = items[k % 60].split()
        for _ in range(int(0.2 * len(w))):
            j = r.randrange(len(w))
            (w.insert(j, f"n{r.random()}"), w.pop(j + 1))[: r.randrange(1, 3)]
        texts.append(" ".join([prose(k, 9), *w, prose(k + 1, 9)]))
    hits = {(t, i) for t, i, _, _ in Benchmark(list(range(60)), items).find(pa.array(texts))}
    assert sum((k, k % 60) in hits for k in range(300)) >= 0.9 * 300


@pytest.mark.parametrize("size", [5, 8, 12, 15, 25, 40, 55, 100, 300])
@pytest.mark.parametrize("place", ["start", "middle", "end"])
def test_recall_with_edits_gathered(size, place):
    from creditmill.llm.decontaminate import Benchmark

    items, edits = [prose(700 + k, size, 5000) for k in range(20)], int(0.2 * size)
    first = {"start": 0, "middle": (size - edits) // 2, "end": size - edits}[place]
    for changed in (lambda w: [f"new{i}" for i in range(edits)], lambda w: [], lambda w: [x for y in w for x in ("more", y)]):
        texts = []
        for k, item in enumerate(items):
            w = item.split()
            w[first : first + edits] = changed(w[first : first + edits])
            texts.append(" ".join([prose(k, 9), *w, prose(k + 1, 9)]))
        hits = {t: n for t, i, _, n in Benchmark(list(range(20)), items).find(pa.array(texts)) if t == i}
        assert len(hits) >= 19 and max(hits.values()) <= edits


def test_place_of_a_passage_without_its_beginning():
    from creditmill.llm.decontaminate import Benchmark

    item = prose(3, 40, 5000)
    texts = [" ".join(item.split()[8:]), "before " * 30 + " ".join([*["new"] * 8, *item.split()[8:]]), "a b", " ".join(item.split()[:32])]
    found = Benchmark([7], [item]).find(pa.array(texts))
    assert [(t, n) for t, _, _, n in found] == [(0, 8), (1, 8), (3, 8)] and [p for _, _, p, _ in found] == [0, 30, 0]


# --- tokens


def test_counts_and_ids_agree_with_the_library(odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t, _ in ODD}
    found = rows_of(count_tokens(odd, vocabulary()), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert found == sorted([(i, len((t or "").encode()), len(ids[t]), len(ids[t]) > 2048) for i, t, _ in ODD], key=repr)
    frames = store_tokens(odd, vocabulary())
    stored = read_tokens(frames).orderBy("start").collect()
    assert [r.doc_id for r in stored] == sorted([i for i, _, _ in ODD], key=lambda i: (i is not None, i or 0))
    assert [r.start for r in stored] == [0, *np.cumsum([r.n_tokens for r in stored]).tolist()[:-1]]
    crc = {zlib.crc32(np.array([*v, 1], "<u4").tobytes()) for v in ids.values()}
    assert {r.ids_crc32 for r in stored} == crc


def test_hard_words_agree_with_the_library():
    from tokenizers import Tokenizer
    from creditmill.llm.token_counts import Counter
    from creditmill.llm.token_store import Encoder

    r = random.Random(3)
    pool = "aAbB'’.,<|>endtxof éÉñß日́ \n\t\U0001f60019½İ \u0085\x1c"
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(40))) for _ in range(800)]
    texts += ["<|endoftext|>x<|startoftext|> <|endoftext|", "don't DON'T we'll ,'s", "aaaaaaaaa", "ΣΑΣ ﬁ İ", ""]
    library = Tokenizer.from_file(vocabulary())
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counter(vocabulary()).count(pa.array(texts)).tolist() == [len(w) for w in wanted]
    counts, ids = Encoder(vocabulary()).encode(pa.array(texts), 1)
    assert counts.tolist() == [len(w) + 1 for w in wanted] and ids.tolist() == [i for w in wanted for i in [*w, 1]]


def test_merging_against_one_pair_at_a_time():
    merges = ["a a", "a b", "aa a", "b c</w>", "aa aa", "ab c</w>"]
    singles = ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
    vocab = {t: i for i, t in enumerate([*singles, *[m.replace(" ", "") for m in merges]])}
    table = Merges({"model": {"vocab": vocab, "merges": merges, "end_of_word_suffix": "</w>"}})
    r = random.Random(2)
    pieces = ["".join(r.choice("aaabc") for _ in range(r.randrange(1, 12))) for _ in range(500)]
    ranks = {tuple(m.split()): i for i, m in enumerate(merges)}
    assert table.count(pieces).tolist() == [brute.bpe_count(p, ranks, "</w>") for p in pieces]


def test_files_are_read_frame_by_frame(spark, odd, monkeypatch):
    monkeypatch.setattr(token_store, "FRAME_IDS", 64)
    frames = store_tokens(odd, vocabulary())
    assert frames.count() > 8
    wanted = spark.createDataFrame([(8,), (13,), (99,)], "doc_id bigint")
    found = read_tokens(frames, wanted, with_ids=True).collect()
    assert sorted(r.doc_id for r in found) == [8, 13, 13]
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    path = frames.first().file
    name = path.removeprefix("file://")
    with open(name, "r+b") as file:
        file.seek(FrameReader(path).sizes[0, 0] - 1)
        file.write(b"\xff")
    with pytest.raises(Exception):
        FrameReader(path).read(0)


def test_long_texts_are_stored_in_small_batches(spark, monkeypatch):
    from creditmill.operators.materialize import BATCH_SETTING

    seen, before = [], spark.conf.get(BATCH_SETTING)
    write = token_store.write_tokens
    sizes = "n bigint"

    def measured(docs, *rest):
        def bytes_of(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

        seen.extend(r.n for r in docs.select("text").mapInArrow(bytes_of, sizes).collect())
        return write(docs, *rest)

    monkeypatch.setattr(token_store, "write_tokens", measured)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("many words "), 10_000).alias("text")).coalesce(1)
    assert read_tokens(store_tokens(docs, vocabulary())).count() == 400
    # 44 MB of text, each row 110 kB.
    assert len(seen) >= 4 and max(seen) <= token_store.BATCH_BYTES + 200_000
    assert spark.conf.get(BATCH_SETTING) == before


def test_workers_give_freed_memory_back():
    from creditmill.llm.words import memory_returned

    def resident():
        with open("/proc/self/status") as file:
            return next(int(line.split()[1]) for line in file if line.startswith("VmRSS"))

    kept = [bytes(100_000) for _ in range(2000)]
    small = kept[::50]
    full = resident()
    kept = None
    memory_returned()
    assert full - resident() > 100_000 and len(small) == 40


# --- toxicity


def test_machine_learns_on_held_out_rows(spark):
    r = random.Random(8)
    rows, marks = [], []
    for i in range(1200):
        w, toxic = [f"w{r.randrange(900)}" for _ in range(60)], i % 4 == 0
        if toxic:
            w[r.randrange(60)] = r.choice(("scumbag", "vilexa", "vilexo", "vilexu")) + r.choice(("", ",", "!!"))
        rows.append((i, " ".join(w), "s"))
        marks.append((i, int(toxic)))
    docs = made(spark, rows)
    labels = spark.createDataFrame(marks + [(None, 1), (5000, None)], "doc_id bigint, toxic int")
    machine = fit(docs, labels, F.col("doc_id") % 3 != 1)
    scores = {x.doc_id: x.score for x in score_toxicity(docs, machine).collect()}
    held = [i for i in range(1200) if i % 3 == 1]
    assert np.mean([(scores[i] >= 0.7) == (i % 4 == 0) for i in held]) > 0.97
    assert without_toxic(docs, machine).columns == docs.columns


def test_pairs_weigh_more_than_terms():
    from creditmill.llm.toxicity import train

    r = np.random.default_rng(0)
    labels, rows, found = [], [], []
    for i in range(2000):  # toxic only if both terms stand together
        a, b = r.random(2) < 0.5
        labels.append(float(a and b))
        terms = [t for t, has in ((1, a), (2, b), (3, r.random() < 0.5)) if has]
        rows += [i] * len(terms)
        found += terms
    machine = train(np.array(labels), np.array(rows), np.array(found))
    place = {b: i for i, b in enumerate(machine.buckets.tolist())}
    pair = machine.factors[place[1]] @ machine.factors[place[2]]
    raw = lambda *t: machine.raw(np.zeros(len(t), int), np.array([place[x] for x in t], int), 1)[0]
    assert pair > 0.5 and raw(1, 2) > 0 > max(raw(1), raw(2))


def test_toxicity_of_odd_and_unlabelled_rows(spark, odd):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    scored = score_toxicity(odd, fit(odd, empty)).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    one = fit(odd, spark.createDataFrame([(1, 1), (1, 0), (7, 1)], "doc_id bigint, toxic int"))
    assert score_toxicity(odd, one).count() == len(ODD)


# --- empty tables


def test_empty_tables(spark, none):
    items = spark.createDataFrame([(1, "one two three")], "item_id int, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    for result in (
        exact_dedup(none), mix_plan(none), mixed_documents(none), substring_dedup(none), near_components(none), one_of_each(none),
        count_tokens(none, vocabulary()), read_tokens(store_tokens(none, vocabulary())), find_leaks(none, items),
        without_leaks(none, items), score_toxicity(none, fit(none, labels)), without_toxic(none, fit(none, labels)),
        find_leaks(none, items.limit(0)),
    ):
        assert result.count() == 0 and result.columns


def test_seeded_order_depends_on_the_seed(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert rows_of(mix_plan(docs, seed=1), "doc_id", "taken") != rows_of(mix_plan(docs, seed=2), "doc_id", "taken")
    assert mixing.SHARDS * mixing.BLOCKS_PER_SHARD == 65536


def test_known_pre_tokens_are_not_mapped_again(monkeypatch):
    """Later chunks look up what a task knows as arrays, in any order and beside odd words."""
    from tokenizers import Tokenizer
    from creditmill.llm.pretokens import Pretokenizer
    from creditmill.llm.token_store import Encoder

    first = ["The café isn't open, 42 cafés are", "Ã© ã é 中文 <unk> don't", "", "zzqx\tzzqy"]
    later = [first[1], "open cafés, ß 中 new-word", first[0], "\n", first[3] + " <unk>"]
    encoder, library = Encoder(vocabulary()), Tokenizer.from_file(vocabulary())
    for texts in (first, later, first):
        counts, ids = encoder.encode(pa.array(texts), 1)
        wanted = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]
    monkeypatch.setattr(Pretokenizer, "mapped", lambda self, piece: pytest.fail(f"{piece!r} mapped again"))
    again, same = encoder.encode(pa.array(first), 1)
    assert again.sum() == counts.sum() and (same == ids).all()
