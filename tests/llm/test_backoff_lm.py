"""Backoff language model: joins against an automaton walked left to right."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import types as T

import brute
from creditmill.llm.backoff_lm import BEGIN, END, backoff_scores, discount

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


class Automaton:
    """States are histories with failure arcs; arcs carry interpolated log10 probabilities."""

    def __init__(self, rows):
        seqs = [[BEGIN, BEGIN, *brute.words(t, lower=True), END] for i, t in rows if not held(i)]
        c3 = Counter(tuple(s[i - 2 : i + 1]) for s in seqs for i in range(2, len(s)))
        c2 = Counter()
        for (a, b, w), c in c3.items():
            c2[(b, w)] += c
        c1 = Counter()
        for (b, w), c in c2.items():
            c1[w] += c
        self.n, self.v = sum(c1.values()), len(c1)
        self.z = self.n + 0.5 * (self.v + 1)
        counts = lambda table, k: sum(1 for c in table.values() if c == k)
        d3, d2 = discount(counts(c3, 1), counts(c3, 2)), discount(counts(c2, 1), counts(c2, 2))
        self.c1 = c1
        h1, t1, h2, t2 = Counter(), Counter(), Counter(), Counter()
        for (b, w), c in c2.items():
            h1[b] += c
            t1[b] += 1
        for (a, b, w), c in c3.items():
            h2[(a, b)] += c
            t2[(a, b)] += 1
        self.fail = {(b,): d2 * t1[b] / h1[b] for b in h1} | {(a, b): d3 * t2[(a, b)] / h2[(a, b)] for a, b in h2}
        self.p2 = {(b, w): (c - d2) / h1[b] + self.fail[(b,)] * self.p1(w) for (b, w), c in c2.items()}
        self.arcs = {(b,): {} for b in h1} | {(a, b): {} for a, b in h2}
        for (b, w), p in self.p2.items():
            self.arcs[(b,)][w] = p
        for (a, b, w), c in c3.items():
            self.arcs[(a, b)][w] = (c - d3) / h2[(a, b)] + self.fail[(a, b)] * self.p2[(b, w)]

    def p1(self, w):
        return (self.c1.get(w, 0) + 0.5) / self.z

    def score(self, text):
        """One walk: the state is the longest history of the model; failure arcs add weight."""
        total, history = 0.0, (BEGIN, BEGIN)
        for w in [*brute.words(text, lower=True), END]:
            state = history if history in self.arcs else history[1:] if history[1:] in self.arcs else ()
            while True:
                if state and w in self.arcs[state]:
                    total += math.log10(self.arcs[state][w])
                    break
                if not state:
                    total += math.log10(self.p1(w))
                    break
                total += math.log10(self.fail[state])
                state = state[1:] if state[1:] in self.arcs else ()
            history = (history[1], w)
        return total

    def base(self, text):
        return sum(math.log10(self.p1(w)) for w in [*brute.words(text, lower=True), END])


def odd_rows():
    rows = [(i, brute_text(i)) for i in range(1, 60)]
    rows += [(100, None), (101, ""), (102, "   \t\n"), (103, "THE Cat the cat ÄÖ the"), (103, "other text same id"),
             (None, "a b c"), (104, "word " * 3000), (105, rows[3][1]), (106, rows[3][1]), (107, "never seen zzqx")]
    return rows


def brute_text(i):
    vocabulary = "the a cat dog sat on mat ran far near big small red".split()
    return " ".join(vocabulary[(i * 7 + k * k * 3 + k // 2) % len(vocabulary)] for k in range(5 + i % 17))


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def test_scores_against_a_walked_automaton(spark):
    rows = odd_rows()
    model = Automaton(rows)
    found = backoff_scores(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(found) == len(rows)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in found), key=key)
    wanted = sorted(((i, held(i), len(brute.words(t)) + 1, sum(1 for w in [*brute.words(t, lower=True), END] if w in model.c1),
                      model.n, round(model.base(t), 6), round(model.score(t), 6)) for i, t in rows), key=key)
    assert got == wanted


def test_steps_are_distributions():
    model = Automaton(odd_rows())
    for state, arcs in list(model.arcs.items())[:20]:
        seen = sum(arcs.values())
        lower = state[1:]
        rest = sum(model.p1(w) for w in model.c1 if w not in arcs) + 0.5 / model.z
        if lower:
            rest = sum((model.arcs[lower].get(w) if lower in model.arcs and w in model.arcs[lower] else
                        model.fail.get(lower, 1.0) * model.p1(w)) for w in model.c1 if w not in arcs)
            rest += model.fail.get(lower, 1.0) * 0.5 / model.z
        assert seen + model.fail[state] * rest == pytest.approx(1.0, abs=1e-9)


def test_empty_and_untrained_tables(spark):
    assert backoff_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    only_held = [(i, "some words here") for i in range(200) if held(i)][:3]
    found = backoff_scores(spark.createDataFrame(only_held, SCHEMA)).collect()
    assert [(r.train_tokens, r.score, r.base_score, r.n_known) for r in found] == [(0, 0.0, 0.0, 0)] * 3


def test_clashing_columns_are_ignored(spark):
    rows = odd_rows()[:20]
    wide = T.StructType([*SCHEMA.fields, T.StructField("Text", T.StringType()), T.StructField("score", T.DoubleType())])
    df = spark.createDataFrame([(*r, "x y", 1.0) for r in rows], wide)
    a = sorted(((r.doc_id, round(r.score, 9)) for r in backoff_scores(df).collect()), key=key)
    b = sorted(((r.doc_id, round(r.score, 9)) for r in backoff_scores(spark.createDataFrame(rows, SCHEMA)).collect()), key=key)
    assert a == b


def test_steps_of_frequent_words_are_shared_out(spark):
    """Many small parts and chunks; some words fill several parts, the begin mark too."""
    rows = odd_rows()
    model = Automaton(rows)
    found = backoff_scores(spark.createDataFrame(rows, SCHEMA).repartition(3), part_bytes=300, chunk_bytes=700).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found), key=key)
    wanted = sorted(((i, len(brute.words(t)) + 1, sum(1 for w in [*brute.words(t, lower=True), END] if w in model.c1),
                      model.n, round(model.base(t), 6), round(model.score(t), 6)) for i, t in rows), key=key)
    assert got == wanted


def few_words(parts, named):
    """Frequent words as a sample would name them."""
    from creditmill.llm.backoff_lm import Frequent, hashes

    words = Frequent.__new__(Frequent)
    words.keys = hashes(named)[0]
    words.shares = np.maximum(1, parts // np.arange(2, 2 + len(named)))
    words.order = np.argsort(words.keys)
    return words


def dealt(spark, texts, parts, frequent):
    from creditmill.llm.backoff_lm import STEPS, ChunkSteps

    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("docs", pa.list_(pa.int64()))] + [
        (f.split()[0], pa.binary() if f.endswith("binary") else pa.int32()) for f in STEPS.split(", ")])
    piece = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "held_out": [held(i) for i in range(len(texts))], "text": texts})
    steps = ChunkSteps(piece.column("text").combine_chunks(), frequent)
    return steps, pa.Table.from_batches(list(steps.rows(5, piece, parts, frequent, schema)))


def test_a_step_takes_few_bytes_in_its_shuffle(spark, small):
    """Three 64-bit hashes a step went above the budget of disk."""
    texts = [r.text or "" for r in spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").select("text").collect()]
    named = [w for w, _ in Counter(w for t in texts[::3] for w in brute.words(t, lower=True)).most_common(20000)]
    steps, table = dealt(spark, texts, 8, few_words(8, named))
    assert sum(len(v) for c in table.columns if c.type == pa.binary() for v in c.to_pylist()) < 12 * len(steps.w)


def test_wide_vocabularies_are_counted_alike(spark):
    from creditmill.llm.backoff_lm import PartSteps

    frequent = few_words(4, ["the", "a", "cat"])
    _, table = dealt(spark, [t or "" for _, t in odd_rows()], 4, frequent)
    for part in range(4):
        own = table.filter(pc.equal(table.column("part"), part))
        plain, wide = PartSteps(own, frequent), PartSteps(own, frequent, bits=8)
        for name in ("c3", "ch2", "t2", "c2", "ch1", "t1", "h1", "w", "trigram", "bigram", "history"):
            assert (getattr(plain, name) == getattr(wide, name)).all(), name


def test_words_that_share_a_hash_raise():
    from creditmill.llm.backoff_lm import agreed

    with pytest.raises(ValueError, match="share a hash"):
        agreed(np.array([7, 8, 7], np.uint64), np.array([1, 2, 3], np.uint32))


def shuffled(spark):
    """Bytes of each shuffle file that the session has."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_many_parts_exchange_little_more(spark, small):
    """With 816 parts, as of 6 GB, 0.1 GB of documents wrote 36 GB of answers, and sums for nearly each step."""
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text").cache()
    size = sum(len((r.text or "").encode()) for r in docs.collect())
    written = []
    for parts in (8, 160):
        before = shuffled(spark)
        backoff_scores(docs, part_bytes=size // parts)
        written.append(sum(n for f, n in shuffled(spark).items() if f not in before))
    assert written[1] < 2 * written[0] and written[1] < 6 * size


def test_parts_count_what_all_chunks_learned(spark):
    """Two chunks, and h1 whose trigrams several parts share."""
    from creditmill.llm.backoff_lm import COUNTS, answer_steps

    texts, frequent, parts = [t or "" for _, t in odd_rows()], few_words(16, ["the", "a", "cat"]), 5
    first, second = (dealt(spark, half, parts, frequent)[1] for half in (texts[:30], texts[30:]))
    second = second.set_column(1, "chunk", pa.array([6] * len(second), pa.int64()))
    both = pa.concat_tables([first, second])
    asked = both.filter(pc.less(both["part"], parts))
    answer = answer_steps(parts, frequent)
    answers = pa.concat_tables([answer(asked.filter(pc.equal(asked["part"], p))) for p in range(parts)])
    assert len(answers) == len(asked) and len(answer(both.filter(pc.greater_equal(both["part"], parts)))) == 0
    c3, c2 = Counter(), Counter()
    for half in (texts[:30], texts[30:]):
        for t in (t for i, t in enumerate(half) if not held(i)):
            s = [BEGIN, BEGIN, *brute.words(t, lower=True), END]
            c3.update(zip(s, s[1:], s[2:]))
            c2.update(zip(s[1:], s[2:]))
    got = dict(zip(COUNTS, (sum(answers[c].to_pylist()) for c in COUNTS)))
    assert [got[c] for c in ("ones3", "twos3", "ones2", "twos2")] == [sum(n == k for n in c.values()) for c in (c3, c2) for k in (1, 2)]
    shared = np.concatenate([np.frombuffer(d, np.int64).reshape(3, -1) for d in answers["shared"].to_pylist()], axis=1)
    assert got["n"] + shared[1].sum() == sum(c2.values())
