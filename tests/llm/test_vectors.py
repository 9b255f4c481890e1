"""Vector codes and whitening against plain versions, with odd rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from creditmill.llm.vector_codes import exact_products, limb_width, vector_codes

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
])


def brute_codes(rows, entries, parts=4, rounds=4):
    """(vec_id, code, error, label_error), digest: k-means with Python integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    w = len(kept[0][1]) // parts
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))[:entries]
    books = [[s[1][p * w:(p + 1) * w] for s in seeds] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        best = min(range(len(d)), key=lambda e: (d[e], e))
        return best, d[best]

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                x = v[p * w:(p + 1) * w]
                members.setdefault(near(x, books[p])[0], []).append(x)
            for e, xs in members.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    out = []
    for i, v, lab in kept:
        found = [near(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        out.append([i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab])
    totals = {}
    for r in out:
        totals[r[3]] = totals.get(r[3], 0) + r[2]
    digest = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    return sorted(((r[0], r[1], r[2], totals[r[3]]) for r in out), key=key), digest


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def odd_vectors(n=60, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, dim).astype(np.float32)], int(i % 3)) for i in range(n)]
    rows += [
        (1000, None, 1),                                  # null vector: dropped
        (1001, [0.1] * (dim - 1) + [None], 1),            # null component: dropped
        (1002, [float("nan")] * dim, 2),                  # not finite: dropped
        (1003, [float("inf")] + [0.0] * (dim - 1), 2),    # not finite: dropped
        (5, rows[5][1], 2),                               # repeated id and vector
        (None, rows[7][1], None),                         # null id, null label
        (2000, rows[9][1], None),
        (2001, [-0.0009765625] * dim, 1),                 # floors down to -1
    ]
    return rows


def as_rows(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in df.collect()), key=key)


@pytest.mark.parametrize("entries", [256, 7])
def test_codes_against_brute_force(spark, entries):
    rows = odd_vectors()
    found = vector_codes(spark.createDataFrame(rows, SCHEMA), entries=entries)
    wanted, digest = brute_codes(rows, entries)
    assert as_rows(found) == [tuple(r) for r in wanted]
    assert {r.codebooks_sha256 for r in found.collect()} == {digest}


def test_extra_and_clashing_columns_are_ignored(spark):
    rows = odd_vectors(20)
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], T.StructType([*SCHEMA.fields, T.StructField("other", T.StringType()), T.StructField("Label", T.IntegerType())]))
    wanted, _ = brute_codes(rows, 256)
    assert as_rows(vector_codes(df)) == [tuple(r) for r in wanted]


def test_empty_table_and_only_invalid_rows(spark):
    assert vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, 1), (2, [float("nan")] * 4, 1)], SCHEMA)).count() == 0


def test_one_row_and_empty_vectors(spark):
    one = vector_codes(spark.createDataFrame([(4, [0.5, 0.25, -0.5, 1.0], None)], SCHEMA)).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(4, "00000000", 0, 0)]
    empty = vector_codes(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in empty) == [(1, "00000000", 0), (2, "00000000", 0)]
    assert empty[0].codebooks_sha256 == hashlib.sha256(b"").hexdigest()


def test_mixed_lengths_are_an_error(spark):
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], SCHEMA))


def test_many_equal_rows_share_one_entry(spark):
    rows = [(i, [0.25] * 8, 1) for i in range(5000)] + [(9000 + i, [float(i)] * 8, 2) for i in range(3)]
    found = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(7))
    wanted, digest = brute_codes(rows, 256)
    assert as_rows(found) == [tuple(r) for r in wanted]


@pytest.mark.parametrize("bits", [12, 20, 27])
def test_limb_products_are_exact(bits):
    rng = np.random.default_rng(bits)
    width = 16
    x = rng.integers(-(1 << bits), 1 << bits, (40, width))
    c = rng.integers(-(1 << bits), 1 << bits, (30, width))
    b = limb_width(width)
    count = 1
    while (1 << bits) >= 1 << (b * count - 1):
        count += 1
    found = exact_products(x, c, b, count)
    wanted = np.array([[sum(int(p) * int(q) for p, q in zip(r, s)) for s in c] for r in x], dtype=object)
    assert (found.astype(object) == wanted).all()
    if bits > 24:
        assert count > 1


def brute_whitening(rows, components=32):
    """Plain moments with Python integers, numpy eigh; (n, S, V, values, vectors, kept rows)."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v, _ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, dim = len(kept), len(kept[0][1])
    s = [sum(v[d] for _, v in kept) for d in range(dim)]
    cov = np.array([[sum((n * v[a] - s[a]) * (n * v[b] - s[b]) for _, v in kept) for b in range(dim)] for a in range(dim)], dtype=float) / n**3
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    return n, s, cov, values[order], vectors[:, order], kept


def test_whitening_against_brute_force(spark):
    from creditmill.llm.whitening import whitening

    rows = odd_vectors(300, dim=8, seed=5)
    found = whitening(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    n, s, cov, values, vectors, kept = brute_whitening(rows)
    assert len(found) == len(kept) * 8 and {r.n for r in found} == {n}
    deviations = sorted((i is None, i or 0, sum((n * v[d] - s[d]) ** 2 for d in range(8))) for i, v in kept)
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in found if r.component == 1) == deviations
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-4)
    assert found[0].identity_error <= 1e-4
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    for i, v in kept:
        centred = np.array([(n * v[d] - s[d]) / n for d in range(8)])
        wanted = centred @ vectors / np.sqrt(values)
        got = np.array([by_row[(i, sum((n * v[d] - s[d]) ** 2 for d in range(8)))][c + 1] for c in range(8)])
        assert np.allclose(np.abs(got), np.abs(wanted), rtol=1e-6, atol=1e-9)


def test_bit_planes_give_exact_cross_products():
    from creditmill.llm.whitening import plane_cross_products

    rng = np.random.default_rng(1)
    u = rng.integers(0, 1 << 11, (1000, 6))
    cross, sums = plane_cross_products(u, 11)
    assert (cross == u.T @ u).all() and (sums == u.sum(axis=0)).all()


def test_whitening_of_odd_tables(spark):
    from creditmill.llm.whitening import whitening

    assert whitening(spark.createDataFrame([], SCHEMA)).count() == 0
    equal = whitening(spark.createDataFrame([(i, [0.5] * 4, 1) for i in range(50)], SCHEMA)).collect()
    assert len(equal) == 200 and all(r.whitened is None and r.deviation == 0 for r in equal)
    assert equal[0].identity_error is None and equal[0].explained is None
    with pytest.raises(ValueError):
        whitening(spark.createDataFrame([(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], SCHEMA))
