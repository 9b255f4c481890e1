from collections import Counter

from creditmill.plans import quality


def brute(rows, names, n=10):
    out = []
    for i, name in enumerate(names):
        counts = Counter(str(r[i]) for r in rows if r[i] is not None)
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]
        out += [(name, v, c, k + 1) for k, (v, c) in enumerate(top)]
    return sorted(out)


def test_frequent_values_against_brute_force(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"v{i % 17}", None, i % 4 if i % 5 else None) for i in range(3000)]
    rows += [(None, "tie-b", None, 9), (None, "tie-a", None, 9)]
    names = ["id", "word", "empty", "small"]
    df = spark.createDataFrame(rows, "id long, word string, empty string, small int").repartition(5)
    found = sorted(tuple(r) for r in quality.frequent_values(df).collect())
    assert found == brute(rows, names)
    # Few candidates and a small sketch: the long tail is counted by the exact way.
    assert sorted(tuple(r) for r in quality.frequent_values(df, candidates=3, tracked=8).collect()) == brute(rows, names)


def test_frequent_values_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b long")
    assert quality.frequent_values(df).count() == 0
