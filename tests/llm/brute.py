"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def repeated_passages(texts, size):
    """(words, removed words, hash of the kept ones) of each text."""
    split = [words(t) for t in texts]
    starts = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if starts[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, size=5):
    w = words(text, lower=True)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(rows, similarity):
    """(set size, smallest linked id) by id; every pair that shares a shingle is compared."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if 100 * n >= similarity * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in s:
            holders[x].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edit_distance(item, run):
    """Least edits from the item to a beginning of the run."""
    row = list(range(len(run) + 1))
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(run):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (a != b)))
        row = new
    return min(row)


def leaks(docs, items, share):
    """{(doc, item): edits} of all items that documents hold."""
    found = {}
    for d, text in docs:
        w = words(text, lower=True)
        for k, item in items:
            own = words(item, lower=True)
            limit = int(len(own) * share)
            if own:
                best = min((edit_distance(own, w[p : p + len(own) + limit]) for p in range(len(w))), default=limit + 1)
                if best <= limit:
                    found[d, k] = best
    return found


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Target of each source, by resharing until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / total > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else rest * weight[s] / total for s in order}
        capped |= over


def bpe_count(pieces, ranks, end):
    """Tokens of one pre-token, merged pair by pair."""
    symbols = [*pieces[:-1], pieces[-1] + end]
    while len(symbols) > 1:
        best = min(range(len(symbols) - 1), key=lambda i: ranks.get((symbols[i], symbols[i + 1]), 1 << 60))
        if (symbols[best], symbols[best + 1]) not in ranks:
            break
        symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
    return len(symbols)
