import random

import numpy as np
import pytest

from quire.llm import shinglejoin


def sets_of(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and rows[i][0] is not None and rows[j][0] is not None and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return sorted(((d, len(s), None if d is None else least[find(k)]) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=lambda r: (r[0] is None, r))


def corpus(seed, clusters=12):
    """Near copies around the threshold, chains of them, a shared passage, exact copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "É", "x"]) if rng.random() < 0.3 else f"w{rng.randrange(900)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(clusters):
        base = [word() for _ in range(rng.choice([5, 30, 60, 120]))]
        current = list(base)
        for _ in range(rng.choice([1, 3, 8, 25])):
            copy = list(current if rng.random() < 0.4 else base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            current = copy
            texts.append(rng.choice([" ", "\n", "  \t"]).join(copy))
    texts += [" ".join(passage + [word() for _ in range(rng.choice([2, 4, 10, 40]))]) for _ in range(40)]
    texts += [None, "", " \n", "one", "ONE", "one two", "one  two", "one two three", "a a a a", "a a a a a a", "a b c d", " x y z", "x y z", "y " * 5000, "y " * 5000]
    rows = [(7 * k % 10_007, t) for k, t in enumerate(texts)]
    return rows + [(None, texts[0]), (None, None), rows[3], (rows[4][0], texts[9])]


def got(docs):
    return sorted((tuple(r) for r in shinglejoin.joined(docs).collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, documents, seed):
    rows = corpus(seed)
    assert got(spark.read.parquet(f"{documents(rows)}/documents.parquet")) == brute(rows)


def test_parts_frequent_shingles_and_equal_numbers(spark, documents, monkeypatch):
    """Groups of several parts, frequent shingles in another order, and a seed under which two sets have one number."""
    monkeypatch.setattr(shinglejoin, "PART", 400)
    monkeypatch.setattr(shinglejoin, "SEEN", 2)
    monkeypatch.setattr(shinglejoin, "HEAP", 3)
    number = shinglejoin.number

    def clashing(tokens, seed):
        a, b = number(tokens, seed)
        return (a % 50 if seed == 0 else a), b

    monkeypatch.setattr(shinglejoin, "number", clashing)
    rows = corpus(3, 6)
    assert got(spark.read.parquet(f"{documents(rows)}/documents.parquet")) == brute(rows)


def test_search_same_as_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = rng.integers(0, 4000, 300).astype(np.uint64)
        tokens = [np.unique(np.concatenate([base[: rng.integers(5, 200)], rng.integers(0, 4000, rng.integers(1, 20)).astype(np.uint64)])) for _ in range(30)]
        sizes = np.array([len(t) for t in tokens])
        for percent in (60, 90):
            lists = shinglejoin.Lists(tokens, sizes, percent)
            for t in tokens:
                common = np.array([len(np.intersect1d(t, u)) for u in tokens])
                assert lists.search(t, len(t)).tolist() == np.flatnonzero(100 * common >= percent * (len(t) + sizes - common)).tolist()


def test_empty_table(spark, documents):
    assert got(spark.read.parquet(f"{documents([])}/documents.parquet")) == []
