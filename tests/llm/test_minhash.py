"""Signatures, shingle sets and groups against brute force."""

import random
import re
from itertools import combinations

import numpy as np

from farelens.llm import minhash


def brute_set(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute_groups(rows):
    sets = {}
    for i, text, *_ in rows:
        if i is not None:
            sets.setdefault(i, []).append(brute_set(text))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations(sets.items(), 2):
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in a for y in b):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return {i: find(i) for i in sets}


def test_signature_is_circulant():
    sets = minhash.shingle_sets(["a b c d e f g", "x y", "a b c d e f"])
    assert [len(s) for s in sets] == [3, 1, 2]
    scatter, second = minhash.permutations()
    assert sorted(second[minhash.COORDINATES:]) == list(range(minhash.DIM))
    found = minhash.signatures(sets)
    base = second[minhash.COORDINATES:]
    for k in (0, 1, 7, minhash.COORDINATES - 1):
        for i, s in enumerate(sets):
            places = [int(scatter[int(x) % minhash.DIM]) for x in s]
            assert found[k, i] == min(base[(p - k) % minhash.DIM] for p in places)
    assert minhash.band_hashes(found).shape == (3, minhash.BANDS)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2 ** 63, 4000).astype(np.uint64)
    sets = [np.unique(pool[:2000]), np.unique(pool[500:2500])]
    agree = (lambda s: (s[:, 0] == s[:, 1]).mean())(minhash.signatures(sets))
    assert abs(agree - 1500 / 2500) < 0.12


def test_groups(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    rows, at = [], 0

    def add(text):
        nonlocal at
        at += 1
        rows.append((at, text, "x"))

    for _ in range(25):  # families around the threshold
        base = rng.choices(words, k=rng.randrange(4, 90))
        for _ in range(rng.randrange(1, 6)):
            copy = base[:]
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            add(" ".join(copy))
    chain = rng.choices(words, k=120)  # neighbours are alike, the ends are not
    for i in range(12):
        add(" ".join(chain[i * 4:i * 4 + 60]))
    passage = rng.choices(words, k=40)  # shared by many, too little to link
    for _ in range(30):
        add(" ".join(rng.choices(words, k=30) + passage))
    hot = rng.choices(words, k=80)  # one large group of near copies
    for i in range(60):
        add(" ".join(hot[:70] + [f"n{i}"] + hot[70:]).upper() if i % 2 else " ".join(hot))
    rows += [(900, None, "n"), (901, " \n", "e"), (902, "one two", "s"), (903, "ONE\ttwo", "s"),
             (904, " ".join(hot) + " tail" * 30_000, "l"), (None, " ".join(hot), None),
             (905, "twice the same id here", "t"), (905, " ".join(hot), "t"), (1, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(6)
    found = minhash.judge(docs).collect()
    assert len(found) == len(rows)
    expected = brute_groups(rows)
    sizes = {(i, len(brute_set(t))) for i, t, _ in rows}
    for r in found:
        assert r.component_id == expected.get(r.doc_id) and (r.doc_id, r.n_shingles) in sizes
        assert r.kept == (r.doc_id == r.component_id)
    left = minhash.drop_near_copies(docs)
    assert left.schema == docs.schema
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(i) for i, *_ in rows if i is None or expected[i] == i)
    assert minhash.judge(docs.limit(0)).count() == 0


def test_prefixes_of_a_repeated_id(spark):
    """Two equally large sets of one id keep a quarter each, not one quarter of both."""
    one, two = [np.arange(a, a + 40, dtype=np.int64) for a in (0, 100)]
    rows = [(1, b"a", one), (1, b"b", two), (2, b"a", one), (3, b"b", two)]
    sets = spark.createDataFrame([(n, k, bytearray(s.tobytes())) for n, k, s in rows],
                                 "node long, set_id binary, shingles binary")
    nodes = spark.createDataFrame([(i, i) for i in (1, 2, 3)], "node long, component long")
    found = minhash.prefixes(sets, nodes, 75).collect()
    marks = {i: {r.shingle for r in found if r.node == i} for i in (1, 2, 3)}
    assert len(marks[2]) == len(marks[3]) == 11 and marks[1] == marks[2] | marks[3]
    assert {r.most for r in found} == set(range(30, 41))


def test_bits_of_pairs_at_the_limit():
    """Neither few nor many shingles bring a pair of similarity 0.75 near the bound on bits."""
    rng = np.random.default_rng(5)
    for n, common, pairs in ((7, 6, 4000), (28, 24, 2000), (700, 600, 200)):
        values = rng.integers(0, 2 ** 63, (pairs, 2 * n - common)).astype(np.uint64)
        sets = [s for x in values for s in (x[:n], np.concatenate([x[:common], x[n:]]))]
        found = minhash.signatures(sets)
        differ = ((found[:, ::2] ^ found[:, 1::2]) & 1).sum(axis=0)
        assert 28 < differ.mean() < 32 and differ.max() < minhash.MOST_BITS - 5
        bands = minhash.band_hashes(found)
        assert (bands[::2] == bands[1::2]).any(axis=1).all()
