"""The source audit against plain counting, and shared trees against plain sums."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from farelens.llm import divergence
from farelens.llm.segtrees import EMPTY, Forest

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least=3, top=200):
    counts, docs, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), k in docs.items():
        if k >= least:
            kept[lang].append(t)

    def shares(lang, sources):
        own = {t: sum(counts[lang, s, t] for s in sources) for t in kept[lang]}
        all_of = sum(own.values()) + len(own)
        return own, {t: 1 + 10 ** 9 * (k + 1) // all_of for t, k in own.items()}

    out = []
    for lang, source in groups:
        own, p = shares(lang, [source])
        _, whole = shares(lang, [s for x, s in groups if x == lang])
        pairs = []
        for x, other in groups:
            if x == lang and other != source:
                q = shares(lang, [other])[1]
                pairs.append((other, sum((p[t] - q[t]) ** 2 // q[t] for t in p)))
        terms = [(t, (p[t] - whole[t]) ** 2 // whole[t]) for t in p
                 if own[t] > 0 and p[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1)
                    for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def table(seed, n=150):
    pick = random.Random(seed)
    words = ["the", "The", "a1b", "naïve", "Ünder", "über", "中文", "x_y", "\x00z"] + [
        f"w{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(80)]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randint(0, 30))),
             pick.choice(["en", "en", "de", None]), pick.choice(["a", "a", "b", "ß", "", None]))
            for i in range(n)]
    return rows + [(0, "the same the", "en", "a"), (0, "the same the", "en", "a"),
                   (n, None, "en", "no terms"), (n + 1, "12 34", "zz", "x"), (n + 2, "", "zz", "y"),
                   (n + 3, "lonely lonely", "yy", "q"), (None, "the " * 50_000, "en", "long")]


@pytest.mark.parametrize("cells, top", [(1 << 20, 200), (64, 5)])
def test_matches_plain_counting(spark, cells, top):
    rows = table(cells)
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    got = divergence.audit(frame, top=top, cells=cells).collect()
    assert sorted(map(tuple, got)) == by_hand(rows, top=top)


def test_small_tables_a_lower_bound_and_small_counters(spark):
    def run(rows, **how):
        frame = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
        return sorted(map(tuple, divergence.audit(frame, **how).collect()))

    assert run([]) == []
    one = [(1, "only one", "en", "a")]
    assert run(one) == by_hand(one) == []
    few = table(3, 20)
    assert run(few, least=1) == by_hand(few, least=1)
    assert run(few, held=5) == by_hand(few)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.integers(0, 70), st.integers(0, 3), st.integers(0, 10 ** 6))
def test_pairs_of_trees_give_the_plain_sum(trees, leaves, most, seed):
    counts = np.random.default_rng(seed).integers(0, most + 1, (trees, leaves))
    forest = Forest(counts)
    seen = []

    def price(a, b):
        seen.append(set(zip(a.tolist(), b.tolist())))
        assert len(seen[-1]) == len(a)
        x, y = forest.values[a], forest.values[b]
        return (np.where(x == EMPTY, 0, 10 * x + y),)

    for i in range(trees):
        for j in range(trees):
            assert forest.total(i, j, price) == (int((10 * counts[i] + counts[j]).sum()),)


def test_equal_subtrees_are_one_node():
    forest = Forest(np.tile([[5, 0, 1, 2]], (3, 256)))
    assert [len(left) for left, _ in forest.levels] == [2] + [1] * 9
    assert len(set(forest.roots.tolist())) == 1
