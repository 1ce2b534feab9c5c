"""Golomb round trips, and exact copies against a plain grouping."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from farelens.llm import exact, golomb


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2 ** 48 - 1), max_size=80) | st.sets(st.integers(0, 90)))
def test_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    assert (golomb.decode(golomb.encode(values)) == values).all()
    parts = golomb.by_owner(values, 7, 48)
    back = [part + np.uint64(golomb.range_start(o, 7, 48)) for o, part in parts]
    assert np.concatenate([np.zeros(0, np.uint64), *back]).tolist() == values.tolist()


def test_code_is_short():
    values = np.unique(np.random.default_rng(1).integers(0, 2 ** 48, 1 << 16).astype(np.uint64))
    assert len(golomb.encode(values)) * 8 / len(values) < 48 - 16 + 2


SCHEMA = "doc_id long, text string, keep_id string, word int"


def brute(rows):
    groups = {}
    for i, (doc, text, *_) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(norm, []).append((doc is None, doc or 0, i, doc))
    for norm, members in groups.items():
        members.sort()
        for m in members:
            yield (m[3], members[0][3], len(members), m is members[0],
                   hashlib.sha256(norm.encode()).hexdigest())


def test_copies(spark):
    long = "word \t" * 40_000
    rows = [(9, "a  b", "x", 1), (3, "a\n\tb", "y", 2), (4, "a b ", None, 3), (5, None, "z", 4),
            (6, "", "z", 4), (None, "a b", None, None), (7, " ", "q", 0), (8, long, "l", 1),
            (2, long.replace("\t", "\n"), "l", 1), (11, "same", "r", 1), (11, "same", "r", 1),
            (12, "solo", "s", 1), (None, None, None, None), (13, "a b", "n", 1)]
    rows += [(100 + i, f"only {i}", "u", i) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sorted(map(tuple, exact.judge(docs).collect()), key=str)
    assert found == sorted(brute(rows), key=str)
    kept = exact.drop_copies(docs)
    assert kept.schema == docs.schema
    assert kept.count() == sum(x[3] for x in brute(rows))
    # A filter of 64 bits makes most rows suspect; bytes still decide.
    again, name = exact.mark(docs, filter_bits=64)
    assert again.where(f"{name}.kept").count() == kept.count()
    assert exact.judge(docs.limit(0)).count() == 0
