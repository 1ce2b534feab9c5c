"""Removed words against a plain search for repeated windows."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from farelens.llm import exact, golomb, substrings


def brute(rows, window=13):
    """Kept words of each row."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    least = {}
    for (i, *_), words in zip(rows, split):
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            least[key] = min(least.get(key, 2 ** 63), 2 ** 62 if i is None else i)
    for (i, *_), words in zip(rows, split):
        gone = set()
        for p in range(len(words) - window + 1):
            if least[tuple(words[p:p + window])] < (2 ** 62 if i is None else i):
                gone.update(range(p, p + window))
        yield len(words), [w for k, w in enumerate(words) if k not in gone]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-2 ** 62, 2 ** 63 - 1), min_size=1, max_size=9))
def test_ids_round_trip(ids):
    ids = np.array(ids, np.int64)
    if int(ids.max()) - int(ids.min()) < 2 ** 63:
        assert substrings.unpack_ids(substrings.pack_ids(ids), len(ids)).tolist() == ids.tolist()


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ünï"]
    passages = [rng.choices(vocabulary, k=k) for k in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        rows.append((i * 7 % 121, rng.choice([" ", "\n", " \t"]).join(words), "x", len(words)))
    rows += [(500, None, "n", None), (None, " ".join(passages[4]), None, 1), (501, "", "e", 0),
             (502, "a b c d e f g " * 5, "r", 0), (502, "a b c d e f g " * 5, "r", 0),
             (503, " ".join(passages[3] + ["long"] * 20_000 + passages[4]), "l", 2)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, chunk string, n_chars long").repartition(4)
    expected = sorted((str(i), n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
                      for (i, *_), (n, kept) in zip(rows, brute(rows)))
    found = substrings.judge(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected
    changed = substrings.remove(docs)
    assert changed.schema == docs.schema
    by_row = {(str(i), t): (" ".join(kept) if n > len(kept) else t)
              for (i, t, *_), (n, kept) in zip(rows, brute(rows))}
    texts = sorted(str((r.doc_id, r.text, r.n_chars == len(r.text or ""))) for r in changed.collect()
                   if r.doc_id in (3, 503, 500))
    assert texts == sorted(str((i, by_row[str(i), t], by_row[str(i), t] != t or n == len(t or "")))
                           for i, t, _, n in rows if i in (3, 503, 500))
    assert substrings.judge(docs.limit(0)).count() == 0


def test_small_chunks_give_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    whole = sorted(map(tuple, substrings.judge(docs).collect()))
    assert sorted(map(tuple, substrings.judge(docs.repartition(9)).collect())) == whole
    assert any(r[2] for r in whole)


def test_equal_first_halves_of_hashes_change_nothing(spark, monkeypatch):
    # Four values of the first half only, so that nearly all windows agree in it.
    whole = substrings.windows
    monkeypatch.setattr(substrings, "windows", lambda w, n: whole(w, n) % np.uint64(4))
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(30))) + " p q r s t u v" * 2)
            for i in range(40)]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])
    chunk = substrings.Chunk(batch, "doc_id", "text")
    repeated = np.arange(4, dtype=np.uint64)
    hashes, further, ids = chunk.second_level(13, repeated)
    assert len(set(hashes.tolist())) == 4 < len(ids)
    parts = [slice(0, None, 2), slice(1, None, 2)]  # the even and the odd documents apart
    sent = [substrings.Chunk(batch.take(pa.array(range(40)[p])), "doc_id", "text").second_level(
        13, repeated) for p in parts]
    group = pd.DataFrame({"ids": [substrings.pack_ids(x[2]) for x in sent],
                          "further": [x[1].tobytes() for x in sent]})
    received = [golomb.decode(golomb.encode(substrings.in_order(x[0]))) for x in sent]
    smaller = substrings.smaller_elsewhere(received, group)
    found = {}
    for p, table, flags in zip(parts, sent, smaller):
        part = substrings.Chunk(batch.take(pa.array(range(40)[p])), "doc_id", "text")
        for d, words in enumerate(part.words):
            starts, *pair = part.candidates(d, 13, repeated)
            at = substrings.places_of(table[:2], *pair)
            hit = starts[flags[at] | (table[2][at] < part.order[d])]
            gone = {k for s in hit.tolist() for k in range(s, s + 13)}
            found[int(part.order[d])] = [w.decode() for k, w in enumerate(words) if k not in gone]
    assert [found[i] for i, _ in rows] == [kept for _, kept in brute(rows)]


def test_words_are_not_held(spark):
    """A chunk keeps hashes and the texts as they came, not a Python object for each word."""
    batch = pa.RecordBatch.from_pydict({"doc_id": [2, 1, None], "text": ["a b  c", None, ""]})
    chunk = substrings.Chunk(batch, "doc_id", "text")
    assert not any(isinstance(x, list) and x and isinstance(x[0], list)
                   for x in vars(chunk).values())
    assert list(chunk.words) == list(chunk.words) == [[b"a", b"b", b"c"], [], []]
    assert [len(x) for x in chunk.hashes] == [3, 0, 0]
    for module in (substrings, exact):  # workers import what the module does
        assert not hasattr(module, "pd")
