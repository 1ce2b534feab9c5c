"""Ids against the library (merges) and against brute force (Viterbi), and decoding."""

import random
import re
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from farelens.llm import sentencepieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two  spaces ", "tab\tand\nlines\n\n next", "naïve café", "漢字かな交じり",
       "😀 emoji", "x" * 300, "ab" * 2000 + "!?" * 40, "1234567890", "<s>[INST]", "\x00a", "    deep",
       "thththeransiner", "https://a.example.com/?q=" + "Zm9vYmFy" * 40]


def test_long_words_follow_the_library():
    vocabulary = sp.read_model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(3)
    for n in (1, 5, 20, 400):
        for alphabet in ("ab", "theransio", "ab1.é漢"):
            word = "".join(rng.choices(alphabet, k=n))
            assert sp.merge_long(sp.MARK + word, vocabulary) == library.encode(word)


def test_ids_are_the_librarys(spark):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
            .orderBy("doc_id").limit(120).collect()] + ODD
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)] + [(None, "a b", "x")],
                                 "doc_id long, text string, ids string").repartition(3)
    vocabulary = sp.read_model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoded = sp.encode(docs, vocabulary)
    found = {r.doc_id: r for r in encoded.collect()}
    for i, t in [*enumerate(rows), (None, "a b")]:
        assert list(found[i].ids) == library.encode(t or ""), t
        assert found[i].n_ids == len(found[i].ids) and found[i].round_trip
    back = {r.doc_id: r.text for r in sp.decode(encoded, vocabulary).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(rows))
    assert sp.encode(docs.limit(0), vocabulary).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_viterbi_is_the_best_sum(spark, seed):
    rng = random.Random(seed)
    pieces = {c: (i, -5.0) for i, c in enumerate("abc")}
    while len(pieces) < 14:
        p = "".join(rng.choices("abc", k=rng.randrange(2, 5)))
        pieces.setdefault(p, (len(pieces), round(-rng.uniform(1, 12), 3)))
    texts = [p.encode() for p in pieces] + [b""] * 6 + [bytes([b]) for b in range(256)]
    vocabulary = sp.Vocabulary(pieces, texts, 20, True, False)
    words = list({"".join(rng.choices("abcd", k=rng.randrange(1, 8))) for _ in range(40)} - {"d"})
    df = spark.createDataFrame([(w,) for w in words if set(w) != {"d"}], "word string")
    worst = min(s for _, s in pieces.values()) - 10

    def score(word, cuts):
        parts = [word[a:b] for a, b in zip((0, *cuts), (*cuts, len(word)))]
        if any(len(p) > 1 and p not in pieces for p in parts):
            return None
        return sum(pieces[p][1] if p in pieces else worst for p in parts)

    for r in sp.encode_words(df, vocabulary).collect():
        every = [score(r.word, c) for k in range(len(r.word))
                 for c in combinations(range(1, len(r.word)), k)]
        best = max(x for x in every if x is not None)
        assert b"".join(texts[i] for i in r.ids) == r.word.encode()
        total = sum({i: s for i, s in pieces.values()}.get(i, worst) for i in r.ids)
        assert abs(total - best) < 1e-9


def test_places_come_back():
    places = np.array([0, 1, 0, 2, 2, 1, 3, 0], np.int64)
    assert sp.unpack_places(sp.pack_places(places), len(places)).tolist() == places.tolist()


def test_chunks_are_not_shuffled_again(spark):
    """The documents of a chunk stay where they were stored; words go to owners once."""
    docs = spark.createDataFrame([(i, f"word{i} and {'y' * 70}") for i in range(20)],
                                 "doc_id long, text string").repartition(4)
    encoded = sp.encode(docs, sp.read_model(PATH))
    found = encoded.collect()
    assert len(found) == 20 and all(r.round_trip for r in found)
    plan = encoded._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = re.findall(r"\(\d+\) Exchange\n.*\nArguments: (.*?),", plan)
    assert not any("places" in x for x in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan))
    assert len(exchanges) >= 2 and "SelectedBucketsCount" in plan and "ReusedExchange" in plan


def test_edges_of_merges_are_single_numbers(spark):
    """All substrings that are pieces, by rank of the score, start and end; equal scores tie."""
    scores = {"a": -9.0, "b": -9.0, "c": -8.0, "ab": -1.0, "bc": -1.0, "abc": -3.0, "ca": -2.0}
    pieces = {p: (i + 300, x) for i, (p, x) in enumerate(scores.items())}
    vocabulary = sp.Vocabulary(pieces, [], 0, False, False)
    words = ["abcab", "c", "dd", "cab" * 20]
    found = {r.word: r.edges for r in sp.lattice(
        spark.createDataFrame([(1, w) for w in words], "owner int, word string"), vocabulary,
        ("owner", "word")).collect()}
    ranks = {x: r for r, x in enumerate(sorted({-x for x in scores.values()}))}
    for w in words:
        want = sorted((ranks[-pieces[w[s:e]][1]], s, e, pieces[w[s:e]][0])
                      for s in range(len(w)) for e in range(s + 1, min(len(w), s + 3) + 1)
                      if w[s:e] in pieces)
        assert [(x >> 40, x >> 34 & 63, x >> 28 & 63, x & (1 << 28) - 1)
                for x in found.get(w, [])] == want
