"""Packing: every id once, no padding, the placement rule, and ids against the tokenizer."""

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from farelens.llm import packing
from farelens.llm.wordpieces import WordIds, plain_ranks

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 6))
def test_all_ids_once_and_no_padding(lengths, most_open):
    packer = packing.Packer(16, most_open)
    windows = []
    for doc, n in enumerate(lengths):
        windows += packer.add(packing.Piece((doc, n), 0, np.arange(n)))
        assert packer.n_open <= most_open
    windows += packer.close()
    seen = defaultdict(list)
    for window in windows:
        size = sum(len(p.ids) for p in window)
        assert size == 16 or size & (size - 1) == 0
        for p in window:
            assert len(p.ids) and p.ids[0] == p.start
            seen[p.doc[0]] += p.ids.tolist()
    assert {d: sorted(x) for d, x in seen.items()} == {
        d: list(range(n)) for d, n in enumerate(lengths) if n}
    assert sum(sum(len(p.ids) for p in w) < 16 for w in windows) <= 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=30), st.integers(1, 9))
def test_placement_minimises_the_squares(lengths, n):
    packer = packing.Packer(10, 1000)
    for length in lengths:
        list(packer.add(packing.Piece((0, length), 0, np.arange(length))))

    def squares(at):
        level = packer.level.copy()
        level[at] -= at > 0
        level[at + n] += at + n < 10
        return int((level[1:10] ** 2).sum())

    options = [0, *(h for h in range(1, 11 - n) if packer.level[h])]
    assert squares(packer.choose(n)) == min(map(squares, options))


def test_ids_are_the_tokenizers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    odd = ["", None, "don't  WON'T x　y", "á é <|endoftext|>b", "x\x0b\x0cy 12,34",
           "Σίσυφος İ", "‍ emoji 👩‍👩‍👧", "re 'll 're'", "long" * 3000, "J\u030c T\u0308 A\u030a ABC\u0331", "I\u0307K"]
    texts = [r.text for r in docs[:300]] + odd
    expected = Tokenizer.from_file(PATH).encode_batch(
        [x or "" for x in texts], add_special_tokens=False)
    found = WordIds(PATH).encode(texts)
    assert [x.tolist() for x in found] == [e.ids for e in expected]


def test_added_tokens_in_other_spellings():
    texts = ["A <|ENDOFTEXT|> b", "A <|endoftext|> B", "<|StartOfText|>ABC <|startoftext|>Abc",
             "ABC <| ENDOFTEXT|>. <|EndOfText|>."]
    expected = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in WordIds(PATH).encode(texts)] == [e.ids for e in expected]


def test_pieces(spark):
    rows = [(1, "a few words", 0), (2, None, 1), (None, "", 2), (3, "word " * 9000, 3),
            (4, "same", 4), (4, "same", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(2)
    found = packing.pack(docs, PATH, with_ids=True).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or at & (at - 1) == 0
    pieces = sorted(by_doc[3], key=lambda p: p.start)
    ids = [i for p in pieces for i in p.ids]
    assert len(ids) == pieces[0].doc_tokens == 9001 and ids[-1] == 2
    assert sum(p.length for p in by_doc[4]) == 4 and sum(p.length for p in by_doc[None]) == 1
    assert packing.pack(docs.limit(0), PATH).count() == 0


MODEL = json.loads(Tokenizer.from_file(PATH).to_str())["model"]
WORDS = WordIds(PATH)
ORDER = {tuple(m): i for i, m in enumerate(MODEL["merges"])}


def merged(units):
    """A plain loop over the merges of the file."""
    while True:
        ranks = [ORDER.get(pair, len(ORDER)) for pair in zip(units, units[1:])]
        if not ranks or min(ranks) == len(ORDER):
            return units
        at = ranks.index(min(ranks))
        units = units[:at] + ["".join(units[at:at + 2])] + units[at + 2:]


def test_every_plain_token_is_what_its_bytes_merge_to():
    ranks = plain_ranks(MODEL)
    assert len(ranks) > 40_000
    used = set(ranks.values())
    for token, number in MODEL["vocab"].items():
        if number not in used:
            continue
        end = token.endswith("</w>")
        units = list(token.removesuffix("</w>"))
        units[-1] += "</w>" * end
        assert merged(units) == [token]
    # A merge comes after those that make its two sides.
    made = {"".join(m): i for m, i in ORDER.items()}
    assert all(made.get(a, -1) < i and made.get(b, -1) < i for (a, b), i in ORDER.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aehinorstxyzéàüçßÿœ×÷0129.,;:!-()#*|<>'", min_size=1, max_size=24)))
def test_joined_words_have_the_tokenizers_ids(words):
    WORDS.known.clear()
    found = WORDS.encode([" ".join(words)])[0].tolist()
    assert found == WORDS.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
