"""Fill-in-the-middle against plain cutting, and the rank index against the offsets."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from farelens.llm import infill
from farelens.llm.ranks import RankIndex

SCHEMA = "doc_id long, text string, n long, output string, form string"


def by_hand(doc_id, text, rate=100):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "é\nñ ü\n\n中文字\nx", "has <M> in\nit",
         "<P\n>", "ends <S", "<\n<\n<P", "\r\n\x00 x\n", "long\n" * 30_000,
         "w" * 100_000, ("x" * 300 + "\n") * 50 + "\n" * 500, "same", "same"]


@pytest.mark.parametrize("rate", [100, 40])
def test_matches_plain_cutting_and_gives_the_text_back(spark, rate):
    rows = [(i, x, 1, "clash", "clash") for i, x in enumerate(TEXTS)]
    rows += [(None, "no\nid\n", 0, None, None), (3, "same id\nother", 0, None, None), rows[7]]
    found = infill.fill_in_middle(spark.createDataFrame(rows, SCHEMA).coalesce(1), rate=rate)
    again = found.select("*", infill.restored(found["output"], found["form"]).alias("back"))
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)
           for r in again.collect()]
    assert sorted(got, key=str) == sorted(
        ((i, *by_hand(i, x, rate), x or "") for i, x, *_ in rows), key=str)


def test_an_empty_table_gives_no_rows(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2000), min_size=1, max_size=400), st.sampled_from([0, 3, 126, 900]))
def test_predictions_stay_in_reach_and_are_corrected_exactly(steps, reach):
    offsets = np.cumsum(steps)
    index = RankIndex(offsets, reach)
    ranks = np.arange(len(offsets))
    assert np.array_equal(index.offsets(ranks), offsets)
    assert np.abs(index.predict(ranks) - offsets).max() <= reach + 1


def test_even_lines_need_one_segment():
    index = RankIndex(np.arange(0, 80 * 100_000, 80))
    assert len(index.first) == 1 and index.residual.dtype == np.int8
