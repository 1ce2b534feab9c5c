"""Quality rules, line first: lines that fail a rule go, documents losing too much go too.

Words are runs of other than ASCII white space.  A line fails when it is

* markup: at least two characters of ``#*$%&|<>``, and one or more per three words;
* shouting: at least two words, and half of all, end in two marks ``!`` or ``?``;
* navigation: fewer than four words and no closing punctuation;
* unpunctuated: four words or more and no mark ``.,;:!?`` anywhere;
* boilerplate: ``PHRASES`` make up a fifth of its words or more, or it equals an earlier line;
* repetition: it has ten words or more of which at most a third are different, and half of them
  or more lie in some ``STRETCH`` consecutive words (in the whole line, if it has fewer) of which
  at most a third are different, or over half in 13-word windows found twice or more.  Long
  prose has few different words, but not in every stretch.

A document is rejected when failing lines hold more than ``most_lost`` percent of its words,
or when it fails the base rules: fewer than ``least_words`` words, or more than
``most_repeated`` percent of the words lie in three-word windows found twice or more.

Defined results: null and empty texts have no words and fail the base rules; lines without
words never fail; repeated rows are judged alike; an empty table gives no rows; texts of any
length are judged whole.  Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from farelens.llm.tables import edit_texts

SYMBOLS = re.compile(rb"[#*$%&|<>]")
MARKS = re.compile(rb"[.,;:!?]")
# What may close a line, and phrases of lines that are about the site.
CLOSING = (".", "!", "?", ":", ";", '"', "'", ")", "…", "”", "»", "。")
PHRASES = ("all rights reserved", "licensed under", "released under the", "is licensed under",
           "cookie policy", "privacy policy", "terms of use", "terms of service",
           "enable javascript", "lorem ipsum", "click here", "subscribe to our")
STRETCH = 200
_CLOSING = tuple(x.encode() for x in CLOSING)
_PHRASES = re.compile("|".join(map(re.escape, PHRASES)).encode())


class Judged(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    n_lost_words: int
    kept: bool
    text: str | None


def repeated_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    size = len(ids)
    pairs = w[:-1] * size + w[1:]
    if size ** 3 >= 2 ** 63:  # number the pairs, so that a triple fits
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * size + w[2:]
    order = np.argsort(triples)
    same = np.flatnonzero(triples[order[1:]] == triples[order[:-1]])
    twice = np.zeros(n - 2, bool)
    twice[order[same]] = twice[order[same + 1]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def repeats_itself(words: list[bytes]) -> bool:
    """Whether a line repeats itself, by measures that do not fall with its length."""
    n = len(words)
    if n < 10 or len(set(words)) * 3 > n:
        return False
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    size = min(n, STRETCH)
    # A word counts in the stretches that hold it but not the same word before it.
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    before = np.full(n, -1)
    before[order[1:][same]] = order[:-1][same]
    at = np.arange(n)
    first, last = np.maximum(before, at - size) + 1, np.minimum(at, n - size)
    counted = first <= last
    different = np.cumsum(np.bincount(first[counted], minlength=n + 1)
                          - np.bincount(last[counted] + 1, minlength=n + 1))[:n - size + 1]
    poor = np.flatnonzero(different * 3 <= size)
    inside = np.cumsum(np.bincount(poor, minlength=n + 1)
                       - np.bincount(poor + size, minlength=n + 1))[:n] > 0
    if 2 * int(inside.sum()) >= n:
        return True
    if n < 14:
        return False
    for step in (1, 2, 4, 5):  # numbers of windows of 2, 4, 8, 13 words
        w = np.unique(w[:-step] * (int(w.max()) + 1) + w[step:], return_inverse=True)[1]
    twice = np.flatnonzero(np.bincount(w)[w] > 1)
    covered = np.zeros(n, bool)
    for shift in range(13):
        covered[twice + shift] = True
    return 2 * int(covered.sum()) > n


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Whether a line with words fails a rule that needs nothing but the line."""
    n = len(words)
    symbols = len(SYMBOLS.findall(line))
    if symbols >= 2 and symbols * 3 >= n:
        return True
    if line.count(b"!!") + line.count(b"??") + line.count(b"!?") + line.count(b"?!") >= 2:
        shouted = sum(x[-1:] in b"!?" and x[-2:-1] in (b"!", b"?") for x in words)
        if shouted >= 2 and shouted * 2 >= n:
            return True
    if n < 4 and not words[-1].endswith(_CLOSING):
        return True
    if n >= 4 and not MARKS.search(line):
        return True
    if repeats_itself(words):
        return True
    return 5 * sum(len(x.split()) for x in _PHRASES.findall(line.lower())) >= n


def judge_text(text: str | None, least_words: int = 50, most_repeated: int = 50,
               most_lost: int = 50) -> Judged:
    """Measures of one text, the text without failing lines, and whether it stays."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words: list[bytes] = []
    seen: set[bytes] = set()
    good: list[bytes] = []
    dup_lines = lost = 0
    for line in data.split(b"\n"):
        own = line.split()
        if not own:
            good.append(line)
            continue
        words += own
        again = line in seen
        dup_lines += again
        seen.add(line)
        if again or line_fails(line, own):
            lost += len(own)
        else:
            good.append(line)
    n = len(words)
    repeated = repeated_words(words)
    joined = b"".join(words)
    failed = n < least_words or 100 * repeated > most_repeated * n
    # Continuation bytes of UTF-8 are 0x80-0xBF; every other byte starts a code point.
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    return Judged(n, chars, len(SYMBOLS.findall(data)), dup_lines, repeated, failed, lost,
                  not failed and 100 * lost <= most_lost * n,
                  text if not lost else b"\n".join(good).decode("utf-8", "surrogatepass"))


RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, n_lost_words long, kept boolean, "
          "clean_text string")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Measures, verdict and cleaned text of every document, in the columns of ``RESULT``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = to_arrow_schema(rows.select(
        "doc_id", *(F.lit(None).cast(x.split()[1]).alias(x.split()[0])
                    for x in RESULT.split(", ")[1:])).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(*(judge_text(x.as_py(), **limits) for x in batch.column(1)))
            columns = [pa.array(x, field.type) for x, field in zip(found, list(schema)[1:])]
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return rows.mapInArrow(run, RESULT)


def clean(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The documents that stay, without their failing lines; columns as they were."""
    def edit(value: str | None) -> tuple[bool, str | None]:
        found = judge_text(value, **limits)
        return found.kept, found.text

    return edit_texts(docs, edit, text)
