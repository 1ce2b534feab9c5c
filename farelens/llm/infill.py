"""Fill-in-the-middle examples, cut at line boundaries found through a learned rank index.

A text's units are its lines, ``[^\\n]*\\n|[^\\n]+``, matched left to right, so that a text of
n lines has n + 1 boundaries.  The document's id decides, by a hash, which two boundaries cut
it, whether it is changed at all and in which order its parts are put.  Each Arrow batch of
texts is one run of bytes: the boundaries of all its texts, one after the other, are indexed by
``ranks.RankIndex``, and a cut is the index's value at the rank of the text's first boundary plus
the number drawn.  A batch holds whole texts and is bounded by the session's Arrow settings (a
single longer text is a batch by itself), so memory does not grow with the data, nothing is
shuffled, and a task that is run again gives the same rows.

``output`` is the text itself (``plain``), ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (``psm``)
or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (``spm``); ``restored`` gives the text back.

Defined results: a null text is empty; an empty text has no units and stays plain, as does a text
that holds one of the three markers; a null id is hashed as an empty one; repeated rows are
treated alike; an empty table gives no rows.  Only the id and the text are read, so further
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from farelens.llm.ranks import RankIndex

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
NEWLINE = 10
SCHEMA = ("doc_id {0}, n long, form string, prefix_chars long, middle_chars long, output string")


def draws(doc: str, seed: int) -> list[Column]:
    """Four whole numbers below 2^32 from the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc).cast("string"), F.lit(""))),
                    256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc: str = "doc_id", text: str = "text", seed: int = 7,
                   rate: int = 100, spm: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document.

    ``rate`` percent of the documents are changed, ``spm`` percent of these put the suffix
    first.  Lengths are code points, null where the form is plain.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    first, second, third, fourth = draws(doc, seed)
    stays = (body == "") | (third % 100 >= rate)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        stays = stays | F.contains(body, F.lit(marker))
    form = F.when(stays, "plain").when(fourth % 100 < spm, "spm").otherwise("psm")
    drawn = docs.select(F.col(doc).alias("doc_id"), body.alias("text"), form.alias("form"),
                        first.alias("first"), second.alias("second"))
    return drawn.mapInArrow(_cut_batches, SCHEMA.format(drawn.schema["doc_id"].dataType
                                                        .simpleString()))


def restored(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .otherwise(F.concat(parts[2], parts[3], parts[1])))


def boundaries(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all unit boundaries of consecutive texts, and the rank of each text's first.

    ``ends`` holds the start of the first text and the end of every text in ``data``.
    """
    after = np.flatnonzero(data[ends[0]:ends[-1]] == NEWLINE) + ends[0] + 1
    starts, stops = ends[:-1], ends[1:]
    # A text's newlines end units; what follows the last one is a unit more.
    lines = np.searchsorted(after, stops, side="right") - np.searchsorted(
        after, starts, side="right")
    open_end = (stops > starts) & (data[np.maximum(stops - 1, 0)] != NEWLINE)
    counts = lines + open_end
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    found = np.empty(first[-1], np.int64)
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    tails = first[1:][open_end] - 1
    inner[tails] = False
    found[first[:-1]] = starts
    found[tails] = stops[open_end]
    found[inner] = after
    return found, first


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _cut(batch)


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(1).cast(pa.large_binary())
    _, places, raw = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(1, np.uint8)
    found, first = boundaries(data, ends)
    index = RankIndex(found)
    n = np.diff(first) - 1
    forms = np.array(batch.column(2).to_pylist(), object)
    draws = [batch.column(i).to_numpy() % (n + 1) for i in (3, 4)]
    left = index.offsets(first[:-1] + np.minimum(*draws))
    right = index.offsets(first[:-1] + np.maximum(*draws))
    sizes, outputs = np.zeros((2, len(n)), np.int64), []
    for i, form in enumerate(forms):
        start, a, b, stop = int(ends[i]), int(left[i]), int(right[i]), int(ends[i + 1])
        prefix, middle, suffix = (data[x:y].tobytes().decode() for x, y in (
            (start, a), (a, b), (b, stop)))
        sizes[:, i] = len(prefix), len(middle)
        if form == "psm":
            outputs.append(f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")
        elif form == "spm":
            outputs.append(f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
        else:
            outputs.append(prefix + middle + suffix)
    plain = forms == "plain"
    return pa.RecordBatch.from_arrays([
        batch.column(0), pa.array(n, pa.int64()), batch.column(2),
        pa.array(sizes[0], pa.int64(), mask=plain), pa.array(sizes[1], pa.int64(), mask=plain),
        pa.array(outputs, pa.string()),
    ], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
