"""Sum-of-squares online packing of token ids into windows.

Every task packs the documents it reads, as they come, without a shuffle.  A level array
counts the partly filled windows by fill.  A document goes to the level (or to a new window)
after which the sum of the squared counts is smallest, which steers the fills to an even
spread, so that a fitting gap is at hand for most lengths.  Of equal choices the fullest
level wins.  A document longer than a window fills whole windows first; its rest is placed.

When a task ends, or ``most_open`` windows are open (which bounds memory), the open windows
are closed: the emptiest ones are cut to fill up the fullest.  What is left in the end, less
than one window in each task, is cut into sequences whose lengths are powers of two.  So no
sequence needs padding.

Defined results: a null or empty text has no ids but the closing one; rows with null or
repeated ids are documents of their own; sequence ids are unique, not dense; an empty table
gives no rows.  Sequence ids depend on how the table is dealt to tasks, and a rerun task
gives the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from farelens.llm.tables import lean
from farelens.llm.wordpieces import word_ids


class Piece(NamedTuple):
    doc: tuple  # id, number of ids
    start: int
    ids: np.ndarray

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (self._replace(ids=self.ids[:at]),
                self._replace(start=self.start + at, ids=self.ids[at:]))


Window = list[Piece]


class Packer:
    """Places pieces online and hands out finished windows."""

    def __init__(self, size: int, most_open: int):
        self.size, self.most_open = size, most_open
        self.level = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[Window]] = {}
        self.n_open = 0

    def choose(self, length: int) -> int:
        """The level to place ``length`` ids into; 0 is a new window."""
        n = self.level
        best, least = 0, 2 * n[length] + 1
        top = self.size - length
        fills = np.flatnonzero(n[1:top + 1]) + 1
        if len(fills):
            # From n to n - 1 there, from n to n + 1 at the new fill; full windows don't count.
            change = 2 - 2 * n[fills] + 2 * n[fills + length]
            if fills[-1] == top:
                change[-1] = 1 - 2 * n[top]
            at = len(fills) - 1 - int(np.argmin(change[::-1]))
            if change[at] <= least:
                best = int(fills[at])
        return best

    def add(self, piece: Piece) -> Iterator[Window]:
        while len(piece.ids) >= self.size:
            full, piece = piece.cut(self.size)
            yield [full]
        if not len(piece.ids):
            return
        at = self.choose(len(piece.ids))
        window: Window = []
        if at:
            window = self.open[at].pop()
            self.level[at] -= 1
            self.n_open -= 1
        window.append(piece)
        fill = at + len(piece.ids)
        if fill == self.size:
            yield window
            return
        self.put(window, fill)
        if self.n_open > self.most_open:
            yield from self.close(last=False)

    def put(self, window: Window, fill: int) -> None:
        self.open.setdefault(fill, []).append(window)
        self.level[fill] += 1
        self.n_open += 1

    def close(self, last: bool = True) -> Iterator[Window]:
        """Fill up the fullest windows from the emptiest ones."""
        windows = [(fill, w) for fill in sorted(self.open) for w in self.open[fill]]
        self.level[:] = 0
        self.open, self.n_open = {}, 0
        low, rest, have = 0, [], 0
        while low < len(windows) or rest:
            if not rest:
                have, rest = windows[low][0], windows[low][1][::-1]
                low += 1
            if low == len(windows):
                break
            fill, window = windows.pop()
            while fill < self.size and (rest or low < len(windows)):
                if not rest:
                    have, rest = windows[low][0], windows[low][1][::-1]
                    low += 1
                piece = rest.pop()
                if len(piece.ids) > self.size - fill:
                    piece, later = piece.cut(self.size - fill)
                    rest.append(later)
                window.append(piece)
                fill += len(piece.ids)
                have -= len(piece.ids)
            if fill == self.size:
                yield window
            else:
                have, rest = fill, window[::-1]
        if not rest:
            return
        if not last:
            self.put(rest[::-1], have)
            return
        for bit in reversed(range(have.bit_length())):
            if have >> bit & 1:
                window, room = [], 1 << bit
                while room:
                    piece = rest.pop()
                    if len(piece.ids) > room:
                        piece, later = piece.cut(room)
                        rest.append(later)
                    window.append(piece)
                    room -= len(piece.ids)
                yield window


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end: int = 2, size: int = 4096,
         most_open: int = 2048, doc_id: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """One row per piece, in the columns of ``PIECES``, with the ids themselves on request.

    ``tokenizer`` is the path of a tokenizers file that every executor has.
    """
    types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
    names = PIECES.split()[::2] + ["ids"] * with_ids

    def rows(windows: Iterator[Window]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        for window in windows:
            offset = 0
            for (doc, tokens), start, ids in window:
                held.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                             tokens, number, offset, *[ids.astype("i4")] * with_ids))
                offset += len(ids)
            number += 1
            if len(held) >= 4096:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[Window]:
            words, packer = word_ids(tokenizer), Packer(size, most_open)
            for b in batches:
                for at in range(0, b.num_rows, 128):
                    part = b.slice(at, 128)
                    found = words.encode(part.column(1).to_pylist())
                    for doc, ids in zip(part.column(0).to_pylist(), found):
                        ids = np.append(ids, np.uint16(end))
                        yield from packer.add(Piece((doc, len(ids)), 0, ids))
            yield from packer.close()

        return rows(windows())

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(lean(run), PIECES + ", ids array<int>" * with_ids)
