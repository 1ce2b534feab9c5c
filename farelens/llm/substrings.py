"""Substring deduplication by level-wise doubling.

A word goes when a window of ``window`` consecutive words covers it that also starts in a
document with a smaller id.  Windows are compared in two lengths:

1. Half the length.  Of the half-length windows inside a window the one with the smallest
   hash stands for it; equal windows have equal ones.  Documents are held in chunks of some
   megabytes; a chunk sends the owners of hash ranges its distinct hashes, Golomb-coded, and
   gets back a bitmap of those that other chunks have.
2. Twice that, the full length.  Only windows whose half-length hash occurs in two documents
   are extended.  Chunks send their hashes of 128 bits, of which the first half is coded and
   the second is sent as it is, with the smallest id that has them, and get back a bitmap of
   those that a smaller id has elsewhere.  Among 10^13 windows two different ones are taken
   for equal with a probability below 1e-12.

Nothing survives beyond: a longer repeat is a union of full windows, which are decided.

A hash is sent once per chunk however often it occurs, so a passage in a third of all
documents is one number per chunk, and an owner's group is a range of hashes, a share of
one in ``owners`` (four times the shuffle partitions).  Chunks are stored once and both steps
read them there, so that a rerun task sees the same chunks.

Words are runs of other than ASCII white space.  Defined results: a null or empty text has no
words; null ids count as larger than all others; equal ids are not smaller than each other, so
repeated rows stay; a text that loses nothing stays as it was, another is its words joined by
one space; an empty table gives no rows; columns beside id and text are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from farelens.llm import golomb
from farelens.llm.tables import freed, lean, store

CHUNK = 4 << 20  # bytes of text
BITS = 48
MOST_WORDS = 1 << 18  # words whose hashes are remembered
LAST = 2 ** 63 - 1
# Odd factors, one per position, for either half of a window's hash.
_KEYS, _MORE = np.random.default_rng(23).integers(
    0, 2 ** 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SENT = "array<struct<owner:int,sent:binary,own:binary>>"
_SENT_TYPE = pa.list_(pa.struct([("owner", pa.int32()), ("sent", pa.binary()),
                                 ("own", pa.binary())]))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def windows(w: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of so many words."""
    n = len(w) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, length, np.uint64)
    for j in range(length):
        out += w[j:j + n] * _KEYS[j]
    return mixed(out)


def further_halves(w: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The second half of the hashes of some windows, from the words' hashes mixed anew."""
    again = mixed(w ^ np.uint64(0x9E3779B97F4A7C15))
    out = np.full(len(starts), length, np.uint64)
    for j in range(length):
        out += again[starts + j] * _MORE[j]
    return mixed(out)


def grouped(hashes: np.ndarray, further: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts hashes of two halves, and where in it another one starts."""
    order = np.lexsort((further, hashes))
    a, b = hashes[order], further[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def half_hashes(w: np.ndarray, window: int) -> np.ndarray:
    """For each full window the smallest hash of the half-length windows in it."""
    half = (window + 1) // 2
    inner = windows(w, half) & np.uint64((1 << BITS) - 1)
    n = len(w) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = inner[:n].copy()
    for j in range(1, window - half + 1):
        np.minimum(out, inner[j:j + n], out=out)
    return out


class Chunk:
    """Documents of a batch, by id, with the hashes of their words."""

    def __init__(self, batch: pa.RecordBatch, doc_id: str, text: str):
        ids = batch.column(batch.schema.get_field_index(doc_id)).to_pylist()
        self.order = np.array([LAST if i is None else i for i in ids], np.int64)
        self.texts = batch.column(batch.schema.get_field_index(text))
        self.by_id = np.argsort(self.order, kind="stable")
        known: dict[bytes, int] = {}
        self.hashes = []
        for words in self.words:
            if len(known) > MOST_WORDS:
                known.clear()
            for word in set(words).difference(known):
                known[word] = xxhash.xxh3_64_intdigest(word)
            self.hashes.append(
                np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))

    @property
    def words(self) -> Iterator[list[bytes]]:
        """Of each document, split anew: held as objects they take many times the text's bytes."""
        return ((x.as_py() or "").encode().split() for x in self.texts)

    def first_level(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct half-length hashes, and whether two documents here have them."""
        each = [np.unique(half_hashes(w, window)) for w in self.hashes]
        values, count = np.unique(np.concatenate(each), return_counts=True)
        return values, count > 1

    def candidates(self, doc: int, window: int, repeated: np.ndarray,
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and full hashes, in two halves, of the windows whose half-length hash is
        repeated."""
        w = self.hashes[doc]
        starts = np.flatnonzero(found_in(repeated, half_hashes(w, window))[1])
        return starts, windows(w, window)[starts], further_halves(w, starts, window)

    def second_level(self, window: int, repeated: np.ndarray,
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct full hashes of the candidates, in two halves, sorted, and the smallest id
        that has each."""
        each = [self.candidates(d, window, repeated) for d in self.by_id]
        ids = np.repeat(self.order[self.by_id], [len(x[0]) for x in each])
        hashes, further = (np.concatenate([x[k] for x in each]) for k in (1, 2))
        order, new = grouped(hashes, further)  # stable, so the smallest id comes first
        first = order[new]
        return hashes[first], further[first], ids[first]


def found_in(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def places_of(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, further: np.ndarray,
              ) -> np.ndarray:
    """Places of hashes of two halves in a sorted table that has them all."""
    at = np.searchsorted(table[0], hashes)
    while (miss := table[1][at] != further).any():  # equal in the first half only
        at[miss] += 1
    return at


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids as differences from the smallest, in as many bytes as the largest needs."""
    low = int(ids.min())
    width = max(1, (int(ids.max()) - low).bit_length() + 7 >> 3)
    rest = (ids.astype(np.uint64) - np.uint64(low % 2 ** 64)).astype("<u8")
    return low.to_bytes(8, "little", signed=True) + rest.view(np.uint8).reshape(-1, 8)[
        :, :width].tobytes()


def unpack_ids(blob: bytes, n: int) -> np.ndarray:
    rest = np.zeros((n, 8), np.uint8)
    data = np.frombuffer(blob, np.uint8, offset=8).reshape(n, -1)
    rest[:, :data.shape[1]] = data
    return rest.view("<u8").ravel().astype(np.int64) + int.from_bytes(
        blob[:8], "little", signed=True)


def to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", 6))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as found:
        return found.read_next_batch()


def chunked(docs: DataFrame, doc_id: str, text: str, window: int, owners: int) -> DataFrame:
    """``chunk, rows, sent``: documents held together, and what they send at first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def row(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            values, own = Chunk(rows, doc_id, text).first_level(window)
            sent, at = [], 0
            for owner, part in golomb.by_owner(values, owners, BITS):
                sent.append({"owner": owner, "sent": golomb.encode(part),
                             "own": golomb.pack(own[at:at + len(part)])})
                at += len(part)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([to_bytes(rows)], pa.binary()),
                 pa.array([sent], _SENT_TYPE)], names=["chunk", "rows", "sent"])

        held, size = [], 0
        for batch in batches:
            texts, start = batch.column(batch.schema.get_field_index(text)), 0
            for i in range(batch.num_rows):
                size += len(texts[i].as_py() or "") + 64
                if size >= CHUNK:
                    yield row([*held, batch.slice(start, i + 1 - start)])
                    number, held, size, start = number + 1, [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield row(held)

    return docs.mapInArrow(lean(run), f"chunk long, rows binary, sent {_SENT}")


def answers(sent: DataFrame, decide) -> DataFrame:
    """``chunk, owner, bitmap``: each owner decides on the hashes that it was sent."""
    def run(group: pa.Table) -> pa.Table:
        received = [golomb.decode(x) for x in group["sent"].to_pylist()]
        flags = decide(received, group.drop_columns(["sent"]).to_pydict())
        return pa.table({"chunk": group["chunk"], "owner": group["owner"], "bitmap": pa.array(
            [golomb.pack(x) for x in flags], pa.binary())})

    # In Arrow, as workers keep what they import, and pandas is 24 MB of each.
    return sent.groupBy("owner").applyInArrow(freed(run), "chunk long, owner int, bitmap binary")


def elsewhere(received: list[np.ndarray], _: Mapping) -> list[np.ndarray]:
    """Which hashes another chunk has sent too."""
    values, count = np.unique(np.concatenate(received), return_counts=True)
    twice = values[count > 1]
    return [found_in(twice, x)[1] for x in received]


def in_order(part: np.ndarray) -> np.ndarray:
    """Sorted numbers that may be equal, made distinct for the code by adding their places."""
    return part + np.arange(len(part), dtype=np.uint64)


def smaller_elsewhere(received: list[np.ndarray], group: Mapping) -> list[np.ndarray]:
    """Which hashes a smaller id has in another chunk."""
    hashes = np.concatenate([x - np.arange(len(x), dtype=np.uint64) for x in received])
    ids = np.concatenate([unpack_ids(x, len(v)) for x, v in zip(group["ids"], received)])
    order, new = grouped(
        hashes, np.concatenate([np.frombuffer(x, "<u8") for x in group["further"]]))
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    smaller = np.empty(len(ids), bool)
    smaller[order] = least[np.cumsum(new) - 1] < ids[order]
    return np.split(smaller, np.cumsum([len(x) for x in received])[:-1])


def repeated_halves(sent: list[dict], replies: list[dict] | None, owners: int) -> np.ndarray:
    """A chunk's half-length hashes that two documents have, sorted."""
    bitmaps = {x["owner"]: x["bitmap"] for x in replies or []}
    out = [np.zeros(0, np.uint64)]
    for x in sorted(sent or [], key=lambda x: x["owner"]):
        values = golomb.decode(x["sent"])
        hit = golomb.unpack(x["own"], len(values)) | golomb.unpack(
            bitmaps[x["owner"]], len(values))
        out.append(values[hit] + np.uint64(golomb.range_start(x["owner"], owners, BITS)))
    return np.concatenate(out)


def remove(docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text",
           chars: str = "n_chars", digest: bool = False) -> DataFrame:
    """``docs`` with the repeated words taken out of the texts.

    With ``digest`` the rows are ``doc_id, n_words, n_removed, kept_sha256`` instead.  A
    column ``chars``, where there is one, follows a changed text.
    """
    owners = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = store(chunked(docs, doc_id, text, window, owners), "chunks")

    def by_chunk(replies: DataFrame, name: str) -> DataFrame:
        # Bounded by the hashes of one chunk.
        return store(replies, name).groupBy("chunk").agg(
            F.collect_list(F.struct("owner", "bitmap")).alias(name))

    first = by_chunk(answers(
        table.select("chunk", F.inline("sent")).drop("own"), elsewhere), "first")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, rows, sent, replies = (c[i].as_py() for c in batch.columns)
                values, further, ids = Chunk(from_bytes(rows), doc_id, text).second_level(
                    window, repeated_halves(sent, replies, owners))
                parts, at = golomb.by_owner(values, owners, 64), 0
                packed, more = [], []
                for _, part in parts:
                    packed.append(pack_ids(ids[at:at + len(part)]))
                    more.append(further[at:at + len(part)].astype("<u8").tobytes())
                    at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(parts), pa.int64()),
                     pa.array([o for o, _ in parts], pa.int32()),
                     pa.array([golomb.encode(in_order(p)) for _, p in parts], pa.binary()),
                     pa.array(more, pa.binary()), pa.array(packed, pa.binary())],
                    names=["chunk", "owner", "sent", "further", "ids"])

    once = table.join(first, "chunk", "left")
    second = by_chunk(answers(once.select("chunk", "rows", "sent", "first").mapInArrow(
        lean(extend), "chunk long, owner int, sent binary, further binary, ids binary"
    ), smaller_elsewhere), "second")
    place, count = docs.columns.index(text), (
        docs.columns.index(chars) if chars in docs.columns else None)
    digest_schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    schema = docs.schema
    arrow = to_arrow_schema(schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, sent, first_replies, replies = (c[i].as_py() for c in batch.columns)
                rows = from_bytes(rows)
                chunk = Chunk(rows, doc_id, text)
                halves = repeated_halves(sent, first_replies, owners)
                values, further, ids = chunk.second_level(window, halves)
                covered, bitmaps, at = [], {x["owner"]: x["bitmap"] for x in replies or []}, 0
                for owner, part in golomb.by_owner(values, owners, 64):
                    covered.append(golomb.unpack(bitmaps[owner], len(part)))
                    at += len(part)
                smaller = np.concatenate([np.zeros(0, bool), *covered])
                gone = []
                for d, w in enumerate(chunk.hashes):
                    starts, *hashes = chunk.candidates(d, window, halves)
                    p = places_of((values, further), *hashes)
                    hit = starts[smaller[p] | (ids[p] < chunk.order[d])]
                    edge = np.zeros(len(w) + 1, np.int32)
                    np.add.at(edge, hit, 1)
                    np.add.at(edge, hit + window, -1)
                    gone.append(np.cumsum(edge[:-1]) > 0)
                # A text that loses nothing is joined only for its digest.
                kept = [b" ".join(w for w, g in zip(words, marks.tolist()) if not g)
                        if marks.any() else b" ".join(words) if digest else None
                        for words, marks in zip(chunk.words, gone)]
                if digest:
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(rows.schema.get_field_index(doc_id)).cast(pa.int64()),
                         pa.array([len(w) for w in chunk.hashes], pa.int64()),
                         pa.array([int(g.sum()) for g in gone], pa.int64()),
                         pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                        names=["doc_id", "n_words", "n_removed", "kept_sha256"])
                    continue
                columns = list(rows.columns)
                texts = [old if k is None else k.decode()
                         for old, k in zip(columns[place].to_pylist(), kept)]
                columns[place] = pa.array(texts, arrow.field(place).type)
                if count is not None:
                    columns[count] = pa.array(
                        [n if k is None else len(t) for n, k, t in zip(
                            columns[count].to_pylist(), kept, texts)], arrow.field(count).type)
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return once.join(second, "chunk", "left").select(
        "rows", "sent", "first", "second").mapInArrow(lean(finish), digest_schema if digest else schema)


def judge(docs: DataFrame, window: int = 13, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    return remove(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                              F.col(text).alias("text")), window, digest=True)
