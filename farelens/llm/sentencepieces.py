"""SentencePiece encoding over a relational lattice of words, and decoding.

A text becomes words: spaces are marks (U+2581), and a word is a run of marks with what
follows up to the next mark or line end; no piece crosses such a border.  Words are met once
per chunk of documents, then once in all:

1. A chunk of documents stores its distinct words and each document as places among them, in
   buckets of the chunk, so that it is not shuffled when the ids come back.
2. Words go to an owner, are made distinct, and are exploded into all substrings that may be
   a piece.  An equi-join with the piece table (as large as the vocabulary file, hence
   broadcast) leaves the lattice's edges, which are grouped by word again.
3. A higher-order ``aggregate`` folds the edges into the word's ids.
4. Owners return the ids to the chunks, two bytes each, which put the documents together.

The fold is the model's own rule.  For a unigram model it is Viterbi's: positions from left to
right with the best score and the best edge into each.  A BPE model is defined by merges, and
the best sum of its scores is another segmentation; there the fold merges, as often as it can,
the pair of neighbours whose edge has the best score, the leftmost of equals.  Its state is the
set of borders as bits, so words of more than ``LONGEST`` characters are merged by a heap in
Python instead, by the same rule.

Characters without a piece become their bytes' pieces.  Defined results: a null or empty text
has no ids; rows with null or repeated ids are documents of their own; an empty table gives no
rows; texts count whole; only the named columns are read.  ``decode`` gives the text back
exactly, as long as it has no U+2581.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from farelens.llm.tables import lean, store_buckets
from farelens.session import apart

MARK = "▁"
CHUNK = 8 << 20  # characters
LONGEST = 62
_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_UNKNOWN = 10.0  # how far below the worst score a character without a piece is


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says."""

    pieces: dict[str, tuple[int, float]]  # id and score
    texts: list[bytes]  # by id; control pieces are empty
    first_byte: int
    unigram: bool
    prefix: bool

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))


def read_model(path: str) -> Vocabulary:
    """Read a model file whose normalisation is none but the marks, with byte pieces."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    kinds = [p.type for p in model.pieces]
    pieces = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == 1}
    first_byte = kinds.index(6) if 6 in kinds else -1
    if (rules.precompiled_charsmap or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces or model.trainer_spec.model_type not in (1, 2)
            or kinds[first_byte:first_byte + 256] != [6] * 256
            or any(k not in (1, 2, 3, 6) for k in kinds)
            or any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)):
        raise ValueError("this model normalises or splits texts in another way")
    texts = [bytes([i - first_byte]) if k == 6 else
             p.piece.replace(MARK, " ").encode() if k == 1 else b""
             for i, (p, k) in enumerate(zip(model.pieces, kinds))]
    return Vocabulary(pieces, texts, first_byte, model.trainer_spec.model_type == 1,
                      rules.add_dummy_prefix)


def split(text: str | None, prefix: bool) -> list[str]:
    if not text:
        return []
    return _WORD.findall((MARK if prefix else "") + text.replace(" ", MARK))


def merge_long(word: str, vocabulary: Vocabulary) -> list[int]:
    """The merge rule for one word, with a heap of pairs."""
    pieces = vocabulary.pieces
    n = len(word)
    left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    ends = list(range(1, n + 1))
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and right[i] < n:
            found = pieces.get(word[i:ends[right[i]]])
            if found:
                heapq.heappush(heap, (-found[1], i, ends[i], ends[right[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        if not alive[i] or ends[i] != middle or right[i] >= n or ends[right[i]] != end:
            continue
        gone = right[i]
        alive[gone], ends[i], right[i] = False, end, right[gone]
        if right[i] < n:
            left[right[i]] = i
        offer(left[i])
        offer(i)
    out: list[int] = []
    i = 0
    while i < n:
        found = pieces.get(word[i:ends[i]])
        out += [found[0]] if found else [
            vocabulary.first_byte + b for b in word[i:ends[i]].encode()]
        i = right[i]
    return out


def lattice(words: DataFrame, vocabulary: Vocabulary, keys: tuple[str, ...] = ("word",)
            ) -> DataFrame:
    """``words`` (distinct, by ``keys``, of which the last is the word) with ``edges``, all
    substrings that are pieces, the best score and then the leftmost start first.

    An edge is a struct ``s, e, id, score`` after its rank for a unigram model.  Merges only
    compare scores, so there it is one number: rank, start, end and id, see ``_START``.
    """
    spark = words.sparkSession
    ranks = {x: r for r, x in enumerate(sorted({-x for _, x in vocabulary.pieces.values()}))}
    table = spark.createDataFrame(
        [(p, i, s, ranks[-s]) for p, (i, s) in vocabulary.pieces.items()],
        "piece string, id int, score double, rank long")
    word = keys[-1]
    # One row a start, then one an end: what stands between is compiled, unlike a lambda.
    parts = words.withColumn("s", F.explode(F.expr(f"sequence(0, char_length({word}) - 1)"))
                             ).withColumn("e", F.explode(F.expr(
        f"sequence(s + 1, least(char_length({word}), s + {vocabulary.longest}))")))
    edge = F.struct((-F.col("score")).alias("rank"), "s", "e", "id", "score") if (
        vocabulary.unigram) else F.expr(
        "shiftleft(rank, 40) + shiftleft(CAST(s AS LONG), 34) + shiftleft(CAST(e AS LONG), 28) + id")
    edges = parts.select(*keys, "s", "e", F.expr(f"substring({word}, s + 1, e - s)").alias("piece")
                         ).join(F.broadcast(table), "piece").select(*keys, edge.alias("edge"))
    # The word first, as rows are sorted by the first bytes of the first key.
    return edges.groupBy(*reversed(keys)).agg(
        F.sort_array(F.collect_list("edge")).alias("edges"))


# Parts of an edge in one number: rank of the score (23 bits), start and end (6 each), id (28).
_START, _END, _ID = (f"CAST(shiftright(x, {n}) & {m} AS INT)" for n, m in (
    (34, 63), (28, 63), (0, (1 << 28) - 1)))


def _bytes(text: str, vocabulary: Vocabulary) -> str:
    """SQL for the byte pieces of a text; it must not be empty."""
    digits = f"hex(encode({text}, 'UTF-8'))"
    return (f"transform(sequence(0, CAST(length({digits}) / 2 AS INT) - 1), i -> "
            f"{vocabulary.first_byte} + CAST(conv(substring({digits}, 2 * i + 1, 2), 16, 10) AS INT))")


def _ids(word: str, borders: str, vocabulary: Vocabulary) -> str:
    """SQL for the ids between neighbouring ``borders``."""
    found = ("get(filter(edges, x -> x.s = cuts[k] AND x.e = cuts[k + 1]), 0).id"
             if vocabulary.unigram else
             "transform(array(get(filter(edges, x -> shiftright(x, 28) & 4095 = "
             f"64 * cuts[k] + cuts[k + 1]), 0)), x -> {_ID})[0]")
    return f"""
        transform(array({borders}), cuts -> flatten(transform(sequence(0, size(cuts) - 2), k ->
            transform(array({found}),
                id -> CASE WHEN id IS NOT NULL THEN array(id) ELSE {_bytes(
                    f"substring({word}, cuts[k] + 1, cuts[k + 1] - cuts[k])", vocabulary)} END)[0]
            )))[0]"""


def fold_merges(edges: DataFrame, vocabulary: Vocabulary, word: str = "word") -> DataFrame:
    """Replace ``edges`` by ``ids``: merge the best pair until none is left."""
    # Bound as a lambda's argument, the pairs and the mask are worked out once a word; a column
    # would be put into the lambda that reads it, and worked out for each of its steps.
    # A pair has borders at both ends of its edge and one between.  When none is left, the sign
    # is set, and the steps that remain look at nothing.
    whole = f"shiftleft(1L, char_length({word}) + 1) - 1"
    cut = edges.withColumn("borders", F.expr(f"""
        transform(array(transform(filter(edges, x -> {_END} - {_START} > 1), x -> struct(
            shiftleft(1L, {_START}) | shiftleft(1L, {_END}) AS ends,
            (shiftleft(1L, {_END}) - 1) & ~(shiftleft(1L, {_START} + 1) - 1) AS inner))), pairs ->
        transform(array(aggregate(sequence(1, char_length({word})), {whole}, (m, i) -> IF(m < 0, m,
            coalesce(m & ~get(filter(pairs, x -> m & x.ends = x.ends
                                     AND bit_count(m & x.inner) = 1), 0).inner,
                     m | shiftleft(1L, 63))))), mask ->
        filter(sequence(0, char_length({word})), i -> shiftright(mask, i) & 1 = 1))[0])[0]"""))
    return cut.withColumn("ids", F.expr(_ids(word, "borders", vocabulary))).drop(
        "edges", "borders")


def fold_viterbi(edges: DataFrame, vocabulary: Vocabulary, word: str = "word") -> DataFrame:
    """Replace ``edges`` by ``ids``: the segmentation with the best sum of scores."""
    worst = min(s for _, s in vocabulary.pieces.values()) - _UNKNOWN
    reached = edges.withColumn("reached", F.expr(f"""
        aggregate(sequence(1, char_length({word})),
            struct(array(0D) AS best, array(0) AS back),
            (t, e) -> transform(array(array_max(concat(
                array(struct(t.best[e - 1] + {worst}D AS total, 1 - e AS s)),
                transform(filter(edges, x -> x.e = e),
                          x -> struct(t.best[x.s] + x.score AS total, -x.s AS s))))),
                b -> struct(concat(t.best, array(b.total)) AS best,
                            concat(t.back, array(-b.s)) AS back))[0]).back"""))
    cut = reached.withColumn("borders", F.expr(f"""
        aggregate(sequence(1, char_length({word})), array(char_length({word})),
            (b, i) -> IF(b[0] = 0, b, concat(array(reached[b[0]]), b)))"""))
    return cut.withColumn("ids", F.expr(_ids(word, "borders", vocabulary))).drop(
        "edges", "reached", "borders")


def encode_words(words: DataFrame, vocabulary: Vocabulary, keys: tuple[str, ...] = ("word",)
                 ) -> DataFrame:
    """``keys, ids`` of distinct words of at most ``LONGEST`` characters; words without any
    piece have no row."""
    fold = fold_viterbi if vocabulary.unigram else fold_merges
    return fold(lattice(words, vocabulary, keys), vocabulary, keys[-1])


def owners_of(words: list[str], owners: int) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) % owners for w in words], np.int64)


def pack_places(places: np.ndarray) -> bytes:
    """Places among words that are numbered as they first occur.

    A word's first place is 0, as it is the next number, and others are one more than they were.
    Bytes of equal weight stand together.
    """
    first = np.zeros(len(places), bool)
    first[np.unique(places, return_index=True)[1]] = True
    values = np.where(first, 0, places + 1).astype("<u4")
    return pa.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unpack_places(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 4 * n, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)
    return np.where(values == 0, np.cumsum(values == 0) - 1, values - 1)


def chunked(docs: DataFrame, prefix: bool) -> DataFrame:
    """``chunk, doc_ids, ends, places, words``: documents as places among the chunk's distinct
    words, which are parted by the space, as no word has one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known: dict[str, int] = {}
        ids, ends, places, size = [], [0], [], 0

        def row() -> pa.RecordBatch:
            flat = np.concatenate([np.zeros(0, np.int64), *places])
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())),
                 pa.array([pack_places(flat) if len(flat) else b""], pa.binary()),
                 pa.array([" ".join(known)], pa.string())],
                names=["chunk", "doc_ids", "ends", "places", "words"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = split(text.as_py(), prefix)
                for w in words:
                    if w not in known:
                        known[w] = len(known)
                places.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                ids.append(doc.as_py())
                ends.append(ends[-1] + len(words))
                size += sum(map(len, words)) + 64
                if size >= CHUNK:
                    yield row()
                    number, known = number + 1, {}
                    ids, ends, places, size = [], [0], [], 0
        if ids:
            yield row()

    return docs.mapInArrow(lean(run), "chunk long, doc_ids array<long>, ends array<long>, "
                                      "places binary, words string")


def sent(table: DataFrame, owners: int) -> DataFrame:
    """``owner, line``: the words of a chunk that an owner gets, after the chunk's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words in zip(*(c.to_pylist() for c in batch.columns)):
                words = words.split(" ")
                owner = owners_of(words, owners)
                order = np.argsort(owner, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([owner[p[0]] for p in parts], pa.int32()),
                     pa.array([" ".join([str(number), *(words[i] for i in p)]) for p in parts])],
                    names=["owner", "line"])

    return table.where("words <> ''").select("chunk", "words").mapInArrow(
        lean(run), "owner int, line string")


def encode(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, n_ids, ids, round_trip`` of every row; the last tells whether decoding the ids
    gives the text back."""
    # Rows that are dealt by owner serve for words, for edges by word, and for the way back.
    spark = apart(docs.sparkSession, {"spark.sql.requireAllClusterKeysForCoPartition": "false"})
    owners = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = store_buckets(chunked(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                                              F.col(text).alias("text")), vocabulary.prefix),
                          "words", "chunk", reader=spark)
    # Both uses explode alike and need both columns, and no key is null, which the joins would
    # ask of one side only, so they share one exchange.
    lines = sent(table, owners).where("owner IS NOT NULL").repartition("owner").select(
        "owner", F.split("line", " ").alias("line"))
    dealt = lines.select(
        "owner", F.coalesce(F.col("line")[0].cast("long"), F.lit(-1)).alias("chunk"),
        F.posexplode("line").alias("place", "word")).where("place > 0")
    short = F.char_length("word") <= LONGEST
    encoded = encode_words(dealt.where(short).select("owner", "word").distinct(), vocabulary,
                           ("owner", "word"))
    # A word's ids as hexadecimal digits; none where the word is too long for the fold.
    digits = 4 if len(vocabulary.texts) <= 1 << 16 else 8
    ids = dealt.join(encoded, ["owner", "word"], "left").select(
        "chunk", "owner", "place", F.coalesce("ids", F.when(
            short, F.expr(_bytes("word", vocabulary)))).alias("ids")).select(
        "chunk", "owner", F.struct(
            "place", F.coalesce(F.expr("lpad(hex(size(ids)), 4, '0')"), F.lit("0000")).alias("n"),
            F.expr(f"coalesce(array_join(transform(ids, x -> lpad(hex(x), {digits}, '0')), ''), '')"
                   ).alias("ids")).alias("x"))
    returned = ids.groupBy("chunk", "owner").agg(F.sort_array(F.collect_list("x")).alias("x"))
    # Bounded by the words of one chunk.
    returned = returned.select("chunk", F.struct(
        "owner", F.unhex(F.array_join("x.n", "")).alias("n"),
        F.unhex(F.array_join("x.ids", "")).alias("ids")).alias("r")
    ).groupBy("chunk").agg(F.sort_array(F.collect_list("r")).alias("r"))
    kind = f">u{digits // 2}"

    def own_ids(words: list[str], replies: list[dict]) -> list[list[int] | None]:
        """Ids of each word as the owners gave them back, None for none."""
        sizes = np.frombuffer(b"".join(x["n"] for x in replies), ">u2").astype(np.int64)
        flat = np.frombuffer(b"".join(x["ids"] for x in replies), kind).tolist()
        order = np.argsort(owners_of(words, owners), kind="stable").tolist()
        found: list[list[int] | None] = [None] * len(words)
        end = 0
        for i, n in zip(order, sizes.tolist()):
            if n:
                found[i] = flat[end:end + n]
                end += n
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, ends, places, words, replies in zip(
                    *(c.to_pylist() for c in batch.columns)):
                words = words.split(" ") if words else []
                found = own_ids(words, replies or [])
                codes, good = [], np.ones(len(words), bool)
                for i, (word, own) in enumerate(zip(words, found)):
                    own = merge_long(word, vocabulary) if own is None else own
                    good[i] = b"".join(vocabulary.texts[x] for x in own) == word.replace(
                        MARK, " ").encode()
                    codes.append(np.array(own, "<i4").tobytes())
                flat = unpack_places(places, ends[-1]) if ends[-1] else np.zeros(0, np.int64)
                for start in range(0, len(doc_ids), 64):
                    part = range(start, min(start + 64, len(doc_ids)))
                    each = [flat[ends[d]:ends[d + 1]] for d in part]
                    out = [np.frombuffer(b"".join([codes[p] for p in x.tolist()]), "<i4")
                           for x in each]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_ids[d] for d in part], pa.int64()),
                         pa.array([len(x) for x in out], pa.int64()),
                         pa.array(out, pa.list_(pa.int32())),
                         pa.array([bool(good[x].all()) for x in each])],
                        names=["doc_id", "n_ids", "ids", "round_trip"])

    return table.join(returned, "chunk", "left").select(
        "doc_ids", "ends", "places", "words", "r").mapInArrow(
            lean(run), "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of rows of ids; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = 1 if vocabulary.prefix else 0
        for batch in batches:
            texts = [None if x is None else
                     b"".join(vocabulary.texts[i] for i in x)[skip:].decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return rows.select(F.col("doc_id"), F.col(ids)).mapInArrow(run, "doc_id long, text string")
