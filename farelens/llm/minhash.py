"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Signatures need two permutations of ``DIM`` places only.  The first scatters a document's
shingles; coordinate ``k`` is the smallest value of the second, circularly shifted by ``k``,
over the scattered places.  ``BANDS`` bands of ``ROWS`` coordinates make the buckets: two
documents with a similarity of 0.75 share none with a probability of
``(1 - 0.75 ** ROWS) ** BANDS``, 2e-6 for 48 bands of 5, and less when more alike.

Documents with equal sets are represented by the smallest id.  Within a bucket not all pairs
are compared.  The smallest id of a bucket is its pivot.  First each document meets the pivot
with which it shares most buckets, then those whose buckets hold several components still meet
up to ``FURTHER`` more.  Buckets whose members are now in one component are done; that settles
groups of near copies, whatever their size.  The members of the others meet over their rarest
shingles: in one order for all sets (what a single component has first, then by rarity) two
sets so similar have a common one in the first quarter, and from the first common one on both
have as many as they need to have in common.  That loses no link.  No bucket is capped.  A large
group of texts that are alike by little less than asked for still meets pair by pair.  A pair
whose sizes or whose 240 signature bits rule out the similarity is dropped before its sets are
compared in full: ``MOST_BITS`` is six standard deviations above what 0.75 gives (30, 5.1), and
of 214,647 such pairs of sets of 8 to 2,048 shingles none had over 52 differing bits.

Words are runs of other than ASCII white space, A-Z lowered; a document's set has its distinct
``SHINGLE``-word shingles, or all its words as one if it has fewer, as 64-bit hashes.
Defined results: a document without words, or with a null id, has no links and is its own
component; rows with one id are one document with the links of all its rows, and all have its
component; an empty table gives no rows; texts count whole; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from farelens.llm.components import components
from farelens.llm.tables import lean, sift, store

SHINGLE = 5
DIM = 1 << 20
BANDS, ROWS = 48, 5
COORDINATES = BANDS * ROWS
MOST_BITS = 60
FURTHER = 8
MOST_WORDS = 1 << 18  # words that a task remembers
BLOCK = 1 << 18  # words whose signatures are made together
# Odd factors, one per position.
_KEYS = np.random.default_rng(11).integers(0, 2 ** 63, 16, dtype=np.uint64) * np.uint64(2) + (
    np.uint64(1))


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the second one with its end repeated before its start,
    so that a circular shift is a plain offset."""
    rng = np.random.default_rng(7)
    scatter, second = (rng.permutation(DIM).astype(np.int32) for _ in range(2))
    return scatter, np.concatenate([second[-COORDINATES:], second])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str | None], known: dict[bytes, int] | None = None,
                 ) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; ``known`` keeps hashes of words."""
    known = {} if known is None else known
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        n = len(words)
        if len(known) > MOST_WORDS:
            known.clear()
        try:
            w = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        except KeyError:
            for word in set(words).difference(known):
                known[word] = xxhash.xxh3_64_intdigest(word)
            w = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        width = min(n, SHINGLE)
        if n == 0:
            out.append(w)
            continue
        summed = np.full(n - width + 1, width, np.uint64)
        for j in range(width):
            summed += w[j:n - width + 1 + j] * _KEYS[j]
        out.append(np.unique(mixed(summed)))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One column of ``COORDINATES`` values per set; sets must not be empty."""
    scatter, second = permutations()
    places = scatter[(np.concatenate(sets) & np.uint64(DIM - 1)).astype(np.int64)].astype(np.int64)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((COORDINATES, len(sets)), np.int32)
    for k in range(COORDINATES):
        out[k] = np.minimum.reduceat(second[COORDINATES - k:].take(places), starts)
    return out


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One row per set, one hash per band."""
    parts = signature.reshape(BANDS, ROWS, -1).astype(np.uint64)
    summed = (parts * _KEYS[:ROWS, None]).sum(axis=1, dtype=np.uint64)
    summed += mixed(np.arange(1, BANDS + 1, dtype=np.uint64))[:, None]  # names the band
    return mixed(summed).view(np.int64).T


def sketch_bits(signature: np.ndarray) -> np.ndarray:
    """One row per set: the lowest bits of its coordinates, in four numbers."""
    bits = np.zeros((signature.shape[1], 256), np.uint8)
    bits[:, :COORDINATES] = (signature & 1).T
    return np.packbits(bits, axis=1).view(np.int64)


def _blocks(sizes: list[int]) -> Iterator[slice]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > BLOCK:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if sizes:
        yield slice(start, len(sizes))


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, bands, bits`` of every row of ``doc_id, text``.

    ``set_id`` is a 128-bit fingerprint of the set; it and what follows are null for a row
    without words or id.  Hashes of different bands differ.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column(1)
            sizes = [len(x.as_py() or "") // 4 for x in texts]
            for part in _blocks(sizes):
                ids = batch.column(0)[part.start:part.stop]
                sets = shingle_sets(texts[part.start:part.stop].to_pylist(), known)
                live = [i for i, s in enumerate(sets) if len(s) and ids[i].is_valid]
                bands, bits = [None] * len(sets), [None] * len(sets)
                keys = [None] * len(sets)
                if live:
                    signature = signatures([sets[i] for i in live])
                    for i, b, s in zip(live, band_hashes(signature), sketch_bits(signature)):
                        bands[i], bits[i] = b, s
                        keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_id", "bands", "bits"])

    return docs.mapInArrow(lean(run), "doc_id long, n_shingles long, set_id binary, "
                                "bands array<long>, bits array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``node, shingles``: the distinct sets, as hashes, of the rows of ``doc_id, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [s.tobytes() for s in shingle_sets(part.column(1).to_pylist(), known)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in sets]),
                     pa.array(sets, pa.binary())], names=["node", "set_id", "shingles"])

    rows = docs.mapInArrow(lean(run), "node long, set_id binary, shingles binary")
    return rows.groupBy("node", "set_id").agg(F.first("shingles").alias("shingles"))


def similar(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose sets ``su, sv`` are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("u", "v", "su", "sv").mapInArrow(lean(run), "u long, v long")


def prefixes(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``shingle, node, component, n, most``: the rarest shingles of the sets of ``nodes``, each
    set of a node by itself.

    All sets are ordered alike, first what a single component has, then by how many of the nodes
    have it.  Two sets with so similar contents share one of their first
    ``n - ceil(n * percent / 100) + 1`` shingles.  ``most`` of a set's ``n`` shingles, from this
    one on, occur in other components at all; if it is the first that two sets share, no more
    are common.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, component, part, shingles in zip(*batch.columns):
                values = np.frombuffer(shingles.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), x.as_py())) for x in (node, component, part)]
                    + [pa.array(np.full(len(values), len(values))), pa.array(values)],
                    names=["node", "component", "part", "n", "shingle"])

    # Of a fingerprint a number is enough to tell the few sets of a node apart.
    each = sets.join(nodes, "node").select(
        "node", "component", F.xxhash64("set_id").alias("part"), "shingles").mapInArrow(
        lean(run), "node long, component long, part long, n long, shingle long")
    each = store(each, "shingles")
    # Others of the same component need no meeting, so a shingle must have two components.
    counted = each.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("f"), F.min("component").alias("low"),
        F.max("component").alias("high"))
    rest = each.join(counted, "shingle").withColumn("alone", F.col("low") == F.col("high"))
    # From the end of the order, so that the sum needs no row that is still to come.
    backwards = Window.partitionBy("node", "part").orderBy(
        F.col("alone"), F.col("f").desc(), F.col("shingle").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    least = F.ceil(F.col("n") * percent / 100)
    return rest.select(
        "shingle", "node", "component", "n", "alone",
        F.sum((~F.col("alone")).cast("long")).over(backwards).alias("most"),
        F.count(F.lit(1)).over(backwards).alias("place")
    ).where(~F.col("alone") & (F.col("place") >= least) & (F.col("most") >= least)
            ).drop("alone", "place")


def links(docs: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Edges ``u, v`` between ids whose components are the near-duplicate groups, and the
    sketched rows.

    The edges are verified links between representatives, which connect all similar ones, and
    one from each document to the representative of its equal set, the smallest id.
    """
    sketched = store(sketch(docs), "sketch")
    classes = store(
        sketched.where("set_id IS NOT NULL").groupBy("set_id").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"), F.first("bits").alias("bits")), "classes")
    entries = classes.select("node", F.explode("bands").alias("hash"))
    buckets = store(entries.groupBy("hash").agg(
        F.count(F.lit(1)).alias("members"), F.min("node").alias("pivot")
    ).where("members > 1"), "buckets")
    # Entries of buckets with company; the others never come up again.
    entries = store(entries.join(buckets, "hash"), "entries")
    facts = classes.select("node", "n", "bits")
    wanted = store(entries.select(F.xxhash64("node").alias("h")).distinct(), "wanted")
    near, hit = sift(docs, F.xxhash64("doc_id"), wanted)
    sets = store(full_sets(near.where(hit).select("doc_id", "text")), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """The links among the pairs ``u, v``."""
        for side in "uv":
            pairs = pairs.join(facts.select(
                F.col("node").alias(side), F.col("n").alias(f"n{side}"),
                F.col("bits").alias(f"b{side}")), side)
        differ = sum((F.bit_count(F.col("bu")[i].bitwiseXOR(F.col("bv")[i])) for i in range(4)),
                     F.lit(0))
        small, large = F.least("nu", "nv"), F.greatest("nu", "nv")
        pairs = store(pairs.where(
            (100 * small >= percent * large) & (differ <= MOST_BITS)).select("u", "v"), "pairs")
        for side in "uv":
            pairs = pairs.join(sets.select(
                F.col("node").alias(side), F.col("shingles").alias(f"s{side}")), side)
        return similar(pairs, percent)

    ordered = lambda a, b: (F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    # How many buckets a document shares with a pivot says how alike they are.
    shared = store(entries.where("node <> pivot").groupBy("node", "pivot").agg(
        F.count(F.lit(1)).alias("c")), "shared")
    best = shared.groupBy("node").agg(F.max(  # of equal counts the smallest pivot
        F.struct("c", F.bitwise_not("pivot").alias("p"))).alias("x"))
    tested = store(best.select(*ordered(F.bitwise_not("x.p"), F.col("node"))), "tested")
    found = store(verified(tested), "links")

    def labelled(rows: DataFrame, label: DataFrame, node: str = "node",
                 component: str = "component") -> DataFrame:
        label = label.select(F.col("node").alias(node), F.col("component").alias("own"))
        return rows.join(label, node, "left").withColumn(
            component, F.coalesce("own", node)).drop("own")

    label = components(found)
    apart = labelled(labelled(shared, label), label, "pivot", "its").where("component <> its")
    # A document has one pivot a band at most.
    more = apart.select("node", "pivot", "c", *ordered("pivot", "node")).join(
        tested, ["u", "v"], "left_anti").groupBy("node").agg(F.sort_array(F.collect_list(
            F.struct("c", F.bitwise_not("pivot").alias("p"))), False).alias("x"))
    more = store(more.select("node", F.explode(F.slice("x", 1, FURTHER)["p"]).alias("p")
                             ).select(*ordered(F.bitwise_not("p"), F.col("node"))), "tested")
    found = store(found.unionByName(verified(more)), "links")
    tested = tested.unionByName(more)
    # Buckets that hold several components still: their members are compared by prefixes.
    entries = labelled(entries.where("members > 2").select("hash", "node"), components(found))
    entries = store(entries, "labelled")
    mixed_buckets = entries.groupBy("hash").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high").select("hash")
    undecided = entries.join(mixed_buckets, "hash").select("node", "component").distinct()
    marks = store(prefixes(sets, store(undecided, "open"), percent), "prefixes")
    others = marks.select("shingle", F.col("node").alias("other"),
                          F.col("component").alias("its"), F.col("n").alias("m"),
                          F.col("most").alias("its_most"))
    common = F.least("most", "its_most")
    pairs = marks.join(others, "shingle").where("node < other AND component <> its").where(
        100 * common >= percent * (F.col("n") + F.col("m") - common)).select(
        F.col("node").alias("u"), F.col("other").alias("v")).distinct()
    pairs = store(pairs.join(tested, ["u", "v"], "left_anti"), "further")
    found = store(found.unionByName(verified(pairs)), "links")
    copies = sketched.join(classes.select("set_id", "node"), "set_id").where("doc_id <> node")
    return found.unionByName(copies.select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
                             ), sketched


def judge(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    edges, sketched = links(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), percent)
    label = store(components(edges), "groups").withColumnRenamed("node", "doc_id")
    own = F.coalesce("component", "doc_id")
    return sketched.select("doc_id", "n_shingles").join(label, "doc_id", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their group."""
    edges, _ = links(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), percent)
    gone = store(components(edges).where("node <> component").select("node"), "gone")
    found, hit = sift(docs, F.xxhash64(F.col(doc_id).cast("long")),
                      gone.select(F.xxhash64("node").alias("h")))
    maybe = found.where(hit).join(gone, F.col(doc_id) == F.col("node"), "left_anti")
    return found.where(~F.col(hit)).select(*docs.columns).unionByName(
        maybe.select(*docs.columns))
