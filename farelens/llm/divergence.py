"""Audit of how the sources of a language differ in their words.

Terms are runs of letters (A-Z lower-cased, code points from U+0080 as they are).  A language
keeps the terms that occur in at least ``least`` of its documents.  A group, which is a source
within its language, gives every kept term p = 1 + floor(10^9 (count + 1) / (N + V)), where N
is the group's sum over the V kept terms; the language gives q alike from its own counts.  The
gap f = floor((p - q)^2 / q) is summed over all kept terms for each ordered pair of groups, and
listed for the terms that a group has more of than its language.  All arithmetic is exact.

1. Tasks count terms per group in bounded tables and send partial counts; one shuffle on
   (language, term) adds them up and drops the rare terms, so a frequent term is a few rows per
   task and source, and a language or source with a third of all rows is spread by its terms.
2. The kept terms of a language are dealt by hash to blocks of at most ``cells`` counts
   (terms times sources).  A block's counts become hash-consed segment trees, one per group,
   over the block's term ids, which follow the terms' frequency so that alike stretches fall
   together; two trees are walked at once and every pair of equal nodes is priced once
   (``segtrees``).  Sums over blocks are added by Spark.
3. Listed terms are ranked by a window that Spark cuts to ``top`` rows per task and group
   before its shuffle.

The pairs of a language's sources are the result asked for and grow with the square of their
number; their memory in a task is that of ``cells`` counts.  Group tables have a row per group
and are left to Spark's size threshold.

Defined results: null texts, languages and sources are empty strings; a group without terms has
pairs but no listed terms; without kept terms all pairs are 0; rows of a repeated id are
documents of their own; an empty table gives no rows.  Only the three named columns are read, so
further columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from farelens.llm.segtrees import EMPTY, Forest
from farelens.llm.tables import store

UNIT = 10 ** 9
HELD = 1 << 18  # terms of all groups that a task counts before it sends them
# In bytes of lower-cased UTF-8: ASCII letters and everything beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def counted(docs: DataFrame, lang: str, source: str, text: str, most: int) -> DataFrame:
    """``lang, source, term, n, docs``: partial counts, several rows for a term."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, spread, held = defaultdict(Counter), defaultdict(Counter), 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (its, at), counts in totals.items():
                own = spread[its, at]
                size = len(counts)
                if size:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([its] * size, pa.string()), pa.array([at] * size, pa.string()),
                        pa.array(counts, pa.binary()).cast(pa.string()),
                        pa.array(counts.values(), pa.int64()),
                        pa.array([own[t] for t in counts], pa.int64())], names=names)
            totals.clear()
            spread.clear()

        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for group, raw in zip(groups, batch.column(2).cast(pa.large_binary())):
                # Lower-casing bytes changes A-Z alone.
                terms = TERM.findall(raw.as_py().lower())
                counts = totals[group]
                before = len(counts)
                counts.update(terms)
                spread[group].update(set(terms))
                held += len(counts) - before
                if held >= most:
                    yield from flush()
                    held = 0
        yield from flush()

    filled = [F.coalesce(F.col(c), F.lit("")) for c in (lang, source, text)]
    return docs.select(*filled).mapInArrow(
        run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, lang: str, source: str, text: str, least: int,
               held: int = HELD) -> DataFrame:
    """``lang, term, total, counts``: kept terms with ``source, n`` where they occur."""
    parts = counted(docs, lang, source, text, held).repartition("lang", "term")
    by_group = parts.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_group.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("counts"),
    ).where(F.col("docs") >= least).drop("docs")


def group_sizes(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """``lang, source, n, v, n_lang, groups`` of every group that occurs."""
    occurs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in (
        (lang, "lang"), (source, "source"))]).distinct()
    sums = kept.select("lang", F.explode("counts").alias("c")).groupBy(
        "lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    zero = F.lit(0).cast("long")
    return occurs.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "n_lang")],
        F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("groups"))


def weight(count: str, n: str) -> Column:
    """1 + floor(10^9 (count + 1) / (n + v)), in decimals so that nothing overflows."""
    return F.expr(f"1 + (CAST({count} + 1 AS DECIMAL(20, 0)) * {UNIT} div ({n} + v))")


def top_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank``: what a group has more of than its language."""
    rows = kept.select("lang", F.col("term").alias("item"), "total", F.inline("counts")).withColumn(
        "count", F.col("n")).drop("n").join(groups, ["lang", "source"])
    above = rows.withColumns({"p": weight("count", "n"), "q": weight("total", "n_lang")}).where(
        "p > q").withColumn("value", F.expr("(p - q) * (p - q) div q"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return above.select("lang", "source", "item", "value",
                        F.row_number().over(best).alias("rank")).where(F.col("rank") <= top)


def pair_gaps(kept: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """``lang, source, item, value``: each group against every other source of its language."""
    blocks = F.greatest(F.ceil(F.col("v") * F.col("groups") / cells), F.lit(1))
    langs = groups.groupBy("lang").agg(F.first(blocks).alias("blocks"))
    terms = kept.join(langs, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "total",
        F.col("counts.source").alias("sources"), F.col("counts.n").alias("n"))
    places = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias(
        "block"), "source", "n", "v")
    parts = terms.groupBy("lang", "block").cogroup(places.groupBy("lang", "block")).applyInArrow(
        _block_gaps, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _block_gaps(terms: pa.Table, places: pa.Table) -> pa.Table:
    names = places["source"].to_pylist()
    sizes = [n + v for n, v in zip(places["n"].to_pylist(), places["v"].to_pylist())]
    number = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), terms.num_rows), np.int64)
    if terms.num_rows:
        order = np.argsort(-terms["total"].to_numpy(), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        listed = terms["sources"].combine_chunks()
        own = listed.flatten().dictionary_encode()
        found = np.array([number[x] for x in own.dictionary.to_pylist()])[own.indices.to_numpy()]
        leaves = np.repeat(rank, np.diff(listed.offsets.to_numpy()))
        counts[found, leaves] = terms["n"].combine_chunks().flatten().to_numpy()
    forest = Forest(counts)
    known = [int(x) for x in forest.values]
    weights = [np.array([0 if x == EMPTY else 1 + UNIT * (x + 1) // size for x in known])
               for size in sizes]
    out = []
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            def price(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                p, q = weights[i][a], weights[j][b]
                gap = (p - q) ** 2
                return gap // np.maximum(q, 1), gap // np.maximum(p, 1)

            there, back = forest.total(i, j, price)
            out += [(names[i], names[j], there), (names[j], names[i], back)]
    sources, items, values = zip(*out) if out else ((), (), ())
    lang = places["lang"][0].as_py() if places.num_rows else ""
    return pa.table({
        "lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(sources, pa.string()),
        "item": pa.array(items, pa.string()), "value": pa.array(values, pa.int64())})


def audit(docs: DataFrame, least: int = 3, top: int = 200, cells: int = 1 << 19,
          lang: str = "lang", source: str = "source", text: str = "text",
          held: int = HELD) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` with all other sources of the
    language as items, and part ``term`` with the ``top`` terms."""
    kept = store(kept_terms(docs, lang, source, text, least, held), "terms")
    groups = store(group_sizes(docs, kept, lang, source), "groups")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_gaps(kept, groups, cells).withColumn("rank", F.row_number().over(best))
    terms = top_terms(kept, groups, top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"
                        ).unionAll(terms.select("lang", "source", F.lit("term").alias("part"),
                                                "item", "value", "rank"))
