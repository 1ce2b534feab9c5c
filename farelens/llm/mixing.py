"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

1. Every document is measured once; from then on only ids, sources and sizes are read.
2. Sources, in code point order with null last, take the weights in turn.  Their targets share
   the budget by weight, but none is above ``most`` times its source: the sources that reach
   this limit soonest are filled first, the rest share what is left.
3. The budget, as blocks of equally many words, goes to the sources by highest quotients
   ``target / (2k + 1)``, and each source's blocks by the same rule to its shards, which are
   hash ranges of its documents of about ``shard_words`` words: an integer quota per shard.
4. A shard is the run of its documents' words in a seeded order.  A quota beyond the shard's own
   words is whole passes over it first; the blocks still due are picked by a seeded permutation
   of the shard's blocks, which needs neither a sort nor a shuffle of blocks.

Scale: the words of a shard are bounded, so a source with a third of all rows is many shards, and
running totals stay inside one.  Windows that take all sources, or all shards of a source, work
on one row per source or shard (and at most three candidates each, see ``apportion``), never on
documents or blocks.  The small tables are stored and left to Spark's size threshold.  Nothing
depends on task order, so reruns agree.

Bounds: the words taken from a source are within a block of its target, and half a block more
for each of its shards but the first; a document is taken at most ``most`` times.  Defined
results: a null text has no words; null sources are one source; documents without words are
taken 0 times; with no words at all every target is 0; rows of equal id and size are
interchangeable; a null id is hashed as an empty one; an empty table gives no rows.  Only the
three named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from farelens.llm.tables import store

WORD = r"[^\x20\x09-\x0D]+"
# Primes above any number of blocks in a shard, steps of its permutation.
STEPS = [2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543,
         2147483497]


def hexed(text: Column, first: int, digits: int) -> Column:
    """Some hexadecimal digits of a text's digest as a whole number."""
    return F.conv(F.substring(F.md5(text), first, digits), 16, 10).cast("long")


def measured(docs: DataFrame, doc: str, text: str, source: str, seed: int) -> DataFrame:
    """``doc_id, source, size, key``: words of each document and its place in seeded order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc).cast("string"), F.lit("")))
    return docs.select(
        F.col(doc).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hexed(name, 1, 15).alias("key"))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source, place, source_size, target`` of every source, and the whole ``budget``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "place", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)
    everything = Window.partitionBy()
    filled = found.withColumns({
        "weight": weight.cast("long"), "cap": F.col("source_size") * most,
        "budget": F.floor(F.sum("source_size").over(everything) * F.lit(share)).cast("long"),
    }).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "place")
    left = F.col("budget") - F.coalesce(
        F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weighed = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    ranked = filled.withColumns({"left": left, "weighed": weighed}).withColumn(
        "full", F.col("ratio") <= F.col("left") / F.col("weighed"))
    # The first source below its limit says what all of those below it share.
    rest = F.min(F.when(~F.col("full"), F.struct("ratio", "place", "left", "weighed"))).over(
        everything)
    return ranked.withColumn("rest", rest).select(
        "source", "place", "source_size", "budget", F.when(
            F.col("full"), F.col("cap").cast("double")).otherwise(
            F.col("rest.left") * F.col("weight") / F.col("rest.weighed")).alias("target"))


def apportion(rows: DataFrame, group: Sequence[str], tie: Sequence[str], votes: str,
              seats: str) -> DataFrame:
    """``rows`` with a ``quota``: the group's ``seats`` by highest quotients votes / (2k + 1).

    ``seats`` is the same in all rows of a group; ``tie`` orders equal quotients and is unique
    in the group.  No seat is dealt by itself: every row first gets what a divisor gives it that
    is surely too large, which leaves at most as many seats as there are rows, and only the next
    quotients of each row (at most three for each row on average) are ranked for those.
    Rows without votes get none.
    """
    whole = Window.partitionBy(*group)
    split = F.col("votes") / F.sum("votes").over(whole)
    n = F.count(F.lit(1)).over(whole)
    known = rows.where(F.col(votes) > 0).select(
        *group, *tie, F.col(votes).cast("double").alias("votes"), F.col(seats).alias("seats"))
    sure = F.greatest(F.col("seats") - F.col("n") / 2, F.lit(0.0)) * (1 - 1e-12)
    based = known.withColumns({"split": split, "n": n}).withColumn(
        "base", F.floor(F.col("split") * sure + 0.5))
    more = F.floor(F.col("split") * F.col("n")) + 1
    offered = based.withColumn(
        "due", F.col("seats") - F.sum("base").over(whole)).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), more)).alias("next"))
    by_quotient = whole.orderBy(
        (F.col("votes") / (2 * (F.col("base") + F.col("next")) + 1)).desc(), *tie, "next")
    won = offered.withColumn("rank", F.row_number().over(by_quotient)).groupBy(
        *group, *tie).agg(
        (F.first("base") + F.count_if(F.col("rank") <= F.col("due"))).alias("quota"))
    return rows.join(won, [*group, *tie], "left").withColumn(
        "quota", F.coalesce("quota", F.lit(0).cast("long")))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, most: int = 3,
        block: int = 32, shard_words: int = 1 << 22, seed: int = 11, doc: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """What the mix takes of every document.

    ``doc_id, source, size, source_size, target, shard, copies, spans``: the document's words
    are taken ``copies`` times as a whole and those of ``spans`` (start and length, in words)
    once more.
    """
    sizes = store(measured(docs, doc, text, source, seed), "sizes")
    sources = targets(sizes, weights, share, most).withColumns({
        "shards": F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)),
        "blocks": F.floor((F.col("budget") + block // 2) / block),
        "one": F.lit(1)})
    sources = store(apportion(sources, ["one"], ["place"], "target", "blocks"), "sources")
    dealt = sizes.join(sources.withColumnRenamed("source", "its"),
                       sizes["source"].eqNullSafe(F.col("its"))).select(
        "doc_id", "source", "size", "key", "place", "source_size", "target",
        F.col("quota").alias("blocks"), F.pmod("key", "shards").alias("shard"))
    cells = dealt.groupBy("place", "shard").agg(
        F.sum("size").alias("words"), F.first("blocks").alias("blocks"))
    cells = apportion(cells, ["place"], ["shard"], "words", "blocks")
    given = F.col("quota") * block
    copies = F.least(F.coalesce(F.floor(F.try_divide(given, F.col("words"))), F.lit(0)),
                     F.lit(most))
    name = F.concat_ws(":", F.lit(seed), "place", "shard")
    steps = F.array(*map(F.lit, STEPS))
    cells = store(cells.select(
        "place", "shard", copies.alias("copies"),
        F.ceil(F.col("words") / block).alias("n"),
        F.when(copies < most, F.floor((given - copies * F.col("words") + block // 2) / block))
        .otherwise(0).cast("long").alias("extra"),
        F.element_at(steps, (hexed(name, 1, 4) % len(STEPS) + 1).cast("int")).cast("long")
        .alias("step"), hexed(name, 5, 8).alias("shift")), "shards")
    run = Window.partitionBy("place", "shard").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    begin = F.sum("size").over(run) - F.col("size")
    placed = dealt.drop("blocks").withColumn("begin", begin).join(cells, ["place", "shard"])
    end = F.col("begin") + F.col("size")
    mine = F.when((F.col("size") > 0) & (F.col("extra") > 0), F.sequence(
        F.floor(F.col("begin") / block), F.floor((end - 1) / block)))
    taken = F.filter(mine, lambda i: (
        (i * F.col("step") + F.col("shift")) % F.col("n") < F.col("extra")))
    spans = F.transform(taken, lambda i: F.struct(
        (F.greatest(i * block, F.col("begin")) - F.col("begin")).alias("start"),
        (F.least((i + 1) * block, end) - F.greatest(i * block, F.col("begin"))).alias("length")))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    return placed.select("doc_id", "source", "size", "source_size", "target", "shard", "copies",
                         F.coalesce(spans, none).alias("spans"))


def words_taken() -> Column:
    """Words that the mix takes of a row of ``mix``, repeats counted."""
    return F.col("copies") * F.col("size") + F.aggregate(
        "spans", F.lit(0).cast("long"), lambda s, x: s + x["length"])
