"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every partition hashes its normalised texts to ``BITS`` bits and sends each hash once,
   sorted and Golomb-coded, to the owner of its range, with a bitmap of hashes it has twice.
2. An owner counts a range's hashes over all senders and answers each sender with a bitmap of
   those that somebody else has too.
3. Senders read their suspect hashes from the bitmaps.  Rows whose hash is not suspect are
   unique and are never shuffled; suspect rows are shuffled and grouped by their bytes.

The suspects go to the scan as a bit filter of ``filter_bits`` bits, at most
``filter_bits / 64`` small rows whatever the size of the data, which is what bounds the
broadcast.  A false hit only costs the row a shuffle, since bytes decide.  A hash that a
partition has a thousand times is sent once, and byte groups are pre-aggregated before their
shuffle, so a group with a third of all rows is one row per task in every exchange but the
last join, where its rows are the side that adaptive execution splits.

Texts are equal when identical after replacing each run of ASCII white space by one space.
Defined results: a null text counts as empty; of equal texts the row with the smallest id
stays (null ids last), of equal ids among them one row; an empty table gives no rows; texts
are compared whole; other columns are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from farelens.llm import golomb
from farelens.llm.tables import freed, lean, sift, store, unused

BITS = 48
CHUNK = 1 << 18  # hashes a sender holds before it sends


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def suspects(hashes: DataFrame, owners: int) -> DataFrame:
    """``h``: the hashes that occur twice or more among ``h`` of the rows given."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, []

        def flush() -> pa.RecordBatch:
            values, count = np.unique(np.concatenate(held).astype(np.uint64), return_counts=True)
            parts = golomb.by_owner(values, owners, BITS)
            ends = np.cumsum([0, *(len(part) for _, part in parts)])
            sender = (TaskContext.get().partitionId() << 32) + number
            return pa.RecordBatch.from_arrays([
                pa.array([sender] * len(parts), pa.int64()),
                pa.array([o for o, _ in parts], pa.int32()),
                pa.array([golomb.encode(part) for _, part in parts], pa.binary()),
                pa.array([golomb.pack(count[a:b] > 1) for a, b in zip(ends, ends[1:])],
                         pa.binary()),
            ], names=["sender", "owner", "sent", "own"])

        for batch in batches:
            held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= CHUNK:
                yield flush()
                number, held = number + 1, []
        if held:
            yield flush()

    def answer(group: pa.Table) -> pa.Table:
        received = [golomb.decode(x) for x in group["sent"].to_pylist()]
        values, count = np.unique(np.concatenate(received), return_counts=True)
        twice = values[count > 1]
        return pa.table({
            "sender": group["sender"], "owner": group["owner"],
            "bitmap": pa.array([golomb.pack(np.isin(x, twice, assume_unique=True))
                                for x in received], pa.binary())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = golomb.decode(row["sent"])
                hit = golomb.unpack(row["bitmap"], len(values)) | golomb.unpack(
                    row["own"], len(values))
                start = golomb.range_start(row["owner"], owners, BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[hit].astype(np.int64) + start, pa.int64())], names=["h"])

    sent = store(hashes.mapInArrow(
        lean(send), "sender long, owner int, sent binary, own binary"), "sent")
    # In Arrow, as workers keep what they import, and pandas is 24 MB of each.
    answers = sent.select("sender", "owner", "sent").groupBy("owner").applyInArrow(
        freed(answer), "sender long, owner int, bitmap binary")
    return sent.join(answers, ["sender", "owner"]).mapInArrow(lean(read), "h long")


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         filter_bits: int = 1 << 23) -> tuple[DataFrame, str]:
    """``docs`` with a struct ``keep_id, group_size, kept, text`` (the normalised one) in a
    further column, and that column's name."""
    name, key, row = (unused(docs, x) for x in ("copies", "key", "row"))
    hashed = F.xxhash64(normalised(text)).bitwiseAND((1 << BITS) - 1)
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found, hit = sift(docs, hashed, suspects(docs.select(hashed.alias("h")), owners), filter_bits)
    alone = found.where(~F.col(hit)).select(*docs.columns, F.struct(
        F.col(doc_id).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), normalised(text).alias("text")).alias(name))
    met = found.where(hit).select(*docs.columns, normalised(text).alias(key),
                                  F.monotonically_increasing_id().alias(row))
    met = store(met, "met")
    groups = store(met.groupBy(key).agg(
        F.min(F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"),
                       F.col(row).alias("row"))).alias(name),
        F.count(F.lit(1)).alias(hit)), "groups")
    decided = met.join(groups, key).select(*docs.columns, F.struct(
        F.col(name)["id"].alias("keep_id"), F.col(hit).alias("group_size"),
        (F.col(row) == F.col(name)["row"]).alias("kept"), F.col(key).alias("text")).alias(name))
    return alone.unionByName(decided), name


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found, name = mark(rows)
    return found.select("doc_id", f"{name}.keep_id", f"{name}.group_size", f"{name}.kept",
                        F.sha2(F.col(name)["text"], 256).alias("text_sha256"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    found, name = mark(docs, doc_id, text)
    return found.where(F.col(name)["kept"]).select(*docs.columns)
