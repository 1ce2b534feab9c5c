"""Helpers shared by the operators: stored intermediate tables and edits of texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farelens.session import scratch_path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    This cuts the lineage with files every executor can read, and later column lists and
    filters reach the scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_buckets(df: DataFrame, name: str, *keys: str,
                  reader: SparkSession | None = None) -> DataFrame:
    """``store`` in as many buckets of ``keys`` as there are shuffle partitions, without a
    shuffle, so that a join on the keys needs none on this side.  ``reader`` is the session that
    reads the table, by default that of ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.format("parquet").bucketBy(
        int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).option(
        "compression", "zstd").option("path", path).saveAsTable(table)
    return (reader or spark).table(table)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # only glibc has it
    _TRIM = None


def hand_back() -> None:
    """Return memory that was freed, but is kept by Arrow's allocator and the C library."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, in a worker that hands freed memory back after every batch.

    Workers serve later tasks of other kinds too.  What Arrow's allocator would keep for them,
    some 170 MB after texts, and the C library, some 65 MB after a chunk of words, stands beside
    the executor's heap all that time.
    """
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            hand_back()

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(tidy(batches))
        hand_back()

    return wrapped


def freed(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` for ``applyInArrow``, in a worker that hands freed memory back after a group."""
    def wrapped(group: pa.Table) -> pa.Table:
        out = run(group)
        hand_back()
        return out

    return wrapped


def edit_texts(docs: DataFrame, edit: Callable[[str | None], tuple[bool, str | None]],
               text: str = "text", chars: str = "n_chars") -> DataFrame:
    """Drop rows and change texts, all other columns as they are.

    ``edit`` gives for a text whether its row stays and the text it stays with.  A column
    ``chars``, where there is one, follows the changed text.
    """
    place = docs.columns.index(text)
    count = docs.columns.index(chars) if chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(place).to_pylist()
            found = [edit(x) for x in old]
            changed = any(new is not was for (_, new), was in zip(found, old))
            columns = list(batch.columns)
            if changed:
                columns[place] = pa.array([new for _, new in found], batch.column(place).type)
                if count is not None:
                    columns[count] = pa.array(
                        [was if new is before else len(new) for (_, new), before, was in zip(
                            found, old, batch.column(count).to_pylist())],
                        batch.column(count).type)
            out = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield out.filter(pa.array([keep for keep, _ in found], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def sift(docs: DataFrame, key: Column, wanted: DataFrame, bits: int = 1 << 23,
         ) -> tuple[DataFrame, str]:
    """``docs`` with a boolean column (its name is returned too) that is true wherever the
    long ``key`` is among the single column of ``wanted``, and for a few rows more.

    The wanted keys become a filter of ``bits`` bits (a power of two), sent as at most
    ``bits / 64`` small rows whatever the size of the data.  It has no false negatives, so
    rows without the mark need no further look and no shuffle.
    """
    hit, word, mask = (unused(docs, x) for x in ("hit", "word", "mask"))
    place = wanted.select(F.col(wanted.columns[0]).bitwiseAND(bits - 1).alias("place"))
    words = store(place.groupBy(F.shiftright("place", 6).alias(word)).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias(mask)), "filter")
    own = key.bitwiseAND(bits - 1)
    found = docs.withColumn(hit, own).join(
        F.broadcast(words), F.shiftright(F.col(hit), 6) == F.col(word), "left")
    bit = F.expr(f"shiftleft(1L, CAST(`{hit}` & 63 AS INT))")
    return found.select(*docs.columns, F.coalesce(
        F.col(mask).bitwiseAND(bit) != 0, F.lit(False)).alias(hit)), hit
