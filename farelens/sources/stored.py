"""Base tables that are written once per application and read from then on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farelens.operators.joins import Bucketed, hot_keys, hot_share
from farelens.session import scratch_path
from farelens.sources.readers import write_table

_STORED: dict[tuple, tuple[str, T.StructType]] = {}


def stored(name: str, build: Callable[[SparkSession, str], DataFrame], spark: SparkSession,
           d: str, partition_by: tuple[str, ...] = (), even: bool = True) -> DataFrame:
    """A base table written once per application to the shared folder and read from there.

    Later filters and column lists reach its parquet scan.  Rebalancing keeps the files
    of even size, also where one partition value holds most of the rows; it is a shuffle of
    all rows, which ``even=False`` leaves out for frames that come out of a large join.
    """
    key = (name, spark.sparkContext.applicationId, d)
    if key not in _STORED:
        frame = build(spark, d)
        path = scratch_path(spark, name)
        if even:
            frame = frame.hint("rebalance", *partition_by)
        write_table(frame, path, partition_by=partition_by, compression="zstd")
        _STORED[key] = (path, frame.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def is_stored(name: str, spark: SparkSession, d: str) -> bool:
    """Whether ``stored`` would find the table written."""
    return (name, spark.sparkContext.applicationId, d) in _STORED


_BUCKETED: dict[tuple, Bucketed] = {}


def stored_buckets(builds: dict[str, Callable[[SparkSession, str], DataFrame]],
                   keys: tuple[str, ...], spark: SparkSession, d: str) -> dict[str, Bucketed]:
    """Tables that are joined on ``keys``, written once per application in the same buckets.

    A key that is hot in any of them goes to the plain part of all of them.  The hot keys are at
    most ``1 / hot_share`` hashes for each table.
    """
    names = {name: (name, spark.sparkContext.applicationId, d) for name in builds}
    if any(key not in _BUCKETED for key in names.values()):
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        frames = {name: build(spark, d) for name, build in builds.items()}
        hot = sorted({k for frame in frames.values() for k in spark.range(1).select(F.map_keys(
            hot_keys(frame, keys, hot_share(buckets)))).first()[0]})
        for name, frame in frames.items():
            _BUCKETED[names[name]] = _written(spark, name, frame, keys, buckets, hot)
    return {name: _BUCKETED[key] for name, key in names.items()}


def _written(spark: SparkSession, name: str, frame: DataFrame, keys: tuple[str, ...],
             buckets: int, hot: list[int]) -> Bucketed:
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    is_hot = F.xxhash64(*keys).isin(hot) if hot else F.lit(False)
    # One task per bucket, hence one file.
    frame.where(~is_hot).repartition(buckets, *keys).write.format("parquet").bucketBy(
        buckets, *keys).option("compression", "zstd").option("path", path).saveAsTable(table)
    if not hot:
        return Bucketed(keys, spark.table(table))
    apart = scratch_path(spark, f"{name}-hot")
    write_table(frame.where(is_hot).hint("rebalance"), apart, compression="zstd")
    return Bucketed(keys, spark.table(table), spark.read.schema(frame.schema).parquet(apart))


_SAVED: dict[tuple, str] = {}


def saved(name: str, save: Callable[[SparkSession, str, str], None], spark: SparkSession,
          d: str) -> str:
    """Path of something that ``save(spark, d, path)`` writes, once per application."""
    key = (name, spark.sparkContext.applicationId, d)
    if key not in _SAVED:
        path = scratch_path(spark, name)
        save(spark, d, path)
        _SAVED[key] = path
    return _SAVED[key]
