"""Publication of report tables, replaced route by route and never seen half done.

Each publication writes its tables to folders of their own, partitioned by route, and then one
small manifest that says for every table and route which publication holds it.  Readers take the
newest manifest and read only what it names: until the manifest stands under its number, which
one rename does, they see the report before, whole.  A publication that dies leaves folders
nobody reads; under the same name it is simply run again, its own partitions overwritten.
Nothing published before is changed, so a reader of an older manifest keeps its tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farelens.sources.readers import write_table

ROUTE = "ORIGEN_DESTINO"
_ENTRIES = "tabla string, ruta string, entrega string, esquema string"


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests of a report, oldest first."""
    files, place = _files(spark, f"{root}/manifests")
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n) for n in names if n.isdigit())


def _manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(_ENTRIES).parquet(f"{root}/manifests/{version:08d}")


def publish(tables: dict[str, DataFrame], root: str, routes: Sequence[str] | None = None,
            name: str | None = None) -> int:
    """Write ``tables`` and then their manifest; the number of the manifest.

    Every table has the route as a column.  In all of ``tables``, the routes of this publication
    replace what was published for them: ``routes``, or else those that occur in any of them.
    A route without rows in a table is then empty there.  Routes and tables that are not named
    stay as they were.
    """
    spark = next(iter(tables.values())).sparkSession
    name = name or uuid.uuid4().hex[:12]
    found: dict[str, DataFrame] = {}
    for table, frame in tables.items():
        path = f"{root}/{table}/{name}"
        write_table(frame.hint("rebalance", ROUTE), path, partition_by=[ROUTE], mode="overwrite")
        found[table] = spark.read.schema(frame.schema).parquet(path).select(
            F.lit(table).alias("tabla"), F.col(ROUTE).alias("ruta"), F.lit(name).alias("entrega"),
            F.lit(frame.schema.json()).alias("esquema")).distinct()
    entries = list(found.values())
    new = entries[0]
    for more in entries[1:]:
        new = new.unionAll(more)
    replaced = new.select("ruta").distinct() if routes is None else spark.createDataFrame(
        [(r,) for r in routes], "ruta string")
    known = versions(spark, root)
    number = known[-1] + 1 if known else 1
    if known:
        old = _manifest(spark, root, known[-1])
        mine = F.col("tabla").isin(list(tables))
        kept = old.where(mine).join(replaced.withColumnRenamed("ruta", "otra"),
                                    F.col("ruta").eqNullSafe(F.col("otra")), "left_anti")
        new = old.where(~mine).unionAll(kept).unionAll(new)
    pending = f"{root}/manifests/.pending-{name}"
    new.coalesce(1).write.mode("overwrite").parquet(pending)
    files, source = _files(spark, pending)
    _, target = _files(spark, f"{root}/manifests/{number:08d}")
    # A rename moves a folder into one that is there already, so that is looked at first.
    if files.exists(target) or not files.rename(source, target):
        raise RuntimeError(f"manifest {number} was written by somebody else; publish again")
    return number


def read_report(spark: SparkSession, root: str, table: str,
                version: int | None = None) -> DataFrame:
    """A published table, as of the newest manifest or an older one."""
    known = versions(spark, root)
    if not known:
        raise ValueError(f"nothing is published below {root}")
    # One row per route and publication, whatever the size of the tables.
    rows = _manifest(spark, root, version or known[-1]).where(F.col("tabla") == table).collect()
    if not rows:
        raise ValueError(f"{table} has no published rows")
    schema = T.StructType.fromJson(json.loads(rows[0].esquema))
    found = None
    for name in sorted({r.entrega for r in rows}):
        routes = [r.ruta for r in rows if r.entrega == name]
        wanted = F.col(ROUTE).isin([r for r in routes if r is not None])
        if None in routes:
            wanted = wanted | F.col(ROUTE).isNull()
        part = spark.read.schema(schema).parquet(f"{root}/{table}/{name}").where(wanted)
        part = part.select(*schema.names)
        found = part if found is None else found.unionAll(part)
    return found
