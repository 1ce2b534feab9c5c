"""Readers for models, dimensions and rule files, and the matching writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farelens import schemas
from farelens.functions.columns import parse_date, parse_day_first


def read_model(spark: SparkSession, uri: str, schema: T.StructType | None = None,
               fmt: str = "parquet", options: dict | None = None,
               view: str | None = None) -> DataFrame:
    """Open one source model; filters and column lists set later reach the scan."""
    reader = spark.read.format(fmt).options(**(options or {}))
    df = (reader.schema(schema) if schema is not None else reader).load(uri)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_jdbc(spark: SparkSession, url: str, source: str, options: dict | None = None,
              split_on: str | None = None, bounds: tuple | None = None,
              splits: int = 32) -> DataFrame:
    """Read a relational table or query over JDBC.

    Credentials come in ``options`` and are never stored.  With ``split_on`` and its
    ``bounds`` the read is divided into ``splits`` range queries, one per task; without
    them JDBC reads through a single task.  Errors are raised, not swallowed.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    if split_on is None:
        is_query = source.lstrip().lower().startswith("select")
        return reader.option("query" if is_query else "dbtable", source).load()
    if bounds is None:
        raise ValueError("split_on needs bounds")
    table = f"({source}) q" if source.lstrip().lower().startswith("select") else source
    return (
        reader.option("dbtable", table).option("partitionColumn", split_on)
        .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
        .option("numPartitions", str(splits)).load()
    )


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ROUTES).option("header", True).csv(path)


def read_customers(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: T.StructType = schemas.CLUSTERED) -> DataFrame:
    """Clustered customers, one row per mail address."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)


def read_calendar(spark: SparkSession, path: str, fmt: str = "parquet",
                  day_first: bool = False) -> DataFrame:
    """Elasticity calendar: route, date, elasticity."""
    if fmt == "parquet":
        return spark.read.schema(schemas.CALENDAR).parquet(path)
    text = T.StructType([
        T.StructField("ORIGEN_DESTINO", T.StringType()),
        T.StructField("FECHA_CORRIDA", T.StringType()),
        T.StructField("ELASTICIDADES", T.DoubleType()),
    ])
    parse = parse_day_first if day_first else parse_date
    raw = spark.read.schema(text).option("header", True).csv(path)
    return raw.withColumn("FECHA_CORRIDA", parse("FECHA_CORRIDA"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule file: good months, hours and weekdays, and good seats by capacity."""
    return spark.read.schema(schemas.RULES).option("multiLine", True).json(path)


def seat_rules(rules: DataFrame) -> DataFrame:
    """Good seats as rows (capacity, seat)."""
    return rules.select(F.explode("AsientosBuenos").alias("CAP", "ASIENTOS")).select(
        F.col("CAP").cast("int").alias("CAPACIDAD_ASIENTOS_TRAMO"),
        F.explode("ASIENTOS").alias("NUM_ASIENTO"),
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "errorifexists",
                compression: str | None = None) -> None:
    """Write a result table; with ``partition_by`` later reads can prune."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type[MLReadable], path: str):
    return kind.load(path)
