"""Demand classes of weekdays, hours, seats and months, and their attachment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def classify_day_hour(df: DataFrame, day: str = "NOMBRE_DIA_CORRIDA", hour: str = "HORA_DECIMAL",
                      value: str = "FOP_PROM") -> DataFrame:
    """'Alto' where the mean over the cells of a weekday (of an hour) is at least one half."""
    def label(key: str):
        mean = F.avg(value).over(Window.partitionBy(key))
        return F.when(mean >= 0.5, "Alto").otherwise("Bajo")

    return df.withColumns({"Clasif_dia_venta": label(day), "Clasif_hora_venta": label(hour)})


def classify_seats(df: DataFrame, running: str = "PROP_ACUM_PCT") -> DataFrame:
    """High below 30 percent of running demand, medium below 60, else low."""
    pct = F.col(running)
    return df.withColumns({
        "Clasif_asiento": F.when(pct < 30, "Alta").when(pct < 60, "Media").otherwise("Baja"),
        "Clasif_asiento_codigo": F.when(pct < 30, 1).when(pct < 60, 2).otherwise(3),
    })


def month_classes(df: DataFrame, pax: str = "PAX_SUBEN", year: str = "ANIO",
                  month: str = "MES") -> DataFrame:
    """One class per month of the year, recent years weighing more.

    The weights 1, 1/2, 1/3 .. of the years, newest first, are divided by their sum.
    The windows without a partition run over the distinct years and the twelve months,
    which is all they can ever hold.
    """
    totals = df.dropna(subset=[year, month]).groupBy(year, month).agg(F.sum(pax).alias("pax"))
    years = totals.select(year).distinct().withColumn(
        "w", F.lit(1.0) / F.dense_rank().over(Window.orderBy(F.col(year).desc())))
    weights = years.withColumn("w", F.col("w") / F.sum("w").over(
        Window.orderBy(year).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    scores = totals.join(weights, year).groupBy(month).agg(
        F.sum(F.col("pax") * F.col("w")).alias("score"))
    rank = F.row_number().over(Window.orderBy(F.col("score").desc(), month)) - 1
    return scores.select(
        month, "score",
        F.when(rank <= 3, "Alto").when(rank >= 8, "Bajo").otherwise("Normal").alias("Clasif_mes"))


def classify_months(df: DataFrame, pax: str = "PAX_SUBEN", year: str = "ANIO",
                    month: str = "MES") -> DataFrame:
    """Monthly rows with the class of their month."""
    return df.join(month_classes(df, pax, year, month).drop("score"), month, "left")


def attach(df: DataFrame, dim: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join of classes, keys cast to the types of ``df`` (to text where they cannot be).

    The engine broadcasts the classes where their measured size allows and else splits skewed
    partitions.
    """
    types = dict(df.dtypes)
    keys = [F.col(k).try_cast(types[k]).alias(k) for k in on]
    return df.join(dim.select(*keys, *cols), list(on), "left")
