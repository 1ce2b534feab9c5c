"""Column expressions and fixed values."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farelens import schemas
from farelens.functions import columns as X, fixed


def one(spark, **exprs):
    row = spark.range(1).select(*[e.alias(n) for n, e in exprs.items()]).first()
    return row.asDict()


def test_zero_divisors_are_null(spark):
    got = one(spark, a=X.safe_div(F.lit(1.0), F.lit(0.0)), b=X.safe_div(F.lit(0), F.lit(0)),
              c=X.safe_div(F.lit(1), F.lit(4)))
    assert got == {"a": None, "b": None, "c": 0.25}


def test_half_even_rounds_as_numpy(spark):
    values = [0.5, 1.5, 2.5, 2.00005, 122.28999999999999 / 280, -1.25, 1e6 + 0.00005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(X.half_even("v", 4)).collect()]
    assert got == list(np.round(values, 4))


def test_dates_that_cannot_be_read(spark):
    df = spark.createDataFrame([("2026-02-29",), ("2026-02-28",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(X.parse_date("s")).collect()] == [
        None, dt.date(2026, 2, 28), None, None]
    df = spark.createDataFrame([("3/2/2026",), ("30/2/2026",)], "s string")
    assert [r[0] for r in df.select(X.parse_day_first("s")).collect()] == [
        dt.date(2026, 2, 3), None]


def test_malformed_clock_is_an_error(spark):
    df = spark.createDataFrame([("07:05:00",)], "s string")
    assert df.select(X.clock_hour("s")).first()[0] == 7
    bad = spark.createDataFrame([("7h",)], "s string")
    with pytest.raises(Exception):
        bad.select(X.clock_hour("s")).collect()


def test_weekday_label_starts_on_monday(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 5),), (dt.date(2026, 1, 11),), (None,)], "d date")
    assert [r[0] for r in df.select(X.weekday_label("d")).collect()] == ["0_Lun", "6_Dom", None]


def test_route_key_keeps_null(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "ORIGEN string, DESTINO string")
    assert [r[0] for r in df.select(X.route_key()).collect()] == ["A-B", None]


def test_deck_class(spark):
    df = spark.createDataFrame([("Lujo Dos Pisos",), ("Primera",), (None,)],
                               "CLASE_SERVICIO string")
    assert [r[0] for r in df.select(X.deck_class()).collect()] == ["DOS", "UNO", "UNO"]


def test_lookup_of_unknown_key(spark):
    got = one(spark, a=X.lookup(F.lit("ES"), fixed.PASSENGER_DISCOUNT),
              b=X.lookup(F.lit("??"), fixed.PASSENGER_DISCOUNT))
    assert got == {"a": 50, "b": None}
    assert len(fixed.PASSENGER_DISCOUNT) == 18 and len(fixed.CLUSTER_UPLIFT) == 5


def test_skewness_is_bias_corrected(spark):
    values = [1.0, 2.0, 2.5, 9.0, 14.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(X.sample_skewness("v")).first()[0] == pytest.approx(pd.Series(values).skew())


def test_correlation_of_known_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 7.0, 5.0), (None, 9.0, 5.0), (4.0, None, 5.0)],
        "a double, b double, c double")
    got = df.agg(X.correlation("a", "b").alias("ab"), X.correlation("a", "c").alias("ac")).first()
    assert got["ab"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 7])[0, 1])
    assert got["ac"] is None


def test_total_of_unknowns_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    assert dict(df.groupBy("k").agg(X.total("v")).collect()) == {"a": 0.0, "b": 2.0}


def test_conform_casts_and_keeps_extra(spark):
    df = spark.createDataFrame([("7", "2026-01-02", "x")],
                               "TRANSACCION string, FECHA_CORRIDA string, OTRA string")
    got = schemas.conform(df, schemas.LOYALTY)
    assert dict(got.dtypes) == {"TRANSACCION": "bigint", "FECHA_CORRIDA": "date", "OTRA": "string"}
