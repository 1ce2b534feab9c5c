"""Fare features, model and quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens import bindings as B
from farelens.functions.fixed import (
    DECKS, GOOD_HOURS, GOOD_MONTHS, GOOD_SEATS, GOOD_WEEKDAYS, TRAINED_MEAN_DISCOUNT,
)
from farelens.operators import fares as M, features as X
from farelens.plans import datasets as S
from farelens.registry import oracle
from farelens.registry.base import entry, rounded, tickets
from farelens.registry.indicators import longs
from farelens.registry.preparation import ID, _ID
from farelens.session import materialise

ROUTES = [f"{o}-{x}" for o, x in B.ROUTES]


def _in(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


_SEAT_CASE = " ".join(
    f"WHEN CAPACIDAD_ASIENTOS_TRAMO = {cap} THEN CAST(NUM_ASIENTO IN {_in(seats)} AS INTEGER)"
    for cap, seats in GOOD_SEATS.items())
_FLAGS = f"""
  CAST(isodow(FECHA_CORRIDA) - 1 IN {_in(GOOD_WEEKDAYS)} AS INTEGER) AS Buen_Dia,
  CAST(HORA_DECIMAL IN {_in(GOOD_HOURS)} AS INTEGER) AS Buena_Hora,
  CAST(month(FECHA_CORRIDA) IN {_in(GOOD_MONTHS)} AS INTEGER) AS Buen_Mes,
  CASE {_SEAT_CASE} ELSE 0 END AS Buen_Asiento"""
_CLIENTS = ", ".join(
    f"CAST(TIPO_CLIENTE = '{c}' AS INTEGER) AS TIPO_CLIENTE_{c}" for c in B.CLIENT_TYPES)
_DECKS = ", ".join(f"CAST(TIPO_CLASE = '{x}' AS INTEGER) AS PISO_{x}" for x in DECKS)
_BODY = f"""
  ORIGEN_DESTINO AS Origen_Destino, isodow(FECHA_CORRIDA) - 1 AS DiaSemana_Corrida,
  HORA_DECIMAL AS Hora_Corrida, NUM_ASIENTO, HORAS_ANTICIPACION, DIF_TBT_VENTA,
  month(FECHA_CORRIDA) AS Mes_Corrida, year(FECHA_CORRIDA) AS Anio_Corrida, {_FLAGS},
  {_CLIENTS}, {_DECKS}, VENTA"""
_KEY = "OPERACION, TRANSACCION, CV_ASIGN"
oracle.define("fare_frame", f"SELECT {_KEY}, {_BODY} FROM fare_train")
_PARTS = ["DiaSemana_Corrida", "Hora_Corrida", "Mes_Corrida", "Anio_Corrida"]


def train(spark, d):
    return M.fare_features(S.fare_train_set(tickets(spark, d), keep=ID), B.CLIENT_TYPES, ID)


@entry("m01_fare_features", """
SELECT * REPLACE (round(DIF_TBT_VENTA, 8) AS DIF_TBT_VENTA, round(VENTA, 4) AS VENTA)
FROM fare_frame""")
def m01(spark, d):
    df = longs(train(spark, d), *_PARTS)
    return rounded(rounded(df, "DIF_TBT_VENTA", digits=8), "VENTA", digits=4)


@entry("m02_good_flags", f"SELECT {_ID}, {_FLAGS} FROM tickets")
def m02(spark, d):
    return M.good_flags(tickets(spark, d)).select(*ID, *M.FLAGS)


@entry("m03_one_hot", f"SELECT {_ID}, {_CLIENTS} FROM tickets")
def m03(spark, d):
    df = X.one_hot(tickets(spark, d), "TIPO_CLIENTE", B.CLIENT_TYPES, "TIPO_CLIENTE")
    return df.select(*ID, *[f"TIPO_CLIENTE_{c}" for c in B.CLIENT_TYPES])


_Z = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 7) AS {c}"
    for c in M.NUMERIC)


@entry("m04_z_score", f"SELECT {_KEY}, {_Z} FROM fare_frame")
def m04(spark, d):
    df = X.z_score(train(spark, d), M.NUMERIC).select(
        "OPERACION", "TRANSACCION", "CV_ASIGN", *M.NUMERIC)
    return rounded(df, *M.NUMERIC, digits=7)


@entry("m05_hash_split", f"""
SELECT {_ID}, CAST('0x' || left(md5(concat_ws('|', OPERACION, TRANSACCION, NUM_ASIENTO)), 7)
  AS BIGINT) < {int(0.8 * 2 ** 28)} AS en_train FROM fare_frame""")
def m05(spark, d):
    return X.md5_split(train(spark, d), ["OPERACION", "TRANSACCION", "NUM_ASIENTO"]).select(
        *ID, "en_train")


def _fitted(spark, d):
    frame = materialise(X.hash_split(train(spark, d), ["OPERACION", "TRANSACCION", "NUM_ASIENTO"]))
    return frame, M.fit_fare_model(frame.where("en_train"), ROUTES, B.CLIENT_TYPES)


@entry("m07_fare_model")
def m07(spark, d):
    """Error of the fare model on the held-out tickets, beside that of the mean fare."""
    frame, model = _fitted(spark, d)
    held = M.quote(frame.where("NOT en_train"), model, ROUTES)
    mean = frame.where("en_train").agg(F.avg("VENTA")).scalar()
    scored = X.errors(held, "VENTA", "TARIFA_DINAMICA").withColumn("modelo", F.lit("arboles"))
    plain = X.errors(held.withColumn("media", mean), "VENTA", "media").withColumn(
        "modelo", F.lit("media"))
    return rounded(scored.unionByName(plain), "MAE", "RMSE")


@entry("m07_fare_network")
def m07_network(spark, d):
    """Error of the network on the same held-out tickets, beside that of the mean fare."""
    marked = materialise(X.hash_split(train(spark, d), ["OPERACION", "TRANSACCION", "NUM_ASIENTO"]))
    model = M.fit_fare_network(marked.where("en_train"), ROUTES, ID, B.CLIENT_TYPES)
    held = M.quote_network(marked.where("NOT en_train"), model, ROUTES, ["VENTA"])
    mean = marked.where("en_train").agg(F.avg("VENTA")).scalar()
    scored = X.errors(held, "VENTA", "TARIFA_DINAMICA").withColumn("modelo", F.lit("red"))
    plain = X.errors(held.withColumn("media", mean), "VENTA", "media").withColumn(
        "modelo", F.lit("media"))
    return rounded(scored.unionByName(plain), "MAE", "RMSE")


@entry("m08_errors", """
SELECT round(avg(abs(VENTA - TARIFA_BASE_TRAMO)), 6) AS MAE,
  round(sqrt(avg((VENTA - TARIFA_BASE_TRAMO) * (VENTA - TARIFA_BASE_TRAMO))), 6) AS RMSE,
  count(*) AS n FROM fare_train""")
def m08(spark, d):
    """The base fare taken as a prediction of the sale."""
    df = S.fare_train_set(tickets(spark, d))
    return rounded(X.errors(df, "VENTA", "TARIFA_BASE_TRAMO"), "MAE", "RMSE")


@entry("m09_serving_features", f"""
SELECT {_KEY}, {_BODY.replace("DIF_TBT_VENTA,", f"{TRAINED_MEAN_DISCOUNT}::DOUBLE AS DIF_TBT_VENTA,")
  .replace(" VENTA", " round(VENTA, 4) AS VENTA")} FROM fare_score""")
def m09(spark, d):
    df = M.serving_features(S.fare_score_set(tickets(spark, d), keep=ID), B.CLIENT_TYPES, keep=ID)
    return rounded(longs(df, *_PARTS), "VENTA", digits=4)


def quotes(spark, d):
    """Quoted fares of the hold-out window."""
    _, model = _fitted(spark, d)
    score = S.fare_score_set(tickets(spark, d), keep=ID)
    mean = train(spark, d).agg(F.avg("DIF_TBT_VENTA")).scalar()
    return M.quote(M.serving_features(score, B.CLIENT_TYPES, mean, ID), model, ROUTES)


@entry("m10_quotes")
def m10(spark, d):
    return rounded(quotes(spark, d).select(*ID, "VENTA", "TARIFA_DINAMICA"), "VENTA",
                   "TARIFA_DINAMICA", digits=4)
