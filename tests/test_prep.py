"""Trip collapse, base joins, seat repair, derived columns and the data sets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens import schemas
from farelens.operators import prep
from farelens.plans import datasets as S
from farelens.sources import extracts

D = dt.date


def frame(spark, schema, rows, **defaults):
    """Rows given as dicts; columns left out take a default or are NULL."""
    return spark.createDataFrame(
        [tuple({**defaults, **r}.get(f.name) for f in schema) for r in rows], schema)


TRIP = dict(FECHA_CORRIDA=D(2026, 1, 5), CV_CORRIDA="1", CV_ASIGN="a", ORIGEN_CORRIDA="A",
            DESTINO_CORRIDA="B", ORIGEN="A", DESTINO="B", HORA_SALIDA_CORRIDA="10:30:00",
            HORA_SALIDA_ORIGEN_CORRIDA="09:00:00.000", CAPACIDAD_ASIENTOS_TRAMO=24, KMS_TRAMO=100.0,
            KMS_ACUM_CORRIDA=1.0, TARIFA_BASE_TRAMO=50.0, PAX_SUBEN=3, DISPONIBILIDAD_TRAMO=21)
SALE = dict(OPERACION=1, TRANSACCION=1, FECHA_OPERACION=D(2026, 1, 1), HORA_OPERACION="08:15:00",
            ORIGEN="A", DESTINO="B", CV_CORRIDA="1", FECHA_CORRIDA=D(2026, 1, 5),
            HORA_SALIDA_CORRIDA="10:30:00", NUM_ASIENTO=5, BOLETOS_VEND=1, BOLETOS_CANCEL=0,
            VENTA=40.0, VENTA_CANCEL=0.0, IVA_VENDIDO=4.0, IVA_CANCEL=0.0, VENTA_TOTAL=44.0,
            NOMBRE_PASAJERO="Ana Luz", DESC_DESCUENTO="ADULTO", TIPO_PASAJERO="AD",
            CLASE_SERVICIO="UNO")


def test_collapse_takes_last_known_sums_and_drops_null_keys(spark, rows):
    trips = frame(spark, schemas.TRIPS, [
        dict(EMPRESA="X", KMS_ACUM_CORRIDA=1.0), dict(EMPRESA="Y", KMS_ACUM_CORRIDA=2.0),
        dict(EMPRESA=None, KMS_ACUM_CORRIDA=3.0, CAPACIDAD_ASIENTOS_TRAMO=30),
        dict(CV_ASIGN=None)], **TRIP)
    got = rows(prep.collapse_trips(trips))
    assert len(got) == 1
    assert (got[0]["EMPRESA"], got[0]["CAPACIDAD_ASIENTOS_TRAMO"]) == ("Y", 30)
    assert (got[0]["TARIFA_BASE_TRAMO"], got[0]["PAX_SUBEN"]) == (150.0, 9)
    assert got[0]["HORA_SALIDA_ORIGEN_CORRIDA"] == "09:00:00.000"
    assert got[0]["TIPO_BUS"] is None and got[0]["IVA_TRANSP"] == 0.0


def test_assignments_repeat_the_ticket(spark):
    trips = frame(spark, schemas.TRIPS, [dict(), dict(CV_ASIGN="b")], **TRIP)
    sales = frame(spark, schemas.SALES, [dict(), dict(CV_CORRIDA="2")], **SALE)
    got = prep.join_trips(sales, prep.collapse_trips(trips))
    assert sorted(r["CV_ASIGN"] for r in got.collect()) == ["a", "b"]


def test_combine_repairs_seats(spark, rows):
    trips = frame(spark, schemas.TRIPS, [
        dict(), dict(CV_CORRIDA="2", CAPACIDAD_ASIENTOS_TRAMO=30),
        dict(CV_CORRIDA="3", CAPACIDAD_ASIENTOS_TRAMO=40)], **TRIP)
    sales = frame(spark, schemas.SALES, [
        dict(OPERACION=1, NUM_ASIENTO=5), dict(OPERACION=2, NUM_ASIENTO=28),
        dict(OPERACION=3, CV_CORRIDA="2", NUM_ASIENTO=30),
        dict(OPERACION=4, CV_CORRIDA="3", NUM_ASIENTO=41)], **SALE)
    loyalty = frame(spark, schemas.LOYALTY, [dict(
        TRANSACCION=1, FECHA_OPERACION=D(2026, 1, 1), FECHA_CORRIDA=D(2026, 1, 5), ORIGEN="A",
        DESTINO="B", TARJETA="T1", EMAIL="a@b.c")])
    got = {r["OPERACION"]: r for r in rows(prep.combine(sales, trips, loyalty))}
    # Seat 41 exceeds every capacity; 40 was only on that ticket, so 30 is what is left.
    assert {k: r["CAPACIDAD_ASIENTOS_TRAMO"] for k, r in got.items()} == {1: 24, 2: 30, 3: 30}
    assert got[1]["PAGO_METODO"] == "TARJETA"
    assert got[1]["NOMBRE_DIA_OPERACION"] == "3_Jue" and got[1]["NOMBRE_DIA_CORRIDA"] == "0_Lun"


def test_derived_measures(spark, rows):
    sales = frame(spark, schemas.SALES, [dict(), dict(OPERACION=2)], **SALE)
    trips = frame(spark, schemas.TRIPS, [dict()], **TRIP)
    loyalty = frame(spark, schemas.LOYALTY, [])
    got = rows(prep.derive(prep.combine(sales, trips, loyalty)))[0]
    assert got["TOTAL_VENTA"] == 36.0 and got["DIF_TARIF"] == 0.72 and got["TOTAL_BOLETOS"] == 1
    assert (got["DIAS_ANTICIPACION"], got["HORAS_ANTICIPACION"]) == (4, 98.0)
    assert got["TIEMPO_ANTICIPACION"] == round(98 / 24, 5)
    assert (got["ANIO"], got["MES"], got["HORA_DECIMAL"]) == (2026, 1, 10)
    assert got["PAGO_METODO"] == "EFECTIVO" and got["ORIGEN_DESTINO"] == "A-B"
    net = rows(prep.derive(prep.combine(sales, trips, loyalty), net=True))[0]
    assert net["TOTAL_VENTA"] == 40.0


def test_windows_are_disjoint_and_inclusive(spark):
    newest = D(2026, 4, 30)
    days = [0, 1, 100, 101, 102]
    df = frame(spark, schemas.SALES, [
        dict(OPERACION=n, FECHA_OPERACION=newest - dt.timedelta(n)) for n in days], **SALE)
    train = {r["OPERACION"] for r in S.before_holdout(df).collect()}
    score = {r["OPERACION"] for r in S.in_holdout(df).collect()}
    assert (train, score) == ({101, 102}, {0, 1, 100})


def test_newest_sale_is_taken_after_the_filters(spark):
    df = frame(spark, schemas.SALES, [
        dict(OPERACION=1, FECHA_OPERACION=D(2026, 4, 30), VENTA=0.0),
        dict(OPERACION=2, FECHA_OPERACION=D(2026, 1, 20)),
        dict(OPERACION=3, FECHA_OPERACION=D(2025, 10, 11))], **SALE)
    assert [r["OPERACION"] for r in S.before_holdout(S.sold(df)).collect()] == [3]


def mails(spark, found):
    schema = T.StructType(schemas.SALES.fields + [T.StructField("EMAIL", T.StringType())])
    return frame(spark, schema, [
        dict(OPERACION=i, NOMBRE_PASAJERO=n, EMAIL=e) for i, (n, e) in enumerate(found)], **SALE)


def test_known_and_placeholder_mail(spark):
    df = mails(spark, [("Ana Luz", None), ("Ana Luz", "z@x"), ("Ana Luz", "a@x"),
                       ("Beto Paz", None), (None, "n@x"), (None, None)])
    got = [r["EMAIL"] for r in S.impute_email(df).orderBy("OPERACION").collect()]
    assert got == ["z@x", "z@x", "a@x", "beto.paz@ejemplo.com", "n@x", "n@x"]


def test_name_unknown_and_no_mail_known_stays_null(spark):
    assert S.impute_email(mails(spark, [(None, None)])).first()["EMAIL"] is None


def test_hot_name_is_imputed_completely(spark):
    many = mails(spark, [("Publico General", "p@x")] + [("Publico General", None)] * 400
                 + [(f"N {i}", None) for i in range(200)])
    got = S.impute_email(many)
    assert got.count() == 601 and got.where("EMAIL = 'p@x'").count() == 401


def test_discount_labels(spark, rows):
    df = frame(spark, schemas.SALES, [
        dict(OPERACION=1, PORCENT_PROMO=10.0), dict(OPERACION=2, PORCENT_PROMO=None),
        dict(OPERACION=3, PORCENT_PROMO=0.0, DESC_DESCUENTO="PROMOCION ESPECIAL"),
        dict(OPERACION=4, PORCENT_PROMO=5.0, DESC_DESCUENTO="PROMOCION ESPECIAL"),
        dict(OPERACION=5, PORCENT_PROMO=5.0, DESC_DESCUENTO=None)], **SALE)
    got = S.correct_discount(S.fill_promo(df)).orderBy("OPERACION")
    assert [r["DESC_DESCUENTO"] for r in got.collect()] == [
        "PROMOCION ESPECIAL", "ADULTO", "ADULTO", "PROMOCION ESPECIAL", None]


def test_prior_year(spark):
    df = frame(spark, schemas.SALES, [dict(FECHA_CORRIDA=D(y, 5, 1)) for y in (2023, 2024, 2025)],
               **SALE)
    assert [r["FECHA_CORRIDA"].year for r in S.prior_year(df).collect()] == [2024]


def test_route_pairs_exclude_the_cross_product(spark):
    df = spark.createDataFrame([("A", "B"), ("C", "D"), ("A", "D")], schemas.ROUTES)
    pairs = [("A", "B"), ("C", "D")]
    by_list = extracts.for_routes(df, pairs)
    by_frame = extracts.for_routes(df, spark.createDataFrame(pairs, schemas.ROUTES))
    assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_frame.collect())) == pairs


def test_contacts_keep_operations_without_complement(spark, rows):
    ops = spark.createDataFrame(
        [(1, 1, "55", "A", "B", D(2026, 1, 1), "08:00:00", D(2026, 1, 2), "AM", 0),
         (2, 1, "56", "A", "B", D(2026, 1, 1), "08:00:00", D(2022, 1, 2), "AM", 0),
         (3, 1, "57", "A", "B", D(2026, 1, 1), "08:00:00", D(2026, 1, 2), "XX", 0)],
        "NCLAVEOPERACION long, NCLAVETRANSACCION long, ATELEFONOPASAJERO string, "
        "ACLAVEOFICINAORIGEN string, ACLAVEOFICINADESITINO string, FFECHAOPERACION date, "
        "HHORAOPERACION string, FFECHASALIDAINICIO date, ACLAVETIPOOPERACION string, "
        "NCLAVEOPERACIONVP int")
    comp = spark.createDataFrame([], "NCLAVEOPERACION long, NCLAVETRANSACCION long, "
                                 "ACORREOELECTRONICO string, AIDMEMBRESIACRM string")
    got = rows(extracts.extract_contacts(ops, comp, [("A", "B")]))
    assert [(r["OPERACION"], r["CORREO_ELECTRONICO"]) for r in got] == [(1, None)]


def test_sales_filters_reach_the_scan(spark, tmp_path):
    from farelens import bindings as B

    path = str(tmp_path / "sales")
    B.sales_raw(spark, "/root/testdata/sf0.001").write.parquet(path)
    found = extracts.extract_sales(spark.read.parquet(path), B.ROUTES, "1996")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = found.select("OPERACION", "VENTA")._jdf.queryExecution().executedPlan().toString()
    assert "In(ORIGEN" in plan and "GreaterThanOrEqual(ANIO,1996)" in plan
    assert "NOMBRE_PASAJERO" not in plan
