"""Readers, writers, projections and shared folders."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from farelens import schemas
from farelens.functions.fixed import GOOD_HOURS, GOOD_MONTHS, GOOD_SEATS, GOOD_WEEKDAYS
from farelens.session import materialise, scratch_path, shared_dir
from farelens.sources import projections as P, readers

D = dt.date


def test_routes_rules_and_customers(spark, tmp_path):
    (tmp_path / "routes.csv").write_text("ORIGEN,DESTINO\nA,B\nC,D\n")
    assert readers.read_routes(spark, str(tmp_path / "routes.csv")).count() == 2
    (tmp_path / "rules.json").write_text(json.dumps({
        "MesBueno": GOOD_MONTHS, "HoraBuena": GOOD_HOURS, "DiaBueno": GOOD_WEEKDAYS,
        "AsientosBuenos": {str(k): v for k, v in GOOD_SEATS.items()}}, indent=1))
    seats = readers.seat_rules(readers.read_rules(spark, str(tmp_path / "rules.json")))
    assert seats.count() == sum(map(len, GOOD_SEATS.values()))
    assert seats.where("CAPACIDAD_ASIENTOS_TRAMO = 30 AND NUM_ASIENTO = 2").count() == 0
    (tmp_path / "c.csv").write_text("EMAIL,Cluster\na@b,3\n")
    got = readers.read_customers(spark, str(tmp_path / "c.csv"), "csv").first()
    assert tuple(got) == ("a@b", 3)


def test_calendar_formats(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "ORIGEN_DESTINO,FECHA_CORRIDA,ELASTICIDADES\nA-B,3/2/2026,0.5\nA-B,31/2/2026,0.7\n")
    got = readers.read_calendar(spark, str(tmp_path / "c.csv"), "csv", day_first=True).collect()
    assert [r["FECHA_CORRIDA"] for r in got] == [D(2026, 2, 3), None]
    df = spark.createDataFrame([("A-B", D(2026, 2, 3), 0.5)], schemas.CALENDAR)
    readers.write_table(df, str(tmp_path / "p"))
    assert readers.read_calendar(spark, str(tmp_path / "p")).collect() == df.collect()


def test_partitioned_sink_prunes_and_does_not_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("ANIO", (F.col("id") % 2 + 2024).cast("int"))
    readers.write_table(df, path, partition_by=["ANIO"])
    plan = spark.read.parquet(path).where("ANIO = 2024")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(ANIO" in plan.toString()
    with pytest.raises(Exception, match="already exists"):
        readers.write_table(df, path)


def test_jdbc_errors_are_raised(spark):
    with pytest.raises(ValueError, match="needs bounds"):
        readers.read_jdbc(spark, "jdbc:none:x", "t", split_on="id")
    with pytest.raises(Exception, match="(?i)driver|load"):
        readers.read_jdbc(spark, "jdbc:none:x", "SELECT 1")


def test_shared_folder_is_set_once_and_lineage_is_cut(spark):
    assert shared_dir(spark) and scratch_path(spark, "a") != scratch_path(spark, "a")
    df = materialise(spark.range(5).withColumn("x", F.rand(1)))
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert df.collect() == df.collect()


def test_named_checkpoint_folder_is_used():
    """The setting is fixed when a session starts, so a stand-in session carries it."""
    seen = []
    stand_in = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: "hdfs://shared/ckpt"),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: seen[-1] + "/app" if seen else None,
                                     setCheckpointDir=seen.append))
    assert shared_dir(stand_in) == "hdfs://shared/ckpt" and seen == ["hdfs://shared/ckpt"]
    assert scratch_path(stand_in, "x").startswith("hdfs://shared/ckpt/x-")
    assert len(seen) == 1


def occupancy(spark, rows):
    return spark.createDataFrame(
        rows, "EMPRESA string, ANIO string, ANIO_MES string, FECHA date, OCUPACION_TRAMO int, "
              "KM_OCUPACION double, KM_CAPACIDAD double, INGRESOS double, KMS double, "
              "CUENTACORRIDA int, PAX_SUBEN int")


def test_load_factor_is_a_ratio_of_sums(spark, rows):
    day = ("E", "2024", "2024-01", D(2024, 1, 1))
    df = occupancy(spark, [(*day, 5, 10.0, 20.0, 7.0, 10.0, 1, 3), (*day, 5, 30.0, 20.0, 8.0, 5.0,
                                                                  1, 3),
                           ("F", "2024", "2024-01", D(2024, 1, 1), 1, 1.0, 0.0, 1.0, 0.0, 1, 1),
                           ("E", "2022", "2022-01", D(2022, 1, 1), 1, 1.0, 1.0, 1.0, 1.0, 1, 1)])
    got = {r["EMPRESA"]: r for r in rows(P.daily_occupancy_income(df))}
    assert (got["E"]["FOP"], got["E"]["FIK"], got["E"]["CORRIDAS"]) == (1.0, 1.0, 2)
    assert (got["F"]["FOP"], got["F"]["FIK"]) == (None, None)
    assert P.daily_occupancy(df, "F").count() == 1 and P.daily_income(df).count() == 2


def test_budget_sources_are_parameters(spark, rows):
    df = spark.createDataFrame([("E", D(2024, 1, 1), "PACK", 5.0, 1, 30, 7.0, 2, 9.0, 4)],
                               "EMPRESA string, FECHA date, TIPO_OPERACION string, VENTA double, "
                               "BOLETOS int, PRESUPUESTO_MENSUAL int, PRESUPUESTO double, "
                               "PASAJEROS int, KMS double, SERVICIOS int")
    both = rows(P.budget_by_kind(df))[0]
    assert both["PTTO_KM"] == both["PTTO_SERVICIOS"] == 30
    assert rows(P.budget_by_kind(df, services="SERVICIOS"))[0]["PTTO_SERVICIOS"] == 4
