"""Registered queries against their SQL, and the driver's entry points."""

import importlib.util
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import compare, oracle_connection  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from farelens.registry import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"
# One query of each kind; tools/check.py runs all of them.
CHECKED = [
    "q01_sales_extract", "q04_contact_extract", "q06_daily_occupancy_income",
    "q11_accounting_channels", "s08_partitioned_sink", "a01_trip_collapse", "j02_with_loyalty",
    "p03_derived_measures", "p07_capacity_repair", "p19_known_mail", "m25_customer_train_set",
    "a05_advance_curve", "a09_fare_bands", "w02_running_share", "w05_month_class",
    "w07_log_smoother", "j04_attach_all_classes", "e01_route_day_elasticity",
    "e02_forward_calendar", "o08_best_price", "a24_stable_deflator", "m16_customer_features",
    "a18_favourite_route", "m11_skew_candidates", "m01_fare_features", "m23_demand_response",
]


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    problem, rows = compare(driver.queries()[name](spark, SF), con, driver.oracle_sql()[name])
    assert problem is None and rows > 0


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["ORIGEN_DESTINO", "FECHA_CORRIDA"] and df.limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("missing", ["public_tokenizers", "corpus_pipeline", "farelens.llm"])
def test_the_other_queries_do_without_the_training_data_operators(monkeypatch, missing):
    for name in [n for n in sys.modules if n.startswith(("farelens.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    spec = importlib.util.spec_from_file_location("entry_alone", driver.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert set(alone.queries()) == set(REGISTRY) and len(REGISTRY) >= 150
    assert set(alone.oracle_sql()) <= set(REGISTRY)


def test_ticket_filters_and_columns_reach_the_stored_table(spark):
    from farelens.registry.base import tickets

    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = tickets(spark, SF).where("ANIO = 1999 AND VENTA > 0").select("VENTA", "ORIGEN_DESTINO")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ANIO" in plan and "GreaterThan(VENTA,0.0)" in plan
    assert "ReadSchema: struct<ORIGEN_DESTINO:string,VENTA:double>" in plan or (
        "ReadSchema: struct<VENTA:double,ORIGEN_DESTINO:string>" in plan)
