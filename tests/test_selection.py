"""Order statistics against sorting, and what rests on them."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from farelens.operators import features as X, kpis, selection as S

VALUES = st.one_of(st.sampled_from([0.0, -0.0, 1.0, -1.0, 5e-324, 1.7e308, -1.7e308, 250.0]),
                   st.floats(allow_nan=False, allow_infinity=False), st.none())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), VALUES, st.integers(1, 4)), max_size=40))
def test_every_rank_is_that_of_the_sorted_values(spark, drawn):
    counts = spark.createDataFrame(drawn, "k string, v double, n long")
    ordered = {k: sorted(v for g, v, n in drawn if g == k and v is not None for _ in range(n))
               for k, *_ in drawn}
    found = S.order_statistics(counts, ["k"], "v", lambda n: F.sequence(F.lit(-1), n))
    got = {(r.k, r["rank"]): r.v for r in found.collect()}
    assert got == {(k, i): v for k, values in ordered.items() for i, v in enumerate(values)}


def test_longs_and_heavy_repeats(spark):
    counts = spark.createDataFrame([(7, 3), (-(2 ** 62), 1), (2 ** 62, 2), (7, 1), (8, 1)],
                                   "v long, n long")
    got = {r["rank"]: r.v for r in S.order_statistics(
        counts, [], "v", lambda n: F.sequence(F.lit(0), n), levels=S.LONG_LEVELS).collect()}
    assert [got[i] for i in range(8)] == [-(2 ** 62), 7, 7, 7, 7, 8, 2 ** 62, 2 ** 62]


def test_a_lead_day_with_a_million_distinct_fares(spark):
    """Exact, and no aggregate holds more than the roundings of one level."""
    n = 1_000_000
    fares = spark.range(n).select(
        F.lit(3).alias("DIAS_ANTICIPACION"), F.lit(1).alias("BOLETOS_VEND"),
        F.lit(2.0).alias("VENTA"),
        (F.pmod(F.col("id") * 700_001, F.lit(n)) * 0.0013 + 90).alias("TARIFA_BASE_TRAMO"))
    df = kpis.advance_curve(fares)
    row = df.collect()
    assert len(row) == 1 and row[0]["BOLETOS_VEND"] == n
    values = np.arange(n) * 0.0013 + 90
    assert row[0]["TARIFA_BASE_TRAMO"] == (values[n // 2 - 1] + values[n // 2]) / 2
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan


@pytest.mark.parametrize("frac", [0.8, 0.5, 0.0, 1.0])
def test_shares_are_exact_to_one_row_for_unknown_and_empty_classes_too(spark, frac):
    df = spark.range(3_001).withColumn("c", F.when(F.col("id") % 10 == 0, None).when(
        F.col("id") % 10 == 1, "").when(F.col("id") == 22, "single").otherwise("big"))
    got = {r.c: (r.n, r.t) for r in X.stratified_split(df, "c", ["id"], frac).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("en_train").cast("int")).alias("t")).collect()}
    assert len(got) == 4
    assert all(t == int(n * frac + 0.5) for n, t in got.values())


def test_no_expand_in_the_plans_that_count_distinct_days(spark):
    df = spark.createDataFrame([], (
        "CAPACIDAD_ASIENTOS_TRAMO int, NUM_ASIENTO int, FECHA_OPERACION date, BOLETOS_VEND int, "
        "VENTA double, VENTA_TOTAL double, PAX_SUBEN int, DIAS_ANTICIPACION int, "
        "TARIFA_BASE_TRAMO double"))
    for found in (kpis.seat_demand(df), kpis.fare_bands(df)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "SortAggregate" not in plan


def test_distinct_days_before_1970_and_unknown_ones(spark):
    days = ["1969-12-31", "1969-12-31", "1969-10-01", "1970-01-01", "2025-06-01", None]
    df = spark.createDataFrame([(1, 2, d, 1, 2.0, 3.0, 1, 1, 1.0) for d in days], (
        "CAPACIDAD_ASIENTOS_TRAMO int, NUM_ASIENTO int, d string, BOLETOS_VEND int, "
        "VENTA double, VENTA_TOTAL double, PAX_SUBEN int, DIAS_ANTICIPACION int, "
        "TARIFA_BASE_TRAMO double")).withColumn("FECHA_OPERACION", F.col("d").cast("date"))
    row = kpis.seat_demand(df).first()
    assert (row["DIAS_VENTA"], row["BOLETOS_VEND"], row["VENTA_PROM"]) == (4, 6, 2.0)
