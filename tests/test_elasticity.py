"""Elasticity, deflators and least squares."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from farelens.operators import elasticity as E
from farelens.operators.regression import ols, t_quantile

D = dt.date


def test_t_quantiles():
    table = {1: 12.7062, 2: 4.30265, 5: 2.57058, 10: 2.22814, 30: 2.04227, 120: 1.97993}
    for freedom, want in table.items():
        assert t_quantile(0.975, freedom) == pytest.approx(want, rel=1e-5)


@pytest.fixture
def plane(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(3, 1, 400), rng.normal(-1, 2, 400)
    y = 2 + 0.5 * a - 1.5 * b + rng.normal(0, 0.3, 400)
    rows = [(int(i % 2), float(p), float(q), float(r)) for i, (p, q, r) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows, "g int, a double, b double, y double")


def test_ols_agrees_with_spark_ml(plane):
    got = {r["term"]: r for r in ols(plane, "y", ["a", "b"]).collect()}
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(plane)
    fit = LinearRegression(featuresCol="x", labelCol="y", solver="normal").fit(rows)
    assert [got["a"]["coef"], got["b"]["coef"]] == pytest.approx(list(fit.coefficients))
    errors = fit.summary.coefficientStandardErrors
    assert [got[t]["std_err"] for t in ("a", "b", "const")] == pytest.approx(list(errors))
    assert got["a"]["r2_adj"] == pytest.approx(fit.summary.r2adj)
    assert got["a"]["ci_low"] < 0.5 < got["a"]["ci_high"]


@pytest.mark.parametrize("group", [(), ("g",)])
def test_robust_errors_are_the_sandwich(plane, group):
    wide = plane.withColumn("y", F.col("y") + F.col("a") * F.col("a") * F.sin("b"))
    pdf = wide.toPandas()
    got = ols(wide, "y", ["a", "b"], group, robust=True).collect()
    for g in (0, 1) if group else (None,):
        part = pdf if g is None else pdf[pdf.g == g]
        x = np.column_stack([np.ones(len(part)), part.a, part.b])
        inverse = np.linalg.inv(x.T @ x)
        off = part.y.to_numpy() - x @ (inverse @ x.T @ part.y.to_numpy())
        spread = inverse @ (x.T * off ** 2) @ x @ inverse * len(x) / (len(x) - 3)
        mine = {r["term"]: r["std_err_robust"] for r in got if g is None or r["g"] == g}
        assert [mine[t] for t in ("const", "a", "b")] == pytest.approx(
            list(np.sqrt(np.diag(spread))))


def test_ols_by_group_and_singular_design(spark, plane):
    grouped = ols(plane, "y", ["a", "b"], ["g"]).where("g = 1 AND term = 'a'").first()
    alone = ols(plane.where("g = 1"), "y", ["a", "b"]).where("term = 'a'").first()
    assert grouped["coef"] == pytest.approx(alone["coef"])
    # Two dummies and a constant: singular, but the slope is still identified.
    both = plane.withColumns({"d0": F.expr("int(g = 0)"), "d1": F.expr("int(g = 1)")})
    full = ols(both, "y", ["a", "d0", "d1"]).where("term = 'a'").first()
    reduced = ols(both, "y", ["a", "d1"]).where("term = 'a'").first()
    assert full["coef"] == pytest.approx(reduced["coef"])
    assert full["r2_adj"] == pytest.approx(reduced["r2_adj"])


def test_ols_leaves_out_groups_too_small(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.0), (2, 2.0, 4.5), (2, 3.0, 6.0)],
                               "g int, a double, y double")
    assert {r["g"] for r in ols(df, "y", ["a"], ["g"]).collect()} == {2}


def route_days(spark, rows):
    return spark.createDataFrame(
        rows, "ORIGEN string, DESTINO string, FECHA_CORRIDA date, CV_CORRIDA string, "
              "INGRESO_TEORICO_TRAMO double, TARIFA_BASE_TRAMO double, INGRESO_TRANSP double, "
              "CAPACIDAD_ASIENTOS_TRAMO int, OCUPACION_TRAMO int, PAX_SUBEN int, "
              "DISPONIBILIDAD_TRAMO int")


def test_route_day_elasticity_and_zero_divisors(spark, rows):
    df = route_days(spark, [
        # A trip repeated over its tickets counts once.
        ("A", "B", D(2025, 3, 3), "1", 0.0, 10.0, 60.0, 24, 1, 6, 4),
        ("A", "B", D(2025, 3, 3), "1", 0.0, 10.0, 60.0, 24, 1, 6, 4),
        ("A", "B", D(2025, 3, 4), "1", 0.0, 0.0, 60.0, 24, 1, 6, 4),     # no theoretical income
        ("A", "B", D(2025, 3, 5), "1", 0.0, 10.0, 100.0, 24, 1, 6, 4),   # income as expected
        ("A", "B", D(2025, 3, 6), "1", 0.0, 10.0, 100.0, 24, 1, 0, 0),   # no seats
        ("A", None, D(2025, 3, 6), "1", 0.0, 10.0, 100.0, 24, 1, 1, 1)])
    got = {r["FECHA_CORRIDA"].day: r for r in rows(E.route_day_elasticity(df))}
    assert len(got) == 4
    assert (got[3]["PCT_P"], got[3]["PCT_D"]) == (-0.4, -0.4)
    assert got[3]["ELASTICIDADES"] == pytest.approx(1.0) and got[3]["Day"] == "Monday"
    assert got[4]["PCT_P"] is None and got[4]["ELASTICIDADES"] is None
    assert got[5]["PCT_P"] == 0 and got[5]["ELASTICIDADES"] is None
    assert got[6]["PCT_D"] is None


def test_leap_day_drops_out_of_the_calendar(spark):
    df = spark.createDataFrame(
        [("A-B", D(2024, 2, 28), 1.0), ("A-B", D(2024, 2, 29), 2.0), ("A-B", D(2023, 2, 28), 3.0)],
        "ORIGEN_DESTINO string, FECHA_CORRIDA date, ELASTICIDADES double")
    assert [tuple(r) for r in E.forward_calendar(df).orderBy(
        "ORIGEN_DESTINO", "FECHA_CORRIDA").collect()] == [
        ("A-B", D(2025, 2, 28), 2.0)]


def test_best_price_lies_on_the_grid(spark):
    df = spark.createDataFrame([("u", 10.0, 300.0, 0.5), ("v", 10.0, 300.0, -2.0),
                                ("w", 10.0, 300.0, -1.0)],
                               "k string, Q0 double, p0 double, e double")
    curve = E.revenue_curve(df)
    assert curve.count() == 300
    best = {r["k"]: r for r in E.best_price(curve, ["k"]).collect()}
    assert best["u"]["precio_optimo"] == pytest.approx(1000) and best["v"]["precio_optimo"] == 100
    assert best["u"]["ingreso_maximo"] == pytest.approx(1000 * 10 * (1000 / 300) ** 0.5)


def days(spark, n=300, slope=-0.8):
    rng = np.random.default_rng(2)
    out = []
    for i in range(n):
        year, price = 2023 + i % 3, float(rng.uniform(80, 300)) * (1 + 0.1 * (i % 3))
        lead = float(rng.uniform(5, 40))
        tickets = np.expm1(8 + slope * np.log1p(price) + 0.1 * np.log1p(lead))
        out.append((D(year, 1, 1) + dt.timedelta(i), year, f"{i % 7}_" + "Lun Mar Mie Jue Vie Sab "
                    "Dom".split()[i % 7], float(tickets), float(tickets * price), 50.0, lead,
                    100.0 * (1 + 0.1 * (i % 3)), price))
    return spark.createDataFrame(
        out, "FECHA_OPERACION date, ANIO int, NOMBRE_DIA_CORRIDA string, Tot_Boletos double, "
             "Tot_Venta double, Prom_Ocupacion double, Dias_Anticip double, "
             "Tarif_Base_Tramo double, Costo_Prom_Boleto double")


def test_loglog_recovers_a_planted_elasticity(spark):
    design, names = E.loglog_design(days(spark), "Costo_Prom_Boleto")
    got = {r["term"]: r for r in ols(design, "ln_Q", names).collect()}
    assert got["ln_P"]["coef"] == pytest.approx(-0.8, abs=1e-6)
    assert got["ln_Anticip"]["coef"] == pytest.approx(0.1, abs=1e-6)


def test_deflators(spark):
    frame = days(spark)
    got = {r["ANIO"]: r["deflator"] for r in E.fare_deflator(frame, 2025).collect()}
    assert got == pytest.approx({2023: 1 / 1.2, 2024: 1.1 / 1.2, 2025: 1.0})
    assert set(r["ANIO"] for r in E.stable_deflator(frame, 2025).collect()) == {2023, 2024, 2025}
    with pytest.raises(Exception, match="no base fare in base year 2030"):
        E.fare_deflator(frame, 2030).collect()
    with pytest.raises(Exception, match="no deflator for 2023"):
        E.deflate(frame, E.fare_deflator(frame, 2025).where("ANIO > 2023")).collect()


def test_top_predictors_are_signed(spark):
    df = spark.createDataFrame([(float(i), -float(i), float(i % 3), 1.0, float(i)) for i in
                                range(20)], "a double, b double, c double, k double, y double")
    got = [(r["pos"], r["variable"]) for r in E.top_predictors(
        df, "y", 3, ["a", "b", "c", "k"]).orderBy("pos").collect()]
    assert got[0] == (1, "a") and got[2] == (3, "b") and len(got) == 3
