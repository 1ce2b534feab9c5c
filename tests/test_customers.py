"""Customer metrics, skew, clusters and classifiers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from farelens.operators.boosting import BoostedClasses
from farelens.operators import customers as C, features as X
from farelens.operators.silhouette import silhouette, with_cells
from farelens.sources.readers import load_model, save_model

D = dt.date
CATEGORIES = {"Tipo_pago": ["EFECTIVO", "TARJETA"], "Tipo_desc": ["A", "B"],
              "Tipo_empresa": ["E0", "E1"]}
SCHEMA = ("OPERACION long, TRANSACCION long, NUM_ASIENTO int, EMAIL string, BOLETOS_VEND int, "
          "VENTA double, PORCENT_PROMO double, HORAS_ANTICIPACION double, FECHA_CORRIDA date, "
          "FECHA_OPERACION date, VENTA_ANTICIPADA string, PAGO_METODO string, "
          "DESC_DESCUENTO string, EMPRESA string, ORIGEN_DESTINO string, KMS_TRAMO double")


def tickets(spark, rows):
    base = dict(EMAIL="a", BOLETOS_VEND=1, VENTA=10.0, PORCENT_PROMO=0.0, HORAS_ANTICIPACION=5.0,
                FECHA_CORRIDA=D(2025, 3, 1), FECHA_OPERACION=D(2025, 2, 1), VENTA_ANTICIPADA="SI",
                PAGO_METODO="EFECTIVO", DESC_DESCUENTO="A", EMPRESA="E0", ORIGEN_DESTINO="X-Y",
                KMS_TRAMO=100.0)
    return spark.createDataFrame(
        [(i, i, i, *{**base, **r}.values()) for i, r in enumerate(rows)], SCHEMA)


def test_metrics_of_one_customer(spark, rows):
    df = tickets(spark, [
        dict(VENTA_ANTICIPADA="SI", FECHA_CORRIDA=D(2025, 3, 1)),
        dict(VENTA_ANTICIPADA="NO", FECHA_CORRIDA=D(2025, 3, 10), VENTA=30.0),
        dict(VENTA_ANTICIPADA=None, FECHA_CORRIDA=D(2025, 3, 4), DESC_DESCUENTO="B", EMPRESA=None),
        dict(EMAIL="b", FECHA_OPERACION=D(2025, 2, 20)), dict(EMAIL=None)])
    got = {r["EMAIL"]: r for r in rows(C.customer_metrics(df))}
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a["SBol_Vend"], a["Sum_Pagado"], a["total_viajes_cliente"]) == (3, 50.0, 3)
    assert (a["periodo_dias_cliente"], a["Venta_Ant"], a["Recencia"]) == (10, 0.5, 19)
    assert a["dias_entre_viajes"] == pytest.approx(10 / 3)
    assert (a["Tipo_desc"], a["Tipo_empresa"]) == ("A", "E0")


def test_tied_mode_is_the_smallest(spark):
    df = tickets(spark, [dict(DESC_DESCUENTO="B"), dict(DESC_DESCUENTO="A")])
    assert C.customer_metrics(df).first()["Tipo_desc"] == "A"


def test_features_have_fixed_columns(spark):
    df = tickets(spark, [dict(), dict(EMAIL="b", PAGO_METODO="TARJETA")])
    got = C.customer_features(df, CATEGORIES)
    assert set(C.feature_columns(CATEGORIES)) <= set(got.columns)
    assert {r["EMAIL"]: r["pago_TARJETA"] for r in got.collect()} == {"a": 0, "b": 1}


def test_route_income_and_favourite(spark, rows):
    df = tickets(spark, [
        dict(VENTA=50.0), dict(VENTA=150.0, EMAIL="b"), dict(ORIGEN_DESTINO="P-Q", VENTA=10.0),
        dict(ORIGEN_DESTINO="Z-Z", VENTA=10.0, KMS_TRAMO=0.0)])
    routes = C.customer_route_fik(df)
    got = {(r["EMAIL"], r["ORIGEN_DESTINO"]): r for r in rows(routes)}
    assert got["a", "X-Y"]["FIK_PROMEDIO"] == 2.0 and got["a", "Z-Z"]["FIK_PROMEDIO"] is None
    best = {r["EMAIL"]: r for r in rows(C.favourite_routes(routes))}
    # All of a's routes were travelled once: the one of highest income per km comes first.
    assert best["a"]["ORIGEN_DESTINO"] == "X-Y" and best["a"]["Destinos_unicos"] == 3


def test_known_and_unknown_make_up_all_tickets(spark):
    df = tickets(spark, [dict(EMAIL="hot")] * 300 + [dict(EMAIL=f"e{i}") for i in range(60)])
    table = spark.createDataFrame([("hot", 1), ("e3", 2)], "EMAIL string, Cluster int")
    known, new = C.known_customers(df, table), C.unknown_customers(df, table)
    assert (known.count(), new.count()) == (301, 59)
    assert known.unionByName(new.withColumn("Cluster", F.lit(0))).count() == df.count()


@pytest.fixture
def skewed(spark):
    rng = np.random.default_rng(4)
    values = rng.lognormal(2, 0.9, 800)
    return spark.createDataFrame([(float(v), float(i % 10), float(v) if i else 0.0)
                                  for i, v in enumerate(values)], "a double, b double, z double")


def test_skew_choice(skewed):
    plan = {p["columna"]: p for p in C.choose_transforms(skewed, ["a", "b", "z"])}
    assert plan["b"]["metodo"] == "ninguna"
    assert plan["a"]["metodo"] in ("log", "boxcox") and abs(plan["a"]["skew_despues"]) < 0.3
    assert plan["z"]["metodo"] in ("log1p", "sqrt")      # has a zero: no log, no Box-Cox
    out = C.apply_transforms(skewed, list(plan.values()))
    assert out.agg(F.skewness("a")).first()[0] == pytest.approx(
        plan["a"]["skew_despues"], abs=0.01)


def test_box_cox_power_maximises_the_likelihood(skewed):
    x = np.array([r[0] for r in skewed.select("a").collect()])

    def likelihood(p):
        y = np.log(x) if abs(p) < 1e-9 else (x ** p - 1) / p
        return (p - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    grid = np.linspace(-1, 1, 4001)
    want = grid[np.argmax([likelihood(p) for p in grid])]
    assert C.box_cox_powers(skewed, ["a"])["a"] == pytest.approx(want, abs=1e-3)


def test_constant_columns_scale_to_zero(spark, rows):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(X.min_max(df, ["a", "b"])) == [{"a": 0.0, "b": 0.0}, {"a": 1.0, "b": 0.0}]
    assert rows(X.z_score(df, ["a", "b"])) == [{"a": -1.0, "b": 0.0}, {"a": 1.0, "b": 0.0}]


def test_splits_are_stable_and_even(spark):
    df = spark.range(20_000).withColumn("c", F.when(F.col("id") % 10 == 0, 1).otherwise(0))
    for split in (X.hash_split(df, ["id"]), X.md5_split(df, ["id"]),
                  X.stratified_split(df, "c", ["id"])):
        assert split.agg(F.avg(F.col("en_train").cast("int"))).first()[0] == pytest.approx(
            0.8, abs=0.015)
    again = X.stratified_split(df.repartition(7), "c", ["id"])
    assert again.join(X.stratified_split(df, "c", ["id"]), ["id", "en_train"]).count() == 20_000
    share = X.stratified_split(df, "c", ["id"]).groupBy("c").agg(
        F.avg(F.col("en_train").cast("int")).alias("s")).collect()
    assert all(r["s"] == pytest.approx(0.8, abs=0.002) for r in share)


@pytest.fixture
def planted(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(240):
        k = i % 3
        rows.append((f"m{i}", 2 + k * 20, *(float(rng.normal(10 * k, 0.5)) for _ in range(3)), k))
    return spark.createDataFrame(
        rows, "EMAIL string, SBol_Vend int, p double, q double, r double, planted int")


def test_planted_clusters_are_found(planted):
    got = C.cluster_customers(planted, ["p", "q", "r"], k=3)
    pairs = got.groupBy("planted", "Cluster").count().collect()
    assert len(pairs) == 3 and {r["count"] for r in pairs} == {80}
    sizes = C.cluster_sizes(got).collect()
    assert sum(r["porcentaje"] for r in sizes) == pytest.approx(100)
    found = C.choose_k(C.prepare_clusters(planted, ["p", "q", "r"]), (2, 3, 4))
    assert max(found, key=lambda x: x[1])[0] == 3
    searched = C.cluster_customers(planted, ["p", "q", "r"], k=0)
    assert searched.select("Cluster").distinct().count() == 3


def exact_silhouette(x, label):
    """Plain loop over all pairs."""
    scores = []
    for i in range(len(x)):
        apart = np.linalg.norm(x - x[i], axis=1)
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        near = apart[own].sum() / (own.sum() - 1)
        far = min(apart[label == c].mean() for c in set(label) - {label[i]})
        scores.append((far - near) / max(far, near) if max(far, near) > 0 else 0.0)
    return float(np.mean(scores))


@pytest.mark.parametrize("cells", [4, 20, 400])
def test_silhouette_is_within_its_bound(spark, cells):
    rng = np.random.default_rng(cells)
    x = np.concatenate([rng.normal(m, 1, (60, 3)) for m in (0, 3, 5)] + [[[40.0, 0, 0]]])
    label = np.array([0] * 60 + [1] * 60 + [2] * 60 + [7])
    label[:5] = 1
    df = spark.createDataFrame([(Vectors.dense(v), int(c)) for v, c in zip(x.tolist(), label)],
                               ["__x", "Cluster"])
    value, bound = silhouette(with_cells(df, cells=cells))
    assert abs(value - exact_silhouette(x, label)) <= bound + 1e-9
    assert bound < {4: 2, 20: 0.9, 400: 1e-6}[cells]


@pytest.mark.parametrize("learner,trees", [("forest", 20), ("boosted", 3)])
def test_classifier_round_trip(spark, planted, tmp_path, learner, trees):
    cols, path = ["p", "q", "r"], str(tmp_path / "m")
    train = planted.withColumn("Cluster", F.col("planted"))
    model = C.fit_cluster_classifier(train, cols, learner, trees, 3)
    got = C.classify_customers(planted, model, cols)
    both = got.join(planted, "EMAIL")
    assert both.where("Cluster = planted").count() > 230
    if learner == "forest":
        save_model(model, path)
        loaded = load_model(PipelineModel, path)
    else:
        model.save(spark, path)
        loaded = BoostedClasses.load(spark, path)
    again = C.classify_customers(planted, loaded, cols)
    assert got.exceptAll(again).count() == 0
    assert X.accuracy(both, "planted", "Cluster").first()[0] > 0.95


def test_union_with_uplift(spark):
    df = tickets(spark, [dict(), dict(EMAIL="b")])
    known = df.where("EMAIL = 'a'").withColumn("Cluster", F.lit(3))
    new = df.where("EMAIL = 'b'").withColumn("Cluster", F.lit(9))
    got = {r["EMAIL"]: r["Aumento"] for r in C.with_uplift(known, new).collect()}
    assert got == {"a": 13, "b": None}
