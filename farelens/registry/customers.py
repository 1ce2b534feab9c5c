"""Customer metrics, clusters and their classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens import bindings as B
from farelens.operators import customers as C, features as X
from farelens.operators.boosting import BoostedClasses, fit_boosted
from farelens.plans import datasets as S
from farelens.registry import oracle
from farelens.registry.base import entry, rounded, tickets
from farelens.sources.stored import saved, stored
from farelens.registry.preparation import ID, _ID, _UPLIFTS
from farelens.session import materialise, scratch_path

CATEGORIES = {
    "Tipo_pago": ["EFECTIVO", "TARJETA"],
    "Tipo_desc": ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "ADULTO", "PROMOCION ESPECIAL"],
    "Tipo_empresa": B.COMPANIES,
}
COLUMNS = C.feature_columns(CATEGORIES)
_MEASURES = ["Prom_Pagado", "PCT_Promo", "Prom_Horas_Ant", "dias_entre_viajes", "Venta_Ant"]

oracle.define("cust_metrics", """
SELECT EMAIL, CAST(sum(BOLETOS_VEND) AS BIGINT) AS SBol_Vend, avg(VENTA) AS Prom_Pagado,
  sum(VENTA) AS Sum_Pagado, avg(PORCENT_PROMO) AS PCT_Promo,
  avg(HORAS_ANTICIPACION) AS Prom_Horas_Ant, count(*) AS total_viajes_cliente,
  max(FECHA_CORRIDA) - min(FECHA_CORRIDA) + 1 AS periodo_dias_cliente,
  (max(FECHA_CORRIDA) - min(FECHA_CORRIDA) + 1) / count(*) AS dias_entre_viajes,
  avg(CASE VENTA_ANTICIPADA WHEN 'SI' THEN 1 WHEN 'NO' THEN 0 END) AS Venta_Ant,
  (SELECT max(FECHA_OPERACION) FROM cust_train) - max(FECHA_OPERACION) AS Recencia
FROM cust_train WHERE EMAIL IS NOT NULL GROUP BY 1""")
for _column, _name in (("PAGO_METODO", "Tipo_pago"), ("DESC_DESCUENTO", "Tipo_desc"),
                       ("EMPRESA", "Tipo_empresa")):
    oracle.define(f"mode_{_name}", f"""
SELECT EMAIL, v AS {_name} FROM (SELECT EMAIL, {_column} AS v, count(*) AS n FROM cust_train
  WHERE {_column} IS NOT NULL GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY EMAIL ORDER BY n DESC, v) = 1""")
oracle.define("cust_modes", """
SELECT EMAIL, Tipo_pago, Tipo_desc, Tipo_empresa FROM cust_metrics
LEFT JOIN mode_Tipo_pago USING (EMAIL) LEFT JOIN mode_Tipo_desc USING (EMAIL)
LEFT JOIN mode_Tipo_empresa USING (EMAIL)""")
_DUMMIES = ", ".join(
    f"CAST(coalesce({name} = '{c}', false) AS INTEGER) AS \"{name.replace('Tipo_', '')}_{c}\""
    for name, values in CATEGORIES.items() for c in values[1:])
oracle.define("cust_features", f"""
SELECT m.*, {_DUMMIES} FROM cust_metrics m JOIN cust_modes USING (EMAIL)""")
oracle.define("fik_day", """
SELECT FECHA_CORRIDA, ORIGEN_DESTINO, sum(VENTA) / max(KMS_TRAMO) AS FIK_DIARIO
FROM cust_train GROUP BY 1, 2""")
oracle.define("fik_customer", """
SELECT EMAIL, ORIGEN_DESTINO, count(*) AS TOTAL_VIAJES,
  round_even(avg(FIK_DIARIO), 4) AS FIK_PROMEDIO, round_even(sum(VENTA), 4) AS VENTA_TOTAL,
  max(FECHA_CORRIDA) AS ULTIMA_FECHA, min(FECHA_CORRIDA) AS PRIMERA_FECHA
FROM cust_train JOIN fik_day USING (FECHA_CORRIDA, ORIGEN_DESTINO) GROUP BY 1, 2""")
oracle.define("fik_best", """
SELECT EMAIL, ORIGEN_DESTINO, FIK_PROMEDIO, TOTAL_VIAJES, Destinos_unicos FROM (
  SELECT *, count(*) OVER (PARTITION BY EMAIL) AS Destinos_unicos, row_number() OVER (
    PARTITION BY EMAIL ORDER BY TOTAL_VIAJES DESC, FIK_PROMEDIO DESC, ORIGEN_DESTINO) AS r
  FROM fik_customer) WHERE r = 1""")
oracle.define("clustered", """
SELECT EMAIL, CAST(SBol_Vend % 5 AS INTEGER) AS "Cluster" FROM cust_metrics WHERE SBol_Vend > 1""")


# What the entries read of the training set.
TRAIN_COLUMNS = [
    *ID, "EMAIL", "ORIGEN_DESTINO", "FECHA_OPERACION", "FECHA_CORRIDA", "BOLETOS_VEND", "VENTA",
    "PORCENT_PROMO", "HORAS_ANTICIPACION", "VENTA_ANTICIPADA", "KMS_TRAMO",
    *[column for column, _ in C.MODES],
]


def train(spark, d):
    """The customer training set, stored, as most entries here start from it."""
    return stored("customer_train", lambda s, x: S.customer_train_set(tickets(s, x)).select(
        *TRAIN_COLUMNS), spark, d, even=False)


def features(spark, d):
    return C.customer_features(train(spark, d), CATEGORIES)


def clustered(spark, d):
    """A fixed stand-in for cluster labels, so that joins and uplifts can be checked."""
    return C.multi_ticket(C.customer_metrics(train(spark, d))).select(
        "EMAIL", (F.col("SBol_Vend") % 5).cast("int").alias("Cluster"))


def _rounded(df):
    return rounded(rounded(df, "Sum_Pagado", digits=2), *_MEASURES, digits=7).withColumns({
        c: F.col(c).cast("long") for c in ("periodo_dias_cliente", "Recencia")})


_R = ", ".join(f"round({c}, 7) AS {c}" for c in _MEASURES)


@entry("a13_customer_metrics", f"""
SELECT * EXCLUDE (Venta_Ant) REPLACE ({_R.rsplit(',', 2)[0]}, round(Sum_Pagado, 2) AS Sum_Pagado)
FROM cust_metrics""")
def a13(spark, d):
    df = C.customer_metrics(train(spark, d)).drop("Tipo_pago", "Tipo_desc", "Tipo_empresa")
    return _rounded(df).drop("Venta_Ant")


@entry("a14_advance_share", "SELECT EMAIL, round(Venta_Ant, 7) AS Venta_Ant FROM cust_metrics")
def a14(spark, d):
    return rounded(C.customer_metrics(train(spark, d)).select("EMAIL", "Venta_Ant"), "Venta_Ant",
                   digits=7)


@entry("a15_customer_modes", "SELECT * FROM cust_modes")
def a15(spark, d):
    return C.customer_metrics(train(spark, d)).select(
        "EMAIL", "Tipo_pago", "Tipo_desc", "Tipo_empresa")


@entry("j06_recency_and_modes", """
SELECT EMAIL, Recencia, Tipo_pago, Tipo_desc, Tipo_empresa
FROM cust_metrics JOIN cust_modes USING (EMAIL)""")
def j06(spark, d):
    """Recency and modes come out of the same aggregate: no self-join is left."""
    return C.customer_metrics(train(spark, d)).select(
        "EMAIL", F.col("Recencia").cast("long").alias("Recencia"), "Tipo_pago", "Tipo_desc",
        "Tipo_empresa")


@entry("m16_customer_features", f"""
SELECT * REPLACE ({_R}, round(Sum_Pagado, 2) AS Sum_Pagado) FROM cust_features""")
def m16(spark, d):
    return _rounded(features(spark, d))


@entry("a16_daily_route_income", """
SELECT FECHA_CORRIDA, ORIGEN_DESTINO, round(FIK_DIARIO, 8) AS FIK_DIARIO FROM fik_day""")
def a16(spark, d):
    return rounded(C.daily_route_income(train(spark, d)), "FIK_DIARIO", digits=8)


@entry("j07_daily_income_join", f"""
SELECT {_ID}, round(FIK_DIARIO, 8) AS FIK_DIARIO
FROM cust_train LEFT JOIN fik_day USING (FECHA_CORRIDA, ORIGEN_DESTINO)""")
def j07(spark, d):
    return rounded(C.with_daily_income(train(spark, d)).select(*ID, "FIK_DIARIO"), "FIK_DIARIO",
                   digits=8)


@entry("a17_customer_route_income", """
SELECT EMAIL, ORIGEN_DESTINO, TOTAL_VIAJES, FIK_PROMEDIO, round(VENTA_TOTAL, 2) AS VENTA_TOTAL,
  ULTIMA_FECHA, PRIMERA_FECHA FROM fik_customer""")
def a17(spark, d):
    return rounded(C.customer_route_fik(train(spark, d)), "VENTA_TOTAL", digits=2)


@entry("a18_favourite_route", "SELECT * FROM fik_best")
def a18(spark, d):
    return C.favourite_routes(C.customer_route_fik(train(spark, d)))


@entry("j08_metrics_with_routes", """
SELECT EMAIL, SBol_Vend, total_viajes_cliente, ORIGEN_DESTINO, TOTAL_VIAJES
FROM cust_metrics LEFT JOIN fik_customer USING (EMAIL)""")
def j08(spark, d):
    df = train(spark, d)
    routes = C.customer_route_fik(df).select("EMAIL", "ORIGEN_DESTINO", "TOTAL_VIAJES")
    return C.customer_metrics(df).select("EMAIL", "SBol_Vend", "total_viajes_cliente").join(
        routes, "EMAIL", "left")


@entry("m17_features_with_route", """
SELECT EMAIL, SBol_Vend, round(Prom_Pagado, 7) AS Prom_Pagado, ORIGEN_DESTINO, FIK_PROMEDIO,
  TOTAL_VIAJES, Destinos_unicos
FROM cust_metrics LEFT JOIN fik_best USING (EMAIL) WHERE SBol_Vend > 1""")
def m17(spark, d):
    df = C.customer_features_fik(train(spark, d), CATEGORIES).select(
        "EMAIL", "SBol_Vend", "Prom_Pagado", "ORIGEN_DESTINO", "FIK_PROMEDIO", "TOTAL_VIAJES",
        "Destinos_unicos")
    return rounded(df, "Prom_Pagado", digits=7)


@entry("a19_multi_ticket", "SELECT EMAIL, SBol_Vend FROM cust_metrics WHERE SBol_Vend > 1")
def a19(spark, d):
    return C.multi_ticket(C.customer_metrics(train(spark, d))).select("EMAIL", "SBol_Vend")


_SKEWED = ["SBol_Vend", "Prom_Pagado", "Sum_Pagado", "PCT_Promo", "Prom_Horas_Ant",
           "total_viajes_cliente", "periodo_dias_cliente", "dias_entre_viajes", "Recencia"]
_SKEW_ROWS = " UNION ALL ".join(f"""
SELECT '{c}' AS columna, min({c})::DOUBLE AS minimo, count({c}) AS n,
  round(skewness({c}), 6) AS ninguna,
  CASE WHEN min({c}) >= 0 THEN round(skewness(ln(1 + CASE WHEN {c} >= 0 THEN {c} END)), 6) END
    AS log1p,
  CASE WHEN min({c}) > 0 THEN round(skewness(ln(CASE WHEN {c} > 0 THEN {c} END)), 6) END AS log,
  CASE WHEN min({c}) >= 0 THEN round(skewness(sqrt(CASE WHEN {c} >= 0 THEN {c} END)), 6) END
    AS sqrt
FROM cust_metrics""" for c in _SKEWED)


@entry("m11_skew_candidates", f"""
SELECT * REPLACE (round(minimo, 6) AS minimo) FROM ({_SKEW_ROWS})""")
def m11_candidates(spark, d):
    df = C.skew_candidates(C.customer_metrics(train(spark, d)), _SKEWED)
    return rounded(df, "minimo", "ninguna", "log1p", "log", "sqrt")


@entry("m11_skew_choice")
def m11_choice(spark, d):
    """Transformation chosen for each column, Box-Cox included."""
    metrics = materialise(C.customer_metrics(train(spark, d)))
    plan = C.choose_transforms(metrics, _SKEWED)
    schema = ("columna string, metodo string, potencia double, skew_antes double, "
              "skew_despues double, mejora double, mejora_pct double")
    return spark.createDataFrame(plan, schema)


@entry("m12_box_cox_powers")
def m12(spark, d):
    """Box-Cox transformed metrics at the power of highest likelihood."""
    metrics = materialise(C.customer_metrics(train(spark, d)))
    cols = ["Prom_Pagado", "total_viajes_cliente", "periodo_dias_cliente"]
    powers = C.box_cox_powers(metrics, cols)
    plan = [{"columna": c, "metodo": "boxcox", "potencia": p} for c, p in powers.items()]
    return C.apply_transforms(metrics, plan).select("EMAIL", *cols)


_MINMAX = ", ".join(
    f"round(coalesce(({c} - min({c}) OVER ()) / nullif((max({c}) OVER () - min({c}) OVER ())"
    f"::DOUBLE, 0), 0), 7) AS {c}" for c in _SKEWED)


@entry("m13_min_max", f"SELECT EMAIL, {_MINMAX} FROM cust_metrics")
def m13(spark, d):
    df = X.min_max(C.customer_metrics(train(spark, d)).select("EMAIL", *_SKEWED), _SKEWED)
    return rounded(df, *_SKEWED, digits=7)


@entry("m14_choose_k")
def m14(spark, d):
    """Euclidean silhouette of 2 to 10 clusters, and how far off it can be."""
    found = C.choose_k(C.prepare_clusters(features(spark, d), COLUMNS))
    return spark.createDataFrame(found, "k int, silueta double, cota double")


@entry("m15_searched_clusters")
def m15_searched(spark, d):
    """Customers in the number of clusters that has the best silhouette."""
    return C.cluster_customers(features(spark, d), COLUMNS, k=0).select(
        "EMAIL", "SBol_Vend", "Prom_Pagado", "Cluster")


@entry("m15_clusters_with_route_income")
def m15_routes(spark, d):
    """Customers clustered on the income per km and trips of their favourite route as well."""
    found = materialise(C.customer_features_fik(train(spark, d), CATEGORIES))
    columns = [*COLUMNS, "FIK_PROMEDIO", "TOTAL_VIAJES", "Destinos_unicos"]
    return C.cluster_customers(found, columns).select(
        "EMAIL", "SBol_Vend", "FIK_PROMEDIO", "ORIGEN_DESTINO", "Cluster")


@entry("m15_cluster_customers")
def m15(spark, d):
    """Customers with several tickets in five clusters."""
    return C.cluster_customers(features(spark, d), COLUMNS).select(
        "EMAIL", "SBol_Vend", "Prom_Pagado", "Cluster")


@entry("j09_labels_on_metrics")
def j09(spark, d):
    """Mean untransformed metrics of each cluster."""
    found = C.cluster_customers(features(spark, d), COLUMNS)
    return found.groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("clientes"), *[F.round(F.avg(c), 4).alias(c) for c in C.METRICS])


@entry("a20_cluster_sizes")
def a20(spark, d):
    return C.cluster_sizes(C.cluster_customers(features(spark, d), COLUMNS))


@entry("m06_stratified_split", """
SELECT EMAIL, "Cluster", row_number() OVER (PARTITION BY "Cluster"
    ORDER BY CAST('0x' || substr(md5(EMAIL), 1, 15) AS BIGINT))
  <= floor(count(*) OVER (PARTITION BY "Cluster") * 0.8::DOUBLE + 0.5) AS en_train
FROM (SELECT EMAIL, CASE WHEN SBol_Vend % 5 < 4 THEN CAST(SBol_Vend % 5 AS INTEGER) END AS "Cluster"
      FROM cust_metrics)""")
def m06(spark, d):
    """Customers with their class (one of them unknown) and side of the split."""
    left = (F.col("SBol_Vend") % 5).cast("int")
    df = C.customer_metrics(train(spark, d)).select("EMAIL", F.when(left < 4, left).alias("Cluster"))
    return X.stratified_split(df, "Cluster", ["EMAIL"])


def _marked(spark, d):
    """Clustered customers with their side of the split."""
    labelled = materialise(C.cluster_customers(features(spark, d), COLUMNS))
    return X.stratified_split(labelled, "Cluster", ["EMAIL"])


def _fit_and_save(spark, d, path):
    marked = stored("clustered_customers", _marked, spark, d)
    C.fit_cluster_classifier(marked.where("en_train"), COLUMNS).save(spark, path)


def _classified(spark, d):
    """The marked customers and the classifier; both are computed once per application."""
    path = saved("classifier", _fit_and_save, spark, d)
    return stored("clustered_customers", _marked, spark, d), BoostedClasses.load(spark, path)


@entry("m18_cluster_classifier")
def m18(spark, d):
    """Actual and predicted clusters of the held-out customers."""
    marked, model = _classified(spark, d)
    held = marked.where("NOT en_train")
    return held.select("EMAIL", "Cluster").join(
        C.classify_customers(held, model, COLUMNS).withColumnRenamed("Cluster", "pred"), "EMAIL")


def _accuracy(held, pred, label):
    """Held-out accuracy of a label beside the share of its commonest class."""
    both = held.select("EMAIL", F.col(label).alias("real")).join(pred, "EMAIL")
    counts = both.groupBy("real").agg(F.count(F.lit(1)).alias("n"), F.sum(
        (F.col("real") == F.col("Cluster")).cast("int")).alias("hits"))
    return counts.agg(
        F.lit(label).alias("etiqueta"), F.sum("n").alias("clientes"),
        (F.sum("hits") / F.sum("n")).alias("exactitud"),
        (F.max("n") / F.sum("n")).alias("mayoria"))


@entry("m18_held_out_accuracy")
def m18_accuracy(spark, d):
    """Accuracy on held-out customers for the cluster, which is made from the features, and
    for the origin of the customer's favourite route, which is not among them."""
    marked, model = _classified(spark, d)
    origins = sorted({o for o, _ in B.ROUTES})
    place = F.array_position(F.array(*map(F.lit, origins)),
                             F.substring_index("ORIGEN_DESTINO", "-", 1)) - 1
    routes = C.favourite_routes(C.customer_route_fik(train(spark, d))).select(
        "EMAIL", place.cast("int").alias("origen_favorito"))
    other = materialise(X.stratified_split(
        marked.drop("en_train").join(routes, "EMAIL"), "origen_favorito", ["EMAIL"]))
    plain = fit_boosted(other.where("en_train"), COLUMNS, "origen_favorito", rounds=10, depth=3)
    held, rest = marked.where("NOT en_train"), other.where("NOT en_train")
    return rounded(_accuracy(held, C.classify_customers(held, model, COLUMNS), "Cluster").unionAll(
        _accuracy(rest, C.classify_customers(rest, plain, COLUMNS), "origen_favorito")),
        "exactitud", "mayoria")


@entry("m19_confusion", """
SELECT SBol_Vend % 5 AS label, total_viajes_cliente % 5 AS pred, count(*) AS n,
  count(*) / sum(count(*)) OVER () AS share
FROM cust_metrics GROUP BY 1, 2""")
def m19(spark, d):
    """Confusion table of two fixed label columns."""
    df = C.customer_metrics(train(spark, d)).select(
        (F.col("SBol_Vend") % 5).alias("label"), (F.col("total_viajes_cliente") % 5).alias("pred"))
    everyone = df.agg(F.count(F.lit(1))).scalar()
    return X.confusion(df, "label", "pred").withColumn("share", F.col("n") / everyone)


@entry("j10_known_customers", f"""
SELECT {_ID}, EMAIL, "Cluster" FROM cust_train JOIN clustered USING (EMAIL)""")
def j10(spark, d):
    return C.known_customers(train(spark, d), clustered(spark, d)).select(*ID, "EMAIL", "Cluster")


@entry("j11_unknown_customers", f"""
SELECT {_ID}, EMAIL FROM cust_train WHERE EMAIL NOT IN (SELECT EMAIL FROM clustered)""")
def j11(spark, d):
    return C.unknown_customers(train(spark, d), clustered(spark, d)).select(*ID, "EMAIL")


@entry("o04_known_and_predicted", f"""
SELECT {_ID}, EMAIL, "Cluster" FROM cust_train JOIN clustered USING (EMAIL)
UNION ALL SELECT {_ID}, EMAIL, CAST(OPERACION % 5 AS INTEGER) FROM cust_train
WHERE EMAIL NOT IN (SELECT EMAIL FROM clustered)""")
def o04(spark, d):
    return _labelled(spark, d).select(*ID, "EMAIL", "Cluster")


def _labelled(spark, d):
    df, known = train(spark, d), clustered(spark, d)
    new = C.unknown_customers(df, known).withColumn("Cluster", (F.col("OPERACION") % 5).cast("int"))
    return C.with_uplift(C.known_customers(df, known), new)


@entry("m21_uplift", f"""
SELECT {_ID}, "Cluster", v AS "Aumento" FROM (
  SELECT {_ID}, "Cluster" FROM cust_train JOIN clustered USING (EMAIL)
  UNION ALL SELECT {_ID}, CAST(OPERACION % 5 AS INTEGER) FROM cust_train
  WHERE EMAIL NOT IN (SELECT EMAIL FROM clustered))
LEFT JOIN (VALUES {_UPLIFTS}) t(k, v) ON "Cluster" = k""")
def m21(spark, d):
    return _labelled(spark, d).select(*ID, "Cluster", "Aumento")


@entry("m20_classify_new_customers")
def m20(spark, d):
    """Tickets of the hold-out window with their known or predicted cluster."""
    marked, model = _classified(spark, d)
    score = materialise(S.customer_score_set(tickets(spark, d)))
    known, new = C.predict_clusters(score, model, marked, CATEGORIES)
    return C.with_uplift(known, new).select(*ID, "EMAIL", "Cluster", "Aumento")


@entry("s09_model_round_trip")
def s09(spark, d):
    """Predictions of the classifier before it was saved and after it was loaded again."""
    marked = stored("clustered_customers", _marked, spark, d)
    model = C.fit_cluster_classifier(marked.where("en_train"), COLUMNS, trees=5, depth=3)
    path = scratch_path(spark, "classifier")
    model.save(spark, path)
    before = C.classify_customers(marked, model, COLUMNS)
    after = C.classify_customers(marked, BoostedClasses.load(spark, path), COLUMNS)
    return before.join(after.withColumnRenamed("Cluster", "recargado"), "EMAIL")
