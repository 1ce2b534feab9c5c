"""Customer metrics, skew reduction, clusters and their supervised twin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import half_even, lookup, safe_div, sample_skewness, total
from farelens.functions.fixed import CLUSTER_UPLIFT
from farelens.operators.boosting import BoostedClasses, fit_boosted
from farelens.operators.features import min_max, one_hot
from farelens.operators.joins import spread_join
from farelens.operators.prep import TICKET
from farelens.operators.silhouette import silhouette, with_cells
from farelens.session import materialise

METRICS = [
    "SBol_Vend", "Prom_Pagado", "Sum_Pagado", "PCT_Promo", "Prom_Horas_Ant",
    "total_viajes_cliente", "periodo_dias_cliente", "dias_entre_viajes", "Venta_Ant", "Recencia",
]
# Categorical columns, the name of their mode and the prefix of its dummies.
MODES = [("PAGO_METODO", "Tipo_pago"), ("DESC_DESCUENTO", "Tipo_desc"), ("EMPRESA", "Tipo_empresa")]
PREFIX = "Tipo"


def customer_metrics(df: DataFrame) -> DataFrame:
    """One row per mail address: purchase metrics and most frequent categories.

    All of it is one aggregate with map-side combining, so a busy address costs no more
    than any other.
    """
    newest: Column = df.agg(F.max("FECHA_OPERACION")).scalar()
    early = F.when(F.col("VENTA_ANTICIPADA") == "SI", 1.0).when(
        F.col("VENTA_ANTICIPADA").isNotNull(), 0.0)
    period = F.datediff(F.max("FECHA_CORRIDA"), F.min("FECHA_CORRIDA")) + 1
    trips = F.count(F.lit(1))
    return df.where(F.col("EMAIL").isNotNull()).groupBy("EMAIL").agg(
        total("BOLETOS_VEND").alias("SBol_Vend"),
        F.avg("VENTA").alias("Prom_Pagado"),
        total("VENTA").alias("Sum_Pagado"),
        F.avg("PORCENT_PROMO").alias("PCT_Promo"),
        F.avg("HORAS_ANTICIPACION").alias("Prom_Horas_Ant"),
        trips.alias("total_viajes_cliente"),
        period.alias("periodo_dias_cliente"),
        safe_div(period, F.greatest(trips, F.lit(1))).alias("dias_entre_viajes"),
        F.avg(early).alias("Venta_Ant"),
        F.datediff(newest, F.max("FECHA_OPERACION")).alias("Recencia"),
        *[F.mode(c, True).alias(name) for c, name in MODES],
    )


def customer_features(df: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """Metrics plus 0/1 columns of the modes, the first category of each left out.

    ``categories`` gives the fixed category list of each mode column, so training and
    serving have the same columns.
    """
    out = customer_metrics(df)
    for _, name in MODES:
        out = one_hot(out, name, categories[name], name.replace("Tipo_", ""), drop_first=True)
    return out.drop(*[name for _, name in MODES])


def feature_columns(categories: dict[str, Sequence[str]]) -> list[str]:
    dummies = [f"{name.replace('Tipo_', '')}_{c}" for _, name in MODES
               for c in list(categories[name])[1:]]
    return METRICS + dummies


def daily_route_income(df: DataFrame) -> DataFrame:
    """Income per km of each route and day."""
    keys = ["FECHA_CORRIDA", "ORIGEN_DESTINO"]
    return df.dropna(subset=keys).groupBy(*keys).agg(
        safe_div(F.sum("VENTA"), F.max("KMS_TRAMO")).alias("FIK_DIARIO"))


def with_daily_income(df: DataFrame, row_id: Sequence[str] = TICKET) -> DataFrame:
    """Tickets with the income per km of their route and day."""
    return spread_join(df, daily_route_income(df), ["FECHA_CORRIDA", "ORIGEN_DESTINO"], "left",
                       row_id)


def customer_route_fik(df: DataFrame) -> DataFrame:
    """Trips, mean daily income per km, sales and first and last trip by customer and route.

    Sales of one customer, route and day are combined first; the daily income joins that
    smaller frame, and the mean is weighted back by the number of tickets.
    """
    keys = ["EMAIL", "ORIGEN_DESTINO"]
    daily = df.dropna(subset=[*keys, "FECHA_CORRIDA"]).groupBy(*keys, "FECHA_CORRIDA").agg(
        F.count(F.lit(1)).alias("n"), F.sum("VENTA").alias("venta"))
    joined = spread_join(daily, daily_route_income(df), ["FECHA_CORRIDA", "ORIGEN_DESTINO"],
                         "left", ["EMAIL"], sample=df)
    weight = F.when(F.col("FIK_DIARIO").isNotNull(), F.col("n"))
    return joined.groupBy(*keys).agg(
        F.sum("n").alias("TOTAL_VIAJES"),
        half_even(safe_div(F.sum(F.col("FIK_DIARIO") * F.col("n")), F.sum(weight)), 4).alias(
            "FIK_PROMEDIO"),
        half_even(F.coalesce(F.sum("venta"), F.lit(0.0)), 4).alias("VENTA_TOTAL"),
        F.max("FECHA_CORRIDA").alias("ULTIMA_FECHA"),
        F.min("FECHA_CORRIDA").alias("PRIMERA_FECHA"),
    )


def favourite_routes(routes: DataFrame) -> DataFrame:
    """Distinct routes of each customer and the route travelled most.

    ``routes`` has one row per customer and route, so distinct routes are counted rows.  Ties
    go to the higher mean income per km, then to the route name.
    """
    rank = F.struct(-F.col("TOTAL_VIAJES"), -F.coalesce("FIK_PROMEDIO", F.lit(float("-inf"))),
                    "ORIGEN_DESTINO")
    return routes.groupBy("EMAIL").agg(
        F.count("ORIGEN_DESTINO").alias("Destinos_unicos"),
        *[F.min_by(c, rank).alias(c) for c in ("ORIGEN_DESTINO", "FIK_PROMEDIO")],
        F.max("TOTAL_VIAJES").alias("TOTAL_VIAJES"),
    )


def multi_ticket(df: DataFrame, min_tickets: int = 2) -> DataFrame:
    return df.where(F.col("SBol_Vend") >= min_tickets)


def customer_features_fik(df: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """Customer features with the favourite route, customers with several tickets only."""
    features = customer_features(df, categories)
    return multi_ticket(features.join(favourite_routes(customer_route_fik(df)), "EMAIL", "left"))


# --- skew -----------------------------------------------------------------------------

def _box_cox(x: Column, power: float) -> Column:
    if abs(power) < 1e-9:
        return F.ln(x)
    return (F.pow(x, F.lit(power)) - 1) / F.lit(power)


def _candidates(c: str) -> dict[str, tuple[Column, Column]]:
    """Transformations with the condition on the column minimum under which they apply."""
    x, lowest = F.col(c).cast("double"), F.min(c)
    return {
        "log1p": (F.when(x >= 0, F.log1p(x)), lowest >= 0),
        "log": (F.when(x > 0, F.ln(x)), lowest > 0),
        "sqrt": (F.when(x >= 0, F.sqrt(x)), lowest >= 0),
    }


def skew_candidates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Skewness of every column as it is and under each transformation that applies.

    One pass over the data gives one row, unpivoted to one row per column.
    """
    def measures(c: str) -> Column:
        parts = [F.lit(c).alias("columna"), sample_skewness(F.col(c).cast("double")).alias(
            "ninguna"), F.min(c).cast("double").alias("minimo"),
            F.count(c).alias("n")]
        for name, (value, allowed) in _candidates(c).items():
            parts.append(F.when(allowed, sample_skewness(value)).alias(name))
        return F.struct(*parts)

    return df.agg(F.array(*[measures(c) for c in cols]).alias("m")).select(
        F.inline("m"))


def box_cox_powers(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Power of highest likelihood for each (positive) column.

    Two passes over grids of powers, all columns at once, then the vertex of the parabola
    through the best three points.  Only the likelihoods come to the driver.
    """
    best = {c: (0.0, 2.0) for c in cols}
    for step in (0.25, 0.0125):
        grids = {c: [centre + step * i for i in range(-round(reach / step), round(reach / step) + 1)]
                 for c, (centre, reach) in best.items()}

        def likelihood(c: str, power: float) -> Column:
            x = F.col(c).cast("double")
            return ((F.lit(power) - 1) * F.sum(F.ln(x))
                    - F.count(x) / 2 * F.ln(F.var_pop(_box_cox(x, power))))

        row = df.agg(*[
            F.array(*[likelihood(c, p) for p in grid]).alias(c) for c, grid in grids.items()
        ]).first()
        for c, grid in grids.items():
            values = row[c]
            known = [i for i, v in enumerate(values) if v is not None]
            at = max(known, key=lambda i: values[i]) if known else 0
            centre = grid[at]
            if 0 < at < len(grid) - 1 and None not in values[at - 1:at + 2]:
                left, mid, right = values[at - 1:at + 2]
                bend = left - 2 * mid + right
                if bend < 0:
                    centre += step * 0.5 * (left - right) / bend
            best[c] = (centre, step)
    return {c: centre for c, (centre, _) in best.items()}


def choose_transforms(df: DataFrame, cols: Sequence[str], threshold: float = 1.5) -> list[dict]:
    """The transformation each column gets, its skewness before and after, and the gain.

    Columns at or above ``threshold`` take the candidate of least skewness; columns with
    fewer than two known values are left alone.
    """
    plan = []
    rows = {r["columna"]: r.asDict() for r in skew_candidates(df, cols).collect()}

    def is_skewed(c: str) -> bool:
        skew = rows[c]["ninguna"]
        return rows[c]["n"] >= 2 and skew is not None and abs(skew) >= threshold

    positive = [c for c in cols if is_skewed(c) and rows[c]["minimo"] > 0]
    powers = box_cox_powers(df, positive) if positive else {}
    after = df.agg(*[sample_skewness(_box_cox(F.col(c).cast("double"), p)).alias(c)
                     for c, p in powers.items()]).first() if powers else {}
    for c in cols:
        row = rows[c]
        options = {m: row[m] for m in ("log1p", "log", "sqrt") if row[m] is not None}
        if c in powers and after[c] is not None:
            options["boxcox"] = after[c]
        chosen, skew = "ninguna", row["ninguna"]
        if is_skewed(c) and options:
            chosen = min(options, key=lambda m: abs(options[m]))
            skew = options[chosen]
        before = row["ninguna"]
        gain = None if before is None else abs(before) - abs(skew)
        plan.append({"columna": c, "metodo": chosen, "potencia": powers.get(c),
                     "skew_antes": before, "skew_despues": skew, "mejora": gain,
                     "mejora_pct": gain / abs(before) * 100 if before else None})
    return plan


def apply_transforms(df: DataFrame, plan: Sequence[dict]) -> DataFrame:
    def changed(step: dict) -> Column:
        c = step["columna"]
        if step["metodo"] == "boxcox":
            return _box_cox(F.col(c).cast("double"), step["potencia"])
        return _candidates(c)[step["metodo"]][0]

    return df.withColumns({
        s["columna"]: changed(s) for s in plan if s["metodo"] != "ninguna"})


def reduce_skew(df: DataFrame, cols: Sequence[str],
                threshold: float = 1.5) -> tuple[DataFrame, list[dict]]:
    """Columns transformed to less skewness, and what was done to each."""
    plan = choose_transforms(df, cols, threshold)
    return apply_transforms(df, plan), plan


# --- clusters -------------------------------------------------------------------------

def _assembled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    filled = df.fillna(0.0, subset=list(cols))
    return VectorAssembler(inputCols=list(cols), outputCol="__x").transform(filled)


def prepare_clusters(features: DataFrame, cols: Sequence[str],
                     threshold: float = 1.5) -> DataFrame:
    """Customers with several tickets, skew reduced and scaled to 0..1, as vectors.

    The prepared vectors are computed once; every k-means pass reads them.
    """
    several = materialise(multi_ticket(features))
    reduced, _ = reduce_skew(several, cols, threshold)
    return materialise(_assembled(min_max(reduced, cols), cols).select("EMAIL", "__x"))


def choose_k(prepared: DataFrame, ks: Sequence[int] = tuple(range(2, 11)), seed: int = 42,
             cells: int = 256) -> list[tuple[int, float, float]]:
    """Euclidean silhouette of k-means for each k, and a bound of its error."""
    points = with_cells(prepared, "__x", cells, seed)
    found = []
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol="__x", predictionCol="Cluster").fit(points)
        found.append((k, *silhouette(model.transform(points), "__x")))
    return found


def cluster_customers(features: DataFrame, cols: Sequence[str], k: int = 5,
                      threshold: float = 1.5, seed: int = 42) -> DataFrame:
    """Untransformed metrics of customers with several tickets, and their cluster.

    With ``k=0`` the number of clusters is the one of best silhouette.
    """
    prepared = prepare_clusters(features, cols, threshold)
    if k == 0:
        k = max(choose_k(prepared, seed=seed), key=lambda found: found[1])[0]
    model = KMeans(k=k, seed=seed, featuresCol="__x", predictionCol="Cluster").fit(prepared)
    labels = model.transform(prepared).select("EMAIL", "Cluster")
    return multi_ticket(features).join(labels, "EMAIL", "left")


def cluster_sizes(df: DataFrame) -> DataFrame:
    """Customers and their share by cluster."""
    everyone: Column = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy("Cluster").agg(F.count(F.lit(1)).alias("clientes")).withColumn(
        "porcentaje", safe_div(F.col("clientes") * 100, everyone))


def fit_cluster_classifier(train: DataFrame, cols: Sequence[str], learner: str = "boosted",
                           trees: int = 100, depth: int = 6,
                           seed: int = 42) -> BoostedClasses | PipelineModel:
    """Classifier of the cluster from the customer features.

    ``boosted`` grows in each of ``trees`` rounds one tree per class, all classes together;
    ``forest`` grows ``trees`` independent trees.
    """
    if learner == "boosted":
        return fit_boosted(train, cols, "Cluster", trees, depth)
    if learner != "forest":
        raise ValueError("learner must be 'boosted' or 'forest'")
    assemble = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")
    stage = RandomForestClassifier(labelCol="Cluster", featuresCol="features",
                                   predictionCol="pred", numTrees=trees, maxDepth=depth, seed=seed)
    rows = train.fillna(0.0, subset=list(cols)).where(F.col("Cluster").isNotNull())
    return Pipeline(stages=[assemble, stage]).fit(rows)


def classify_customers(features: DataFrame, model: BoostedClasses | Model,
                       cols: Sequence[str]) -> DataFrame:
    """Predicted cluster of each customer."""
    if isinstance(model, BoostedClasses):
        return model.transform(features, ["EMAIL"], "Cluster")
    scored = model.transform(features.fillna(0.0, subset=list(cols)))
    return scored.select("EMAIL", F.col("pred").cast("int").alias("Cluster"))


def known_customers(tickets: DataFrame, customers: DataFrame,
                    row_id: Sequence[str] = TICKET) -> DataFrame:
    """Tickets of customers that have a cluster, with it; hot customers are spread."""
    return spread_join(tickets, customers.select("EMAIL", "Cluster"), ["EMAIL"], "inner", row_id)


def unknown_customers(tickets: DataFrame, customers: DataFrame,
                      row_id: Sequence[str] = TICKET) -> DataFrame:
    """Tickets of all other customers."""
    return spread_join(tickets, customers.select("EMAIL"), ["EMAIL"], "left_anti", row_id)


def predict_clusters(tickets: DataFrame, model: BoostedClasses | Model, customers: DataFrame,
                     categories: dict[str, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """Known tickets with their cluster, and new ones with the predicted one."""
    known = known_customers(tickets, customers)
    new = unknown_customers(tickets, customers)
    cols = feature_columns(categories)
    labels = classify_customers(customer_features(new, categories), model, cols)
    return known, spread_join(new, labels, ["EMAIL"], "left", TICKET)


def with_uplift(known: DataFrame, predicted: DataFrame) -> DataFrame:
    """Known and predicted tickets together, with the fare uplift of their cluster."""
    return known.unionByName(predicted).withColumn("Aumento", lookup("Cluster", CLUSTER_UPLIFT))
