"""The fare model: features, training, serving and quoting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import clock_hour, deck_class, lookup, route_key
from farelens.functions.fixed import (
    CLIENT_TYPES, DECKS, GOOD_HOURS, GOOD_MONTHS, GOOD_SEATS, GOOD_WEEKDAYS,
    PASSENGER_DISCOUNT, TRAINED_MEAN_DISCOUNT,
)
from farelens.operators.features import moments, one_hot
from farelens.operators.network import Network, fit_network

NUMERIC = [
    "DiaSemana_Corrida", "Hora_Corrida", "NUM_ASIENTO", "HORAS_ANTICIPACION", "DIF_TBT_VENTA",
    "Mes_Corrida", "Anio_Corrida",
]
FLAGS = ["Buen_Dia", "Buena_Hora", "Buen_Mes", "Buen_Asiento"]


def good_seat(capacity: str = "CAPACIDAD_ASIENTOS_TRAMO", seat: str = "NUM_ASIENTO",
              seats: dict[int, Sequence[int]] | None = None) -> Column:
    """1 for a seat in demand at this capacity, 0 otherwise or at an unknown capacity."""
    table = {cap: F.array(*[F.lit(s) for s in found])
             for cap, found in (GOOD_SEATS if seats is None else seats).items()}
    entries = [part for cap, found in table.items() for part in (F.lit(cap), found)]
    listed = F.try_element_at(F.create_map(*entries), F.col(capacity).cast("int"))
    return F.coalesce(F.array_contains(listed, F.col(seat).cast("int")).cast("int"), F.lit(0))


def good_flags(df: DataFrame) -> DataFrame:
    """Flags for weekdays, hours, months and seats in high demand."""
    def flag(value: Column, listed: Sequence[int]) -> Column:
        return F.coalesce(value.isin(list(listed)).cast("int"), F.lit(0))

    return df.withColumns({
        "Buen_Dia": flag(F.weekday("FECHA_CORRIDA"), GOOD_WEEKDAYS),
        "Buena_Hora": flag(clock_hour("HORA_SALIDA_CORRIDA"), GOOD_HOURS),
        "Buen_Mes": flag(F.month("FECHA_CORRIDA"), GOOD_MONTHS),
        "Buen_Asiento": good_seat(),
    })


def fare_features(df: DataFrame, clients: Sequence[str] = CLIENT_TYPES,
                  keep: Sequence[str] = ()) -> DataFrame:
    """The model frame: route, calendar, seat, lead time, flags, dummies and the sale."""
    calendar = good_flags(df).withColumns({
        "Origen_Destino": route_key(),
        "DiaSemana_Corrida": F.weekday("FECHA_CORRIDA"),
        "Hora_Corrida": clock_hour("HORA_SALIDA_CORRIDA"),
        "Mes_Corrida": F.month("FECHA_CORRIDA"),
        "Anio_Corrida": F.year("FECHA_CORRIDA"),
        "TIPO_CLASE": deck_class(),
    })
    coded = one_hot(one_hot(calendar, "TIPO_CLIENTE", clients, "TIPO_CLIENTE"),
                    "TIPO_CLASE", DECKS, "PISO")
    columns = ["Origen_Destino", *NUMERIC, *FLAGS, *[f"TIPO_CLIENTE_{c}" for c in clients],
               *[f"PISO_{c}" for c in DECKS], "VENTA"]
    return coded.select(*[c for c in keep if c not in columns], *columns)


def serving_features(df: DataFrame, clients: Sequence[str] = CLIENT_TYPES,
                     mean: float | Column = TRAINED_MEAN_DISCOUNT,
                     keep: Sequence[str] = ()) -> DataFrame:
    """The same frame when quoting: the discount is not known yet, so its training mean
    stands in; unknown values become 0 and every training column is there."""
    stand_in = F.lit(mean) if isinstance(mean, float) else mean
    found = fare_features(df.withColumn("DIF_TBT_VENTA", stand_in), clients, keep)
    return found.fillna(0)


def route_dummies(df: DataFrame, routes: Sequence[str]) -> DataFrame:
    """0/1 columns of the routes the model was trained on."""
    return one_hot(df, "Origen_Destino", routes, "RUTA")


def model_inputs(routes: Sequence[str], clients: Sequence[str] = CLIENT_TYPES) -> list[str]:
    """The ordered inputs of the model (27 for nine routes and five client types)."""
    return ([f"RUTA_{r}" for r in routes] + NUMERIC + FLAGS
            + [f"TIPO_CLIENTE_{c}" for c in clients] + [f"PISO_{c}" for c in DECKS])


def _scaling(stats: dict[str, float]) -> SQLTransformer:
    """Population z-scores with the training moments, as a stage saved with the model."""
    scaled = ", ".join(
        f"(`{c}` - {stats[f'{c}__mean']!r}D) / {stats[f'{c}__sd'] or 1.0!r}D AS `z_{c}`"
        for c in NUMERIC)
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def fit_fare_model(train: DataFrame, routes: Sequence[str],
                   clients: Sequence[str] = CLIENT_TYPES, rounds: int = 40, depth: int = 6,
                   seed: int = 42) -> PipelineModel:
    """Boosted regression trees of the sale on the 27 inputs, scaling included.

    The moments of the numeric inputs are one row; they become constants of the saved
    pipeline, so serving scales exactly as training did.
    """
    stats = moments(train, NUMERIC).first().asDict()
    stats = {k: (0.0 if v is None else float(v)) for k, v in stats.items()}
    names = [f"z_{n}" if n in NUMERIC else n for n in model_inputs(routes, clients)]
    learner = GBTRegressor(labelCol="VENTA", featuresCol="features", predictionCol="TARIFA_DINAMICA",
                           maxIter=rounds, maxDepth=depth, seed=seed, subsamplingRate=0.8)
    assemble = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    rows = route_dummies(train, routes).fillna(0.0, subset=NUMERIC)
    return Pipeline(stages=[_scaling(stats), assemble, learner]).fit(rows)


def fit_fare_network(train: DataFrame, routes: Sequence[str], row_id: Sequence[str],
                     clients: Sequence[str] = CLIENT_TYPES, hidden: Sequence[int] = (128, 64),
                     epochs: int = 8, batches: int = 16, seed: int = 42) -> Network:
    """Dense network of the sale on the 27 inputs, two hidden layers, scaling included."""
    return fit_network(route_dummies(train, routes), model_inputs(routes, clients), "VENTA",
                       row_id, hidden, epochs, batches, seed=seed)


def quote_network(features: DataFrame, model: Network, routes: Sequence[str],
                  keep: Sequence[str]) -> DataFrame:
    """``keep`` and the network's fare of every row."""
    return model.transform(route_dummies(features, routes), keep, "TARIFA_DINAMICA")


def quote(features: DataFrame, model: PipelineModel, routes: Sequence[str]) -> DataFrame:
    """The model's fare of every row, all rows in one pass."""
    helpers = [f"RUTA_{r}" for r in routes] + [f"z_{c}" for c in NUMERIC] + ["features"]
    return model.transform(route_dummies(features, routes)).drop(*helpers)


def passenger_discount(df: DataFrame, kind: str = "TIPO_PASAJERO") -> DataFrame:
    """Discount fraction of the passenger type, NULL for an unknown type."""
    return df.withColumn("Descuento", lookup(kind, PASSENGER_DISCOUNT) / 100)
