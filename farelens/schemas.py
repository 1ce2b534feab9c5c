"""Declared schemas.  Every reader uses one; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _L, _D, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

SALES = _struct(
    OPERACION=_L, TRANSACCION=_L, FECHA_OPERACION=_DATE, HORA_OPERACION=_S,
    NOMBRE_DIA_OPERACION=_S, AREA_VENTA=_S, CLASE_SERVICIO=_S, ORIGEN=_S, DESTINO=_S,
    CV_CORRIDA=_S, FECHA_CORRIDA=_DATE, HORA_SALIDA_CORRIDA=_S, TIPO_PASAJERO=_S,
    TIPO_CLIENTE=_S, TIPO_OPERACION=_S, VENTA_ANTICIPADA=_S, NOMBRE_PASAJERO=_S,
    NUM_ASIENTO=_I, PORCENT_PROMO=_D, DESC_DESCUENTO=_S, BOLETOS_CANCEL=_I,
    BOLETOS_TOTALES=_I, BOLETOS_VEND=_I, VENTA_CANCEL=_D, IVA_CANCEL=_D, IVA_VENDIDO=_D,
    VENTA_TOTAL=_D, VENTA=_D,
)

TRIPS = _struct(
    FECHA_CORRIDA=_DATE, CV_CORRIDA=_S, CV_ASIGN=_S, ORIGEN_CORRIDA=_S, DESTINO_CORRIDA=_S,
    HORA_SALIDA_ORIGEN_CORRIDA=_S, KMS_ACUM_CORRIDA=_D, ORIGEN=_S, DESTINO=_S,
    HORA_SALIDA_CORRIDA=_S, NOMBRE_DIA_CORRIDA=_S, EMPRESA=_S, TIPO_CORRIDA=_S, TIPO_BUS=_S,
    TARIFA_BASE_TRAMO=_D, IVA_TARIFA_BASE_TRAMO=_D, INGRESO_TRANSP=_D, IVA_TRANSP=_D,
    KMS_TRAMO=_D, CAPACIDAD_ASIENTOS_TRAMO=_I, DISPONIBILIDAD_TRAMO=_I, OCUPACION_PUNTO=_I,
    OCUPACION_TRAMO=_I, INGRESO_TEORICO_TRAMO=_D, PAX_BAJAN=_I, PAX_SUBEN=_I,
)

LOYALTY = _struct(
    TRANSACCION=_L, FECHA_OPERACION=_DATE, FECHA_CORRIDA=_DATE, ORIGEN=_S, DESTINO=_S,
    TARJETA=_S, EFECTIVO=_D, EMAIL=_S,
)

CONTACTS = _struct(
    OPERACION=_L, TEL_PASAJERO=_S, CORREO_ELECTRONICO=_S, MEMBRESIA_CRM=_S, ORIGEN=_S,
    DESTINO=_S, FECHA_OPERACION=_DATE, HORA_OPERACION=_S,
)

ROUTES = _struct(ORIGEN=_S, DESTINO=_S)
CALENDAR = _struct(ORIGEN_DESTINO=_S, FECHA_CORRIDA=_DATE, ELASTICIDADES=_D)
CLUSTERED = _struct(EMAIL=_S, Cluster=_I)
RULES = _struct(
    MesBueno=T.ArrayType(_I), HoraBuena=T.ArrayType(_I), DiaBueno=T.ArrayType(_I),
    AsientosBuenos=T.MapType(_S, T.ArrayType(_I)),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns ``df`` shares with ``schema`` to the declared types.

    Columns of the schema come first and in its order; columns it does not name are
    kept as they are.
    """
    known = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.names]
    return df.select(*known, *extra)
