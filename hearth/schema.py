"""The listing tables: columns, types and the sentinel of missing text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL = "SIN_DATO"

#: Columns of a raw listing, in the order of exports (fixed values).
RAW_COLUMNS = [
    "sitio", "id_aviso", "url", "operacion", "tipo", "comuna", "barrio", "direccion", "titulo",
    "precio_valor", "precio_moneda", "precio_clp", "precio_uf", "m2_util", "m2_total",
    "dormitorios", "banos", "estacionamientos", "bodegas", "antiguedad_anos", "ano_construccion",
    "gastos_comunes_clp", "antiguedad_aviso_dias", "fecha_publicacion", "lat", "lon",
    "descripcion", "publica", "detalle_ok", "fecha_scrape",
]
#: Columns that hold numbers once typed.
NUMERIC = [
    "precio_uf", "precio_clp", "m2_util", "m2_total", "dormitorios", "banos", "estacionamientos",
    "bodegas", "ano_construccion", "antiguedad_anos", "gastos_comunes_clp", "lat", "lon",
]
KEY = ["sitio", "id_aviso"]

RAW_LISTING = T.StructType([T.StructField(c, T.IntegerType() if c == "detalle_ok" else T.StringType()) for c in RAW_COLUMNS])
LISTING = T.StructType([T.StructField(c, T.DoubleType() if c in NUMERIC else f.dataType) for c, f in zip(RAW_COLUMNS, RAW_LISTING, strict=True)])
RECORD = T.StructType(
    [T.StructField(c, T.DoubleType() if c in ("precio_valor", "precio_clp", "precio_uf", "m2_util", "m2_total", "gastos_comunes_clp", "lat", "lon") else T.IntegerType() if c in ("dormitorios", "banos", "estacionamientos", "bodegas", "antiguedad_anos", "ano_construccion", "detalle_ok") else T.StringType()) for c in RAW_COLUMNS]
    + [T.StructField("es_proyecto", T.IntegerType()), T.StructField("uf_usada", T.DoubleType()), T.StructField("origen", T.StringType()), T.StructField("fecha_consulta", T.StringType()), T.StructField("fuente", T.StringType()), T.StructField("advertencias", T.ArrayType(T.StringType())), T.StructField("fuera_de_cobertura", T.BooleanType())]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; those that df lacks are null, others keep their place after them."""
    have = set(df.columns)
    own = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*own, *[c for c in df.columns if c not in schema.fieldNames()])
