"""Hedonic features of listings, building keys and deterministic splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.order import dense_index, grouped_medians, random_order, uniform
from hearth.functions.text import norm_address
from hearth.operators.clean import cast_numeric
from hearth.operators.geo import cell_key
from hearth.schema import KEY, NUMERIC

YEAR = 2026
#: Categories of services near a listing (fixed values).
SERVICES = ["metro", "salud", "comercio", "universidad", "educacion", "parque", "supermercado"]
SERVICE_JSON = ", ".join([*(f"{c} struct<mas_cercano_m: double, nombre: string, n_1km: double>" for c in SERVICES), "_truncado boolean"])
STRUCTURAL = ["m2_util", "m2_total", "dormitorios", "banos", "estacionamientos", "bodegas", "antiguedad", "gastos_comunes_clp", "log_m2_util", "ratio_terraza", "m2_por_dormitorio", "densidad_banos", "es_casa", "tiene_estacionamiento", "tiene_bodega"]
LOCATION = ["lat", "lon", "sin_geo"]
NEIGHBOURHOOD = [*(f"log_dist_{c}" for c in SERVICES), *(f"n_{c}_1km" for c in SERVICES), "servicios_truncado", "sin_servicios"]
BLOCKS = {"structural": STRUCTURAL, "location": LOCATION, "neighbourhood": NEIGHBOURHOOD}
#: What a feature must never hold: the price in any form, what follows from it, the source.
FORBIDDEN = {"precio_uf", "precio_clp", "precio_valor", "precio_moneda", "y", "sitio", "id_aviso"}


def expand_services(df: DataFrame) -> DataFrame:
    """Distances and counts of each category from the services text; null where it is absent."""
    j = F.from_json(F.when(~F.col("servicios_cercanos").isin("", "SIN_DATO"), F.col("servicios_cercanos")), SERVICE_JSON)
    made = df.withColumn("services", j)
    cols: dict[str, Column] = {}
    for c in SERVICES:
        cols |= {f"dist_{c}_m": F.col(f"services.{c}.mas_cercano_m"), f"n_{c}_1km": F.col(f"services.{c}.n_1km")}
    cols["servicios_truncado"] = F.when(F.col("services").isNotNull(), F.coalesce(F.col("services._truncado"), F.lit(False)).cast("double"))
    return made.withColumns(cols).drop("services")


def build_features(df: DataFrame, year: int = YEAR) -> DataFrame:
    """Structural, location and neighbourhood features of typed listings with a services text."""
    rooms = F.greatest(F.coalesce("dormitorios", F.lit(1.0)), F.lit(1.0))
    some = lambda c: (F.coalesce(c, F.lit(0.0)) > 0).cast("double")
    made = expand_services(df).withColumns({
        "antiguedad": F.lit(float(year)) - F.col("ano_construccion"),
        "log_m2_util": F.ln("m2_util"),
        "ratio_terraza": F.when(F.col("m2_total") > 0, (F.col("m2_total") - F.col("m2_util")) / F.col("m2_total")),
        "m2_por_dormitorio": F.col("m2_util") / rooms,
        "densidad_banos": F.col("banos") / rooms,
        "es_casa": F.coalesce(F.col("tipo") == "casa", F.lit(False)).cast("double"),
        "tiene_estacionamiento": some("estacionamientos"),
        "tiene_bodega": some("bodegas"),
        "sin_geo": (F.col("lat").isNull() | F.col("lon").isNull()).cast("double"),
    })
    logs = {f"log_dist_{c}": F.log1p(f"dist_{c}_m") for c in SERVICES}
    return made.withColumns(logs | {"sin_servicios": F.col(f"dist_{SERVICES[0]}_m").isNull().cast("double")})


def select_blocks(df: DataFrame, extra: list[str] = (), more: list[Column] = ()) -> DataFrame:
    """The features in fixed order, then more of them; refuses those that the analysed frame makes of forbidden columns, under whatever name.

    extra: columns kept beside the features, which may be forbidden ones.
    """
    features = df.select(*[c for b in BLOCKS.values() for c in b], "comuna", *more)
    made = features._jdf.queryExecution().analyzed().expressions()
    seen = {a.name() for i in range(made.size()) for a in _each(made.apply(i).references().toSeq())}
    if bad := FORBIDDEN & (seen | set(features.columns)):
        raise ValueError(f"features must not hold {sorted(bad)}")
    return df.select(*extra, *[c for b in BLOCKS.values() for c in b], "comuna", *more)


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def missing_by_block(df: DataFrame) -> DataFrame:
    """(block, pct_missing): the mean of the columns' shares of nulls."""
    means = df.agg(*[(100.0 * sum(F.avg(F.col(c).isNull().cast("double")) for c in cols) / len(cols)).alias(b) for b, cols in BLOCKS.items()])
    return means.unpivot([], list(BLOCKS), "block", "pct").select("block", F.round("pct", 6).alias("pct_missing"))


def scoring_input(df: DataFrame, year: int = YEAR) -> DataFrame:
    """Features of incomplete listings: absent columns count as null."""
    lacking = [c for c in [*NUMERIC, "servicios_cercanos", "tipo", "comuna"] if c not in df.columns]
    return build_features(cast_numeric(df.withColumns({c: F.lit(None).cast("string") for c in lacking})), year)


def building_key(df: DataFrame) -> DataFrame:
    """df with building: the point to 4 decimals, else the address, else the listing itself."""
    address = norm_address(F.col("direccion"))
    point = F.concat(F.lit("g:"), cell_key(F.col("lat"), F.col("lon"), 4))
    return df.withColumn("building", F.coalesce(point, F.when(address != "", F.concat(F.lit("d:"), address)), F.concat(F.lit("u:"), F.concat_ws(":", *KEY))))


def split_by_group(df: DataFrame, group: str, frac: float = 0.2, seed: int = 42, mode: str = "hash", name: str = "side") -> DataFrame:
    """df with a side, test or train; all rows of a group lie on one.

    hash: each group by its own hash, without a shuffle.  exact: ceil(frac * groups) groups.
    """
    if mode == "hash":
        return df.withColumn(name, F.when(uniform(F.col(group), seed) < frac, "test").otherwise("train"))
    groups = df.select(group).distinct()
    ranked = dense_index(groups, [random_order(F.col(group), seed), F.col(group)])
    n = groups.agg(F.ceil(F.count("*") * F.lit(frac)).alias("most"))
    sides = ranked.crossJoin(F.broadcast(n)).select(group, F.when(F.col("index") < F.col("most"), "test").otherwise("train").alias(name))
    return df.join(sides, group)


def leak_count(df: DataFrame, group: str, side: str = "side") -> DataFrame:
    """Groups, and those that lie on both sides."""
    return df.groupBy(group).agg(F.count_distinct(side).alias("sides")).agg(F.count("*").alias("groups"), F.count_if(F.col("sides") > 1).alias("leaking"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows at random without replacement, the same for the same keys."""
    return df.orderBy(random_order(F.col(key), seed), key).limit(n)


def one_per_situation(df: DataFrame, situation: Column, key: str, seed: int = 42) -> DataFrame:
    """One row at random of each situation."""
    made = df.withColumn("situation", situation)
    return made.withColumn("nth", F.row_number().over(W.partitionBy("situation").orderBy(random_order(F.col(key), seed), key))).where("nth = 1").drop("nth")


def split_composition(df: DataFrame, by: str = "sitio", value: str = "y") -> DataFrame:
    """Share of each source and median of the target on both sides."""
    rows = grouped_medians(df, ["side", by], {"median": F.col(value)}, (F.count("*").alias("n"),)).withColumn("median", F.round("median", 4))
    return rows.withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy("side")), 4))
