"""Typing, repair and range rules of listings. Rules are tables, so one pass applies and counts them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.numbers import as_double
from hearth.functions.order import grouped_medians, grouped_quantiles
from hearth.schema import NUMERIC, SENTINEL

#: Plausible ranges, the box of the four communes and the filters of both markets (fixed values).
RANGES = {"estacionamientos": (0, 10), "bodegas": (0, 10), "dormitorios": (0, 10), "banos": (1, 12), "ano_construccion": (1900, 2030), "gastos_comunes_clp": (0, 3_000_000)}
BOX = {"lat": (-33.62, -33.40), "lon": (-70.72, -70.48)}
FILTERS = {"venta": ("precio_uf", 500, 60_000, 20, 800), "arriendo": ("precio_clp", 150_000, 4_000_000, 15, 600)}


def null_sentinel(df: DataFrame, token: str = SENTINEL) -> DataFrame:
    """The sentinel text becomes null in every text column."""
    return df.select(*[F.nullif(c, F.lit(token)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def cast_numeric(df: DataFrame, cols: list[str] = NUMERIC) -> DataFrame:
    """Columns as finite doubles; what isn't a number is null."""
    return df.withColumns({c: as_double(F.col(c)) for c in cols if c in df.columns})


def drop_empty(df: DataFrame) -> DataFrame:
    """df without the columns that hold no value at all."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if counts[c] == 0])


def between(c: str, lo: float, hi: float) -> Column:
    return F.coalesce(F.col(c).between(lo, hi), F.lit(False))


def infer_rate(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The median of CLP over UF where both are known: one row, or one for each group."""
    ratio = F.when(F.col("precio_uf") > 0, F.col("precio_clp") / F.col("precio_uf"))
    return grouped_medians(df, by or [], {"rate": ratio})


def swapped() -> Column:
    """Year and age exchanged."""
    return between("ano_construccion", 0, 60) & between("antiguedad_anos", 1900, 2030)


def rules() -> dict[str, Column]:
    """Repairs by name: the rows hit, as a condition on the typed listing."""
    return {
        "swap": swapped(),
        "uf_from_clp": F.col("precio_uf").isNull() & F.col("precio_clp").isNotNull(),
        "clp_from_uf": F.col("precio_clp").isNull() & F.col("precio_uf").isNotNull(),
        "bad_geo": F.col("lat").isNotNull() & ~(between("lat", *BOX["lat"]) & between("lon", *BOX["lon"])),
        "total_below_util": F.coalesce(F.col("m2_util") > F.col("m2_total"), F.lit(False)),
        "zero_costs": F.coalesce((F.col("tipo") == "departamento") & (F.col("gastos_comunes_clp") == 0), F.lit(False)),
    }


def repair(df: DataFrame, rate: DataFrame | None = None, box: bool = True, prices: str = "both") -> DataFrame:
    """The repaired listing: swap, prices rebuilt, impossible values nulled; no row goes.

    rate: one row, by default inferred from df itself. prices: "both" ways, or only those in "uf" (sales) or "clp" (rents).
    """
    rate = infer_rate(df) if rate is None else rate
    hit = rules()
    rebuilt = df.crossJoin(F.broadcast(rate)).withColumns({
        "ano_construccion": F.when(swapped(), F.col("antiguedad_anos")).otherwise(F.col("ano_construccion")),
        "antiguedad_anos": F.when(swapped(), F.col("ano_construccion")).otherwise(F.col("antiguedad_anos")),
        "precio_uf": F.coalesce("precio_uf", F.try_divide("precio_clp", "rate")) if prices != "clp" else F.col("precio_uf"),
        "precio_clp": F.coalesce("precio_clp", F.col("precio_uf") * F.col("rate")) if prices != "uf" else F.col("precio_clp"),
    })
    fixed = {c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in RANGES.items()}
    fixed["gastos_comunes_clp"] = F.when(~hit["zero_costs"], fixed["gastos_comunes_clp"])
    fixed["m2_total"] = F.when(~hit["total_below_util"], F.col("m2_total"))
    if box:
        fixed |= {c: F.when(~hit["bad_geo"], F.col(c)) for c in ("lat", "lon")}
    return rebuilt.withColumns(fixed).drop("rate")


def repair_log(df: DataFrame) -> DataFrame:
    """(rule, kind, n_rows, pct) of the typed listings: what repair() would change, in one pass."""
    after_swap = {"ano_construccion": F.when(swapped(), F.col("antiguedad_anos")).otherwise(F.col("ano_construccion"))}
    out = {f"{c}_out_of_range": after_swap.get(c, F.col(c)).isNotNull() & ~F.coalesce(after_swap.get(c, F.col(c)).between(lo, hi), F.lit(False)) for c, (lo, hi) in RANGES.items()}
    every = rules() | out
    fixed = {"swap", "uf_from_clp", "clp_from_uf"}
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(cond).alias(name) for name, cond in every.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit("repaired" if n in fixed else "nulled").alias("kind"), F.col(n).alias("n_rows")) for n in every])).alias("r")
    return counts.select("total", rows).select("r.rule", "r.kind", "r.n_rows", F.round(100.0 * F.col("r.n_rows") / F.col("total"), 4).alias("pct"))


def target_filter(df: DataFrame) -> DataFrame:
    """Rows within their market's range of price and area; y is the target in the market's unit."""
    keep = [(F.col("operacion") == op) & F.col(c).between(lo, hi) & F.col("m2_util").between(a, b) for op, (c, lo, hi, a, b) in FILTERS.items()]
    y = F.coalesce(*[F.when(F.col("operacion") == op, F.col(f[0])) for op, f in FILTERS.items()])
    return df.where(reduce(lambda a, b: a | b, keep)).withColumn("y", y)


def coverage(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Share of known values of each column, in percent, in long form."""
    by = by or []
    made = df.groupBy(*by).agg(*[F.round(100.0 * F.count(c) / F.count("*"), 4).alias(c) for c in cols])
    return made.unpivot(by, cols, "column", "pct")


def percentile_trim(df: DataFrame, value: Column, by: list[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Rows whose value lies between two percentiles of their group."""
    rows = df.withColumn("trim_value", value)
    edges = grouped_quantiles(rows, by, {"edges": F.col("trim_value")}, [lo, hi]).select(*by, "edges")
    return rows.join(edges, by).where(F.col("trim_value").between(F.col("edges")[0], F.col("edges")[1])).drop("edges", "trim_value")
