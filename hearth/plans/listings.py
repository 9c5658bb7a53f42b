"""The given tables read as listings, places and calls, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators.clean import cast_numeric, infer_rate, null_sentinel, repair, target_filter
from hearth.operators.geo import cells
from hearth.functions.order import grouped_quantiles
from hearth.sources.scratch import stored
from hearth.schema import RAW_COLUMNS, SENTINEL
from hearth.sources.tables import read_table


def spread(df: DataFrame) -> DataFrame:
    """df; where its files make fewer tasks than there are cores its rows, narrow ones, are dealt out before long work on each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


#: Columns that the given tables hold nothing for.
UNUSED = ["url", "barrio", "titulo", "precio_valor", "precio_moneda", "antiguedad_aviso_dias", "descripcion", "publica"]

STUDIED = ["sitio", "id_aviso", "operacion", "tipo", "comuna", "m2_util", "precio_uf", "precio_clp", "dormitorios", "lat", "lon", "direccion"]


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw listings, all text, with the sentinel; a customer stands for a building."""
    k, b = F.col("o_orderkey"), F.col("o_custkey")
    cp, text = k % 4 == 0, lambda c: c.cast("string")
    year = F.lit(1950) + b % 76
    age = F.lit(2026) - year
    swap = k % 97 == 0
    u = F.floor("o_totalprice").cast("double") / F.when(k % 3 == 0, F.lit(5000.0)).otherwise(F.lit(20.0))
    util = F.lit(15) + (b * 7 + k) % 200
    point = lambda lo, f: F.lit(lo) + (b * f % 2000) / F.lit(10000.0) + F.lit(0.00003)
    unless = lambda cond, c: F.when(cond, SENTINEL).otherwise(text(c))
    cols: dict[str, Column] = dict.fromkeys(RAW_COLUMNS, F.lit(SENTINEL)) | {
        "sitio": F.when(cp, "cp").otherwise("pi"), "id_aviso": text(k), "operacion": F.when(k % 3 == 0, "arriendo").otherwise("venta"),
        "tipo": F.when(k % 5 == 0, "casa").otherwise("departamento"), "comuna": F.element_at(F.array(*[F.lit(c) for c in ("macul", "la-florida", "nunoa", "san-miguel")]), (b % 4 + 1).cast("int")),
        "m2_util": text(util), "m2_total": unless(cp, util + k % 40 - 3), "dormitorios": text((b + k) % 12), "banos": text(k % 14),
        "estacionamientos": text(k % 13), "bodegas": unless(cp, k % 3), "ano_construccion": text(F.when(swap, age).otherwise(year)), "antiguedad_anos": text(F.when(swap, year).otherwise(age)),
        "gastos_comunes_clp": unless(cp, k % 9 * 20000), "precio_uf": unless(k % 7 == 0, u), "precio_clp": unless((k % 11 == 0) & (k % 7 != 0), u * 40000),
        "lat": unless(cp, point(-33.60, 37)), "lon": unless(cp, point(-70.70, 53)), "direccion": F.concat(F.lit("calle "), text(b % 500)),
        "fecha_publicacion": text(F.to_date("o_orderdate")), "detalle_ok": (k % 10 != 0).cast("int"), "fecha_scrape": F.concat(F.lit("2026-01-0"), text(k % 3 + 1)),
    }
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return spread(orders).select(*[c.alias(n) for n, c in cols.items()])


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_numeric(null_sentinel(raw_listings(spark, sf_dir)))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    return repair(rows, spark.createDataFrame([tuple(infer_rate(rows).first())], "rate double"))  # one number, found once


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns that hold anything; filtered when they are stored, since a filter on the chain of repairs would work it out again for each condition."""
    return target_filter(stored(clean(spark, sf_dir).drop(*UNUSED)))


def slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the targets that studies need, as a stored table: they read it several times, and the chain of repairs is long."""
    return target_filter(stored(clean(spark, sf_dir).select(*STUDIED)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with the median of their commune, kind and market as pred, and the group's quartiles as lo and hi."""
    rows = slim(spark, sf_dir)
    by = ["comuna", "tipo", "operacion"]
    groups = grouped_quantiles(rows, by, {"q": F.col("y")}, [0.25, 0.5, 0.75]).select(*by, F.col("q")[1].alias("pred"), F.col("q")[0].alias("lo"), F.col("q")[2].alias("hi"))
    return rows.join(groups, by)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as places found by category."""
    s = F.col("s_suppkey")
    kind = F.element_at(F.array(*[F.lit(c) for c in ("metro", "comercio", "salud", "universidad")]), (s % 4 + 1).cast("int"))
    at = lambda lo, f: F.lit(lo) + (s * f % 2000) / F.lit(10000.0) + F.lit(0.00003)
    return table(spark, sf_dir, "supplier").select(s.alias("poi_id"), kind.alias("categoria"), F.col("s_name").alias("nombre"), at(-33.60, 733).alias("lat"), at(-70.70, 1511).alias("lon"), F.greatest(F.floor(F.col("s_acctbal") / 10), F.lit(0)).cast("int").alias("resenas"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct cells of the listings, as a stored table."""
    return stored(cells(stored(clean(spark, sf_dir).select("lat", "lon"))).select(F.col("cell").alias("point"), "lat", "lon"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of calls; errors are rejections."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("call_id"), F.col("ts").alias("cuando"), F.when(F.col("event_type") == "error", "rechazo").otherwise("ok").alias("estado"))


#: The same tables as SQL: typed, rate, clean, targets, predictions, places, points, calls.
SQL = """
WITH o AS (SELECT *, o_orderkey AS k, o_custkey AS b, floor(o_totalprice)::DOUBLE / CASE WHEN o_orderkey % 3 = 0 THEN 5000::DOUBLE ELSE 20::DOUBLE END AS u, 15 + (o_custkey * 7 + o_orderkey) % 200 AS mu, 1950 + o_custkey % 76 AS yr FROM orders),
typed AS (SELECT
  CASE WHEN k % 4 = 0 THEN 'cp' ELSE 'pi' END AS sitio, k::VARCHAR AS id_aviso, CASE WHEN k % 3 = 0 THEN 'arriendo' ELSE 'venta' END AS operacion,
  CASE WHEN k % 5 = 0 THEN 'casa' ELSE 'departamento' END AS tipo, ['macul', 'la-florida', 'nunoa', 'san-miguel'][(b % 4 + 1)::INT] AS comuna,
  mu::DOUBLE AS m2_util, CASE WHEN k % 4 <> 0 THEN (mu + k % 40 - 3)::DOUBLE END AS m2_total, ((b + k) % 12)::DOUBLE AS dormitorios, (k % 14)::DOUBLE AS banos,
  (k % 13)::DOUBLE AS estacionamientos, CASE WHEN k % 4 <> 0 THEN (k % 3)::DOUBLE END AS bodegas,
  (CASE WHEN k % 97 = 0 THEN 2026 - yr ELSE yr END)::DOUBLE AS ano_construccion, (CASE WHEN k % 97 = 0 THEN yr ELSE 2026 - yr END)::DOUBLE AS antiguedad_anos,
  CASE WHEN k % 4 <> 0 THEN (k % 9 * 20000)::DOUBLE END AS gastos_comunes_clp, CASE WHEN k % 7 <> 0 THEN u END AS precio_uf, CASE WHEN NOT (k % 11 = 0 AND k % 7 <> 0) THEN u * 40000::DOUBLE END AS precio_clp,
  CASE WHEN k % 4 <> 0 THEN -33.60::DOUBLE + (b * 37 % 2000) / 10000::DOUBLE + 0.00003::DOUBLE END AS lat, CASE WHEN k % 4 <> 0 THEN -70.70::DOUBLE + (b * 53 % 2000) / 10000::DOUBLE + 0.00003::DOUBLE END AS lon,
  'calle ' || (b % 500) AS direccion, o_orderdate::DATE AS fecha_publicacion, (k % 10 <> 0)::INT AS detalle_ok, '2026-01-0' || (k % 3 + 1) AS fecha_scrape FROM o),
rate AS (SELECT median(precio_clp / precio_uf) FILTER (precio_uf > 0) AS rate FROM typed),
swapped AS (SELECT * REPLACE (CASE WHEN sw THEN antiguedad_anos ELSE ano_construccion END AS ano_construccion, CASE WHEN sw THEN ano_construccion ELSE antiguedad_anos END AS antiguedad_anos, coalesce(precio_uf, precio_clp / rate) AS precio_uf, coalesce(precio_clp, precio_uf * rate) AS precio_clp)
  FROM (SELECT *, coalesce(ano_construccion BETWEEN 0 AND 60 AND antiguedad_anos BETWEEN 1900 AND 2030, false) AS sw FROM typed, rate)),
clean AS (SELECT * EXCLUDE (sw, rate) REPLACE (
  CASE WHEN estacionamientos BETWEEN 0 AND 10 THEN estacionamientos END AS estacionamientos, CASE WHEN bodegas BETWEEN 0 AND 10 THEN bodegas END AS bodegas, CASE WHEN dormitorios BETWEEN 0 AND 10 THEN dormitorios END AS dormitorios,
  CASE WHEN banos BETWEEN 1 AND 12 THEN banos END AS banos, CASE WHEN ano_construccion BETWEEN 1900 AND 2030 THEN ano_construccion END AS ano_construccion,
  CASE WHEN gastos_comunes_clp BETWEEN 0 AND 3000000 AND NOT (tipo = 'departamento' AND gastos_comunes_clp = 0) THEN gastos_comunes_clp END AS gastos_comunes_clp,
  CASE WHEN NOT coalesce(m2_util > m2_total, false) THEN m2_total END AS m2_total,
  CASE WHEN lat BETWEEN -33.62::DOUBLE AND -33.40::DOUBLE AND lon BETWEEN -70.72::DOUBLE AND -70.48::DOUBLE THEN lat END AS lat, CASE WHEN lat BETWEEN -33.62::DOUBLE AND -33.40::DOUBLE AND lon BETWEEN -70.72::DOUBLE AND -70.48::DOUBLE THEN lon END AS lon) FROM swapped),
targets AS (SELECT *, CASE WHEN operacion = 'venta' THEN precio_uf ELSE precio_clp END AS y FROM clean
  WHERE (operacion = 'venta' AND precio_uf BETWEEN 500 AND 60000 AND m2_util BETWEEN 20 AND 800) OR (operacion = 'arriendo' AND precio_clp BETWEEN 150000 AND 4000000 AND m2_util BETWEEN 15 AND 600)),
predictions AS (SELECT * FROM targets JOIN (SELECT comuna, tipo, operacion, median(y) AS pred, quantile_cont(y, 0.25) AS lo, quantile_cont(y, 0.75) AS hi FROM targets GROUP BY ALL) USING (comuna, tipo, operacion)),
places AS (SELECT s_suppkey AS poi_id, ['metro', 'comercio', 'salud', 'universidad'][(s_suppkey % 4 + 1)::INT] AS categoria, s_name AS nombre, -33.60::DOUBLE + (s_suppkey * 733 % 2000) / 10000::DOUBLE + 0.00003::DOUBLE AS lat,
  -70.70::DOUBLE + (s_suppkey * 1511 % 2000) / 10000::DOUBLE + 0.00003::DOUBLE AS lon, greatest(floor(s_acctbal / 10), 0)::INT AS resenas FROM supplier),
celled AS (SELECT *, printf('%.3f', lat) || ',' || printf('%.3f', lon) AS cell FROM clean WHERE lat IS NOT NULL AND lon IS NOT NULL),
points AS (SELECT cell AS point, avg(lat) AS lat, avg(lon) AS lon FROM celled GROUP BY cell),
calls AS (SELECT event_id AS call_id, ts AS cuando, CASE WHEN event_type = 'error' THEN 'rechazo' ELSE 'ok' END AS estado FROM events),
pairs AS (SELECT p.point, q.categoria, q.nombre, 2 * 6371000::DOUBLE * asin(sqrt(least(1::DOUBLE, power(sin((radians(q.lat) - radians(p.lat)) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * power(sin((radians(q.lon) - radians(p.lon)) / 2), 2)))) AS d FROM points p, places q),
near AS (SELECT point, categoria, round_even(min(d), 0)::INT AS mas_cercano_m, arg_min(nombre, (d, nombre)) AS nombre, count(*) FILTER (d <= 1000) AS n_1km FROM pairs GROUP BY point, categoria)
"""
