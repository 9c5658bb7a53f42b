"""Registered queries of the appraisal operators, each beside the SQL it is held against; README says which of the others tests hold to bands."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import numbers, text
from hearth.operators import asof, clean, extract, features, geo, ingest, model, package, ratio, report, score, segment
from hearth.plans import listings as L
from hearth.schema import NUMERIC
from hearth.functions.order import grouped_medians
from hearth.sources.scratch import place, stored, tidy
from hearth.streaming import merge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with SQL over the tables of listings.SQL."""

    def add(f):
        QUERIES[f.__name__] = tidy(f)
        if sql is not None:
            ORACLES[f.__name__] = f"{L.SQL}{sql}"
        return QUERIES[f.__name__]

    return add


# reports


@query("""SELECT d.comuna, d.tipo, round(median(precio_uf) FILTER (operacion = 'venta'), 4) AS sale_uf, round(median(precio_uf / m2_util) FILTER (operacion = 'venta' AND m2_util > 10), 4) AS sale_uf_m2,
  round(median(precio_clp) FILTER (operacion = 'arriendo'), 4) AS rent_clp, count(c.comuna) AS n FROM (SELECT unnest(['la-florida', 'macul', 'nunoa', 'san-miguel']) AS comuna) a, (SELECT unnest(['casa', 'departamento']) AS tipo) b, LATERAL (SELECT a.comuna, b.tipo) d(comuna, tipo) LEFT JOIN clean c ON c.comuna = d.comuna AND c.tipo = d.tipo GROUP BY d.comuna, d.tipo""")
def market_medians(s, d):
    return report.market_medians(L.clean(s, d))


@query("SELECT count(*) AS total, sum(detalle_ok)::BIGINT AS with_detail, round(100.0::DOUBLE * sum(detalle_ok) / count(*), 4) AS pct FROM typed")
def volume(s, d):
    return report.volume(L.typed(s, d))


@query("SELECT comuna, count(*) AS n FROM typed GROUP BY comuna")
def count_by_comuna(s, d):
    return report.counts(L.typed(s, d), "comuna")


@query("SELECT comuna, operacion, tipo, count(*) AS n FROM typed GROUP BY ALL")
def count_by_dims(s, d):
    return report.counts(L.typed(s, d), "comuna", "operacion", "tipo")


@query("SELECT comuna, operacion, tipo, count(*) AS n, grouping(comuna, operacion, tipo)::BIGINT AS level FROM typed GROUP BY ROLLUP (comuna, operacion, tipo)")
def rollup_by_dims(s, d):
    return report.subtotals(L.typed(s, d))


@query("""SELECT year(fecha_publicacion)::INT AS year, count(*) FILTER (comuna = 'la-florida') AS la_florida, count(*) FILTER (comuna = 'macul') AS macul, count(*) FILTER (comuna = 'nunoa') AS nunoa,
  count(*) FILTER (comuna = 'san-miguel') AS san_miguel, count(*) AS total FROM typed GROUP BY 1""")
def year_comuna_pivot(s, d):
    return report.year_by_commune(L.typed(s, d))


@query("UNPIVOT (SELECT " + ", ".join(f"round(100.0::DOUBLE * count({c}) / count(*), 4) AS {c}" for c in NUMERIC) + " FROM typed) ON COLUMNS(*) INTO NAME \"column\" VALUE pct")
def completeness(s, d):
    return clean.coverage(L.typed(s, d), NUMERIC)


@query("""SELECT comuna, id_aviso, is_full FROM (SELECT *, row_number() OVER (PARTITION BY comuna ORDER BY is_full DESC, id_aviso DESC) AS r FROM (SELECT *, m2_total IS NOT NULL AND lat IS NOT NULL AND dormitorios IS NOT NULL AND banos IS NOT NULL AS is_full FROM clean)) WHERE r = 1""")
def latest_example(s, d):
    return report.latest_example(L.clean(s, d), ["m2_total", "lat", "dormitorios", "banos"]).select("comuna", "id_aviso", "is_full")


@query("SELECT sitio, comuna, operacion, tipo, count(*) AS n, sum(detalle_ok)::BIGINT AS with_detail FROM typed GROUP BY ALL")
def ingest_summary(s, d):
    return report.ingest_summary(L.typed(s, d))


# cleaning


@query("SELECT * FROM clean")
def clean_listings(s, d):
    return L.clean(s, d).drop(*L.UNUSED).withColumn("fecha_publicacion", F.col("fecha_publicacion").cast("date"))


@query("""SELECT rule, kind, n_rows, round(100.0::DOUBLE * n_rows / (SELECT count(*) FROM typed), 4) AS pct FROM (
  SELECT unnest([('swap', 'repaired', count(*) FILTER (sw)), ('uf_from_clp', 'repaired', count(*) FILTER (t.precio_uf IS NULL AND t.precio_clp IS NOT NULL)), ('clp_from_uf', 'repaired', count(*) FILTER (t.precio_clp IS NULL AND t.precio_uf IS NOT NULL)),
  ('bad_geo', 'nulled', count(*) FILTER (t.lat IS NOT NULL AND NOT (t.lat BETWEEN -33.62::DOUBLE AND -33.40::DOUBLE AND t.lon BETWEEN -70.72::DOUBLE AND -70.48::DOUBLE))), ('total_below_util', 'nulled', count(*) FILTER (t.m2_util > t.m2_total)),
  ('zero_costs', 'nulled', count(*) FILTER (t.tipo = 'departamento' AND t.gastos_comunes_clp = 0)), ('estacionamientos_out_of_range', 'nulled', count(*) FILTER (t.estacionamientos NOT BETWEEN 0 AND 10)), ('bodegas_out_of_range', 'nulled', count(*) FILTER (t.bodegas NOT BETWEEN 0 AND 10)),
  ('dormitorios_out_of_range', 'nulled', count(*) FILTER (t.dormitorios NOT BETWEEN 0 AND 10)), ('banos_out_of_range', 'nulled', count(*) FILTER (t.banos NOT BETWEEN 1 AND 12)), ('ano_construccion_out_of_range', 'nulled', count(*) FILTER (t.ano_construccion NOT BETWEEN 1900 AND 2030)),
  ('gastos_comunes_clp_out_of_range', 'nulled', count(*) FILTER (t.gastos_comunes_clp NOT BETWEEN 0 AND 3000000))]) AS r FROM (SELECT * EXCLUDE (precio_uf, precio_clp), CASE WHEN id_aviso::BIGINT % 7 <> 0 THEN precio_uf END AS precio_uf, CASE WHEN NOT (id_aviso::BIGINT % 11 = 0 AND id_aviso::BIGINT % 7 <> 0) THEN precio_clp END AS precio_clp FROM swapped) t), LATERAL (SELECT r[1] AS rule, r[2] AS kind, r[3] AS n_rows)""")
def repair_log(s, d):
    return clean.repair_log(L.typed(s, d))


@query("SELECT rate FROM rate")
def rate_inference(s, d):
    return clean.infer_rate(L.typed(s, d))


@query("SELECT operacion, count(*) AS n, round(median(y), 4) AS median_y FROM targets GROUP BY operacion")
def target_filter(s, d):
    made = grouped_medians(L.slim(s, d).select("operacion", "y"), ["operacion"], {"median_y": F.col("y")}, (F.count("*").alias("n"),))
    return made.withColumn("median_y", F.round("median_y", 4))


@query("SELECT sitio, \"column\", pct FROM (UNPIVOT (SELECT sitio, " + ", ".join(f"round(100.0::DOUBLE * count({c}) / count(*), 4) AS {c}" for c in NUMERIC) + " FROM typed GROUP BY sitio) ON * EXCLUDE (sitio) INTO NAME \"column\" VALUE pct)")
def coverage_by_source(s, d):
    return clean.coverage(L.typed(s, d), NUMERIC, ["sitio"])


@query("SELECT operacion, tipo, count(*) AS n, grouping(operacion, tipo)::BIGINT AS level FROM typed GROUP BY CUBE (operacion, tipo)")
def operacion_tipo_cube(s, d):
    return segment.crosstab(L.typed(s, d), "operacion", "tipo")


@query("SELECT comuna, count(*) AS n FROM (SELECT comuna, y / m2_util AS v, quantile_cont(y / m2_util, 0.01) OVER (PARTITION BY comuna) AS lo, quantile_cont(y / m2_util, 0.99) OVER (PARTITION BY comuna) AS hi FROM targets WHERE operacion = 'venta') WHERE v BETWEEN lo AND hi GROUP BY comuna")
def percentile_trim(s, d):
    sale = L.slim(s, d).where("operacion = 'venta'")
    return clean.percentile_trim(sale, F.col("y") / F.col("m2_util"), ["comuna"]).groupBy("comuna").agg(F.count("*").alias("n"))


# audit


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(s, d):
    return report.duplicate_keys(L.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS rows_a, count(*) FILTER (id_aviso::BIGINT % 9 <> 0) AS rows_b, count(*) FILTER (id_aviso::BIGINT % 9 = 0) AS only_a, 0::BIGINT AS only_b FROM typed")
def mirror_parity(s, d):
    a = L.typed(s, d)
    return report.mirror_parity(a, a.where("cast(id_aviso as long) % 9 <> 0"), ["sitio", "id_aviso"])


@query("SELECT round(quantile_cont(r, 0.25), 6) AS p25, round(quantile_cont(r, 0.5), 6) AS p50, round(quantile_cont(r, 0.75), 6) AS p75, quantile_cont(r, 0.75) - quantile_cont(r, 0.25) < quantile_cont(r, 0.5) / 100 AS stable FROM (SELECT precio_clp / precio_uf AS r FROM typed WHERE precio_uf > 0)")
def rate_stability(s, d):
    return report.rate_stability(L.typed(s, d))


@query("SELECT count(DISTINCT fecha_scrape) AS n_dates, count(DISTINCT fecha_scrape) <= 5 AS short FROM typed")
def snapshot_dates(s, d):
    return report.snapshot_dates(L.typed(s, d))


@query("SELECT 0::BIGINT AS n_nulls FROM (SELECT count(*) FROM typed)")
def null_cells(s, d):
    return report.nulls(L.raw_listings(s, d))


_RULES = {
    "keys are known": ("count(*) FILTER (sitio IS NULL OR id_aviso IS NULL) = 0", "critical"), "areas are positive": ("min(m2_util) > 0", "critical"), "markets are known": ("count(*) FILTER (operacion NOT IN ('venta', 'arriendo')) = 0", "critical"),
    "rooms are whole": ("count(*) FILTER (dormitorios <> floor(dormitorios)) = 0", "critical"), "ages are plausible": ("count(*) FILTER (antiguedad_anos > 200) = 0", "critical"), "every listing has a point": ("count(lat) = count(*)", "notice"),
    "prices are known both ways": ("count(*) FILTER (precio_uf IS NULL OR precio_clp IS NULL) = 0", "notice"), "the rate is that of the day": ("count(*) FILTER (abs(precio_clp / precio_uf - 40000) > 1) = 0", "notice"), "details are there": ("sum(detalle_ok) = count(*)", "notice"),
    "totals hold the useful area": ("count(*) FILTER (m2_total < m2_util) = 0", "notice"),
}


def _observed(s, d):
    spark_sql = lambda text: F.expr(re.sub(r"count\(\*\) FILTER \((.*)\) = 0", r"count_if(\1) = 0", text))
    return report.audited(L.typed(s, d), [(n, spark_sql(text), severity) for n, (text, severity) in _RULES.items()])


@query("SELECT UNNEST([" + ", ".join(f"{{'check': '{n}', 'severity': '{v}', 'ok': {t}}}" for n, (t, v) in _RULES.items()) + "], recursive := true) FROM typed")
def audit_checks(s, d):
    """All single-pass rules over the typed listings, observed while they are written."""
    return _observed(s, d)[1].select("check", "severity", "ok")


@query("SELECT severity, ok, count(*) AS n FROM (SELECT UNNEST([" + ", ".join(f"{{'severity': '{v}', 'ok': {t}}}" for n, (t, v) in _RULES.items()) + "], recursive := true) FROM typed) GROUP BY ALL")
def audit_summary(s, d):
    return report.severity_summary(_observed(s, d)[1])


# merging

_BATCH = "batch AS (SELECT sitio, id_aviso, CASE WHEN id_aviso::BIGINT % 6 <> 0 THEN m2_util END AS m2_util, precio_uf + 1 AS precio_uf FROM typed WHERE id_aviso::BIGINT % 3 = 0)"


def _batch(s, d):
    k = F.col("id_aviso").cast("long")
    return L.typed(s, d).where(k % 3 == 0).select("sitio", "id_aviso", F.when(k % 6 != 0, F.col("m2_util")).alias("m2_util"), (F.col("precio_uf") + 1).alias("precio_uf"))


@query(f", {_BATCH} SELECT t.sitio, t.id_aviso, coalesce(b.m2_util, t.m2_util) AS m2_util, coalesce(b.precio_uf, t.precio_uf) AS precio_uf, t.comuna FROM typed t LEFT JOIN batch b USING (sitio, id_aviso)")
def merge_keep(s, d):
    base = L.typed(s, d).select("sitio", "id_aviso", "m2_util", "precio_uf", "comuna")
    return ingest.merge_partial(base, _batch(s, d), ["m2_util", "precio_uf"])


@query(f", {_BATCH} SELECT t.sitio, t.id_aviso, CASE WHEN b.id_aviso IS NOT NULL THEN b.m2_util ELSE t.m2_util END AS m2_util, CASE WHEN b.id_aviso IS NOT NULL THEN b.precio_uf ELSE t.precio_uf END AS precio_uf, t.comuna FROM typed t LEFT JOIN batch b USING (sitio, id_aviso)")
def merge_overwrite(s, d):
    base = L.typed(s, d).select("sitio", "id_aviso", "m2_util", "precio_uf", "comuna")
    return ingest.merge_partial(base, _batch(s, d), ["m2_util", "precio_uf"], null_policy="overwrite")


@query("SELECT l_orderkey, l_linenumber, max(l_shipdate)::DATE AS l_shipdate FROM lineitem GROUP BY ALL")
def upsert_latest(s, d):
    rows = L.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    return ingest.upsert_latest(rows.where("l_linenumber % 2 = 0"), rows.where("l_linenumber % 2 = 1"), ["l_shipdate"], ["l_orderkey", "l_linenumber"])


@query("SELECT sitio, id_aviso FROM typed WHERE detalle_ok = 0")
def pending_work(s, d):
    rows = L.typed(s, d)
    return ingest.pending(rows.select("sitio", "id_aviso"), rows.where("detalle_ok = 1"))


@query("SELECT direccion AS address, m2_util, comuna_price AS price, count(DISTINCT id_aviso) AS n_ids, min(id_aviso) AS first_id FROM (SELECT *, floor(precio_uf / 100) AS comuna_price FROM clean WHERE precio_uf IS NOT NULL) GROUP BY ALL HAVING count(DISTINCT id_aviso) > 1")
def cross_listed(s, d):
    return ingest.cross_listed(L.clean(s, d).withColumn("rounded", F.floor(F.col("precio_uf") / 100).cast("double")), "rounded")


@query("SELECT sitio, id_aviso, CASE WHEN id_aviso::BIGINT % 3 = 0 AND id_aviso::BIGINT % 6 <> 0 THEN m2_util + 1 WHEN id_aviso::BIGINT % 2 = 0 THEN m2_util END AS m2_util, CASE WHEN id_aviso::BIGINT % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS at FROM typed WHERE id_aviso::BIGINT % 2 = 0 OR id_aviso::BIGINT % 3 = 0")
def stream_merge(s, d):
    """Two waves of files, merged by a stream that starts again for the second."""
    k, folder = F.col("id_aviso").cast("long"), place(s)
    rows = L.typed(s, d).select("sitio", "id_aviso", "m2_util")
    first = rows.where(k % 2 == 0).withColumn("at", F.lit(1).cast("long"))
    second = rows.where(k % 3 == 0).select("sitio", "id_aviso", F.when(k % 6 != 0, F.col("m2_util") + 1).alias("m2_util"), F.lit(2).cast("long").alias("at"))
    for wave in (first, second):
        wave.write.mode("append").parquet(f"{folder}/in")
        merge.stream_merge(s, f"{folder}/in", first.schema, f"{folder}/table", f"{folder}/checkpoint", ["m2_util", "at"], "at", buckets=8).awaitTermination()
    return merge.current(s, f"{folder}/table", first.schema)


# numbers


@query("SELECT p_partkey, p_size::DOUBLE AS n, (p_partkey::BIGINT * 1000 + p_size)::DOUBLE AS grouped, (p_size % 2 = 0) AS is_range FROM part")
def numero(s, d):
    k, size = F.col("p_partkey"), F.col("p_size")
    rows = L.table(s, d, "part").select(k, F.concat(F.lit("aprox. "), size.cast("string"), F.lit(" m²")).alias("t"), F.concat(k.cast("string"), F.lit("."), F.lpad(size.cast("string"), 3, "0")).alias("g"), F.concat(size.cast("string"), F.when(size % 2 == 0, F.lit(" a 99 m²")).otherwise(F.lit(" m²"))).alias("r"))
    return rows.select("p_partkey", numbers.numero(F.col("t")).alias("n"), numbers.parse_number_strict(F.col("g")).alias("grouped"), numbers.es_rango(F.col("r")).alias("is_range"))


@query("SELECT id_aviso, round_even(CASE WHEN operacion = 'venta' THEN precio_uf * 39999 ELSE precio_clp END, 0) AS clp, round_even(CASE WHEN operacion = 'venta' THEN precio_uf ELSE precio_clp / 39999 END, 2) AS uf FROM clean")
def price_both_ways(s, d):
    unit = F.when(F.col("operacion") == "venta", "UF").otherwise("CLP")
    clp, uf = numbers.prices(F.when(unit == "UF", F.col("precio_uf")).otherwise(F.col("precio_clp")), unit, F.lit(39999.0))
    return L.clean(s, d).select("id_aviso", clp.alias("clp"), uf.alias("uf"))


@query(""", rates AS (SELECT cuando::DATE AS day, max(call_id)::DOUBLE AS rate FROM calls WHERE estado <> 'ok' GROUP BY 1)
SELECT day, n, rate, CASE WHEN rate IS NULL THEN 'none' WHEN rate_day = day THEN 'same_day' ELSE 'fallback' END AS rate_origin FROM (SELECT c.day, n, r.rate, r.day AS rate_day FROM (SELECT cuando::DATE AS day, count(*) AS n FROM calls GROUP BY 1) c ASOF LEFT JOIN rates r ON c.day >= r.day)""")
def rate_asof(s, d):
    calls = L.calls(s, d).withColumn("day", F.to_date("cuando"))
    rates = calls.where("estado <> 'ok'").groupBy("day").agg(F.max("call_id").cast("double").alias("rate"))
    return extract.with_rate(calls.groupBy("day").agg(F.count("*").alias("n")).withColumnRenamed("day", "on"), rates, "on").withColumnRenamed("on", "day")


@query(""", f AS (SELECT user_id, ts, max(event_id) AS failed_id FROM events WHERE event_type = 'error' GROUP BY ALL) SELECT e.event_id, f.ts AS failed_at, f.failed_id FROM events e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.ts""")
def last_failure(s, d):
    """D7 in general: each event with its user's last failure at or before it, by time stamps."""
    events = L.table(s, d, "events").select("event_id", "user_id", "ts")
    failed = L.table(s, d, "events").where("event_type = 'error'").select("user_id", F.col("ts").alias("failed_at"), F.col("event_id").alias("failed_id"))
    return asof.asof_join(events, failed, "ts", "failed_at", ["failed_id"], ["user_id"]).select("event_id", "failed_at", "failed_id")


@query("SELECT n_name, replace(replace(lower(n_name), ' ', '-'), '_', '-') AS slug, lower(n_name) AS address FROM nation")
def slug(s, d):
    return L.table(s, d, "nation").select("n_name", text.slug(F.col("n_name")).alias("slug"), text.norm_address(F.concat(F.lit("  "), "n_name", F.lit(" "))).alias("address"))


# places


@query("SELECT point, categoria, mas_cercano_m, nombre, n_1km FROM near")
def nearest_poi(s, d):
    return geo.nearest(L.points(s, d), L.places(s, d))


@query("SELECT point, categoria, count(*) AS n FROM pairs WHERE d <= 1000 GROUP BY ALL")
def radius_counts(s, d):
    return geo.radius_join(L.points(s, d), L.places(s, d)).groupBy("point", "categoria").agg(F.count("*").alias("n"))


@query("SELECT cell, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, count(*) AS n FROM celled GROUP BY cell")
def cells(s, d):
    return geo.cells(L.clean(s, d)).select("cell", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "n")


@query("SELECT categoria, count(*) AS n, quantile_cont(mas_cercano_m, 0.25) AS p25, quantile_cont(mas_cercano_m, 0.5) AS p50, quantile_cont(mas_cercano_m, 0.75) AS p75, max(mas_cercano_m) AS max_m FROM near GROUP BY categoria")
def poi_distance_quartiles(s, d):
    return geo.distance_quartiles(geo.nearest(L.points(s, d), L.places(s, d)))


_CATALOGUE = "kept AS (SELECT categoria, nombre, lat, lon, resenas FROM places WHERE resenas >= CASE categoria WHEN 'salud' THEN 150 WHEN 'comercio' THEN 200 WHEN 'universidad' THEN 150 ELSE 0 END QUALIFY row_number() OVER (PARTITION BY categoria, round_even(lat, 5), round_even(lon, 5) ORDER BY resenas DESC, poi_id) = 1)"


@query(f", {_CATALOGUE} SELECT categoria, nombre, resenas, (row_number() OVER (PARTITION BY categoria ORDER BY resenas DESC, nombre, lat, lon))::INT AS rank FROM kept QUALIFY rank <= 3")
def top_reviewed(s, d):
    return geo.top_reviewed(geo.build_catalogue(L.places(s, d))).select("categoria", "nombre", "resenas", "rank")


@query("SELECT count(DISTINCT (lat, lon)) AS exact, count(DISTINCT printf('%.4f,%.4f', lat, lon)) AS dec4, count(DISTINCT cell) AS dec3 FROM celled")
def grid_saving(s, d):
    return geo.grid_saving(L.clean(s, d))


@query("SELECT cuando::DATE AS day, count(*) FILTER (estado = 'ok') AS ok, count(*) FILTER (estado <> 'ok') AS rejected, count(*) AS total FROM calls GROUP BY 1")
def usage_by_day(s, d):
    return geo.usage_by_day(L.calls(s, d))


@query("SELECT strftime(cuando, '%Y-%m') AS month, count(*) AS calls, greatest(5000 - count(*), 0)::BIGINT AS remaining, round(greatest(count(*) - 5000, 0)::DOUBLE * 32 / 1000, 2) AS cost_usd FROM calls GROUP BY 1")
def usage_by_month(s, d):
    return geo.usage_by_month(L.calls(s, d))


@query("SELECT call_id, cuando::DATE AS day, same_day, ever FROM (SELECT *, count(*) OVER (PARTITION BY cuando::DATE ORDER BY cuando RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS same_day, count(*) OVER (ORDER BY cuando RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS ever FROM calls) WHERE estado <> 'ok'")
def usage_report(s, d):
    return geo.before_rejection(L.calls(s, d))


@query("SELECT c.cell, count(*) AS n, any_value(n.mas_cercano_m) AS metro_m FROM celled c JOIN near n ON n.point = c.cell AND n.categoria = 'metro' WHERE n.mas_cercano_m <= 15000 GROUP BY c.cell")
def services_of_listings(s, d):
    near = geo.nearest(L.points(s, d), L.places(s, d))
    answered = near.select("point", F.lit(False).alias("truncated")).distinct()
    full = geo.hand_out(L.clean(s, d), geo.summarise(near, near.limit(0), answered))
    return full.where("servicios IS NOT NULL").groupBy("cell").agg(F.count("*").alias("n"), F.first(F.col("servicios")["metro"]["mas_cercano_m"]).alias("metro_m"))


# features and splits


def _featured(s, d):
    return features.build_features(L.targets(s, d).withColumn("servicios_cercanos", F.lit("SIN_DATO")))


@query("""SELECT id_aviso, 2026::DOUBLE - ano_construccion AS antiguedad, round(ln(m2_util), 6) AS log_m2_util, round(CASE WHEN m2_total > 0 THEN (m2_total - m2_util) / m2_total END, 6) AS ratio_terraza, round(m2_util / greatest(coalesce(dormitorios, 1), 1), 6) AS m2_por_dormitorio,
  round(banos / greatest(coalesce(dormitorios, 1), 1), 6) AS densidad_banos, (tipo = 'casa')::INT::DOUBLE AS es_casa, (coalesce(estacionamientos, 0) > 0)::INT::DOUBLE AS tiene_estacionamiento, (coalesce(bodegas, 0) > 0)::INT::DOUBLE AS tiene_bodega, (lat IS NULL OR lon IS NULL)::INT::DOUBLE AS sin_geo FROM targets""")
def features_of_listings(s, d):
    r = lambda c: F.round(c, 6).alias(c)
    return _featured(s, d).select("id_aviso", "antiguedad", r("log_m2_util"), r("ratio_terraza"), r("m2_por_dormitorio"), r("densidad_banos"), "es_casa", "tiene_estacionamiento", "tiene_bodega", "sin_geo")


@query("SELECT 'location' AS block, round(100 * (avg((lat IS NULL)::INT) + avg((lon IS NULL)::INT)) / 3, 6) AS pct_missing FROM targets UNION ALL SELECT 'neighbourhood', round(1500 / 16::DOUBLE, 6) FROM (SELECT count(*) FROM targets) UNION ALL SELECT 'structural', round(100 * (" + " + ".join(f"avg(({c} IS NULL)::INT)" for c in ("m2_util", "m2_total", "dormitorios", "banos", "estacionamientos", "bodegas", "ano_construccion", "gastos_comunes_clp", "m2_util", "CASE WHEN m2_total > 0 THEN m2_util END", "m2_util", "banos")) + ") / 15, 6) FROM targets")
def missing_by_block(s, d):
    return features.missing_by_block(_featured(s, d))


_BUILDING = "keyed AS (SELECT *, coalesce('g:' || printf('%.4f,%.4f', lat, lon), 'd:' || direccion) AS building FROM targets), sided AS (SELECT *, CASE WHEN ('0x' || substr(md5('42:' || building), 1, 8))::BIGINT / 4294967296::DOUBLE < 0.2 THEN 'test' ELSE 'train' END AS side FROM keyed)"


def _sided(s, d):
    return stored(features.split_by_group(features.building_key(L.slim(s, d)), "building"))


@query(f", {_BUILDING} SELECT side, sitio, count(*) AS n, round(median(y), 4) AS median, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY side), 4) AS share FROM sided GROUP BY side, sitio")
def building_split(s, d):
    return features.split_composition(_sided(s, d))


@query(f", {_BUILDING} SELECT count(*) AS groups, count(*) FILTER (k > 1) AS leaking FROM (SELECT building, count(DISTINCT side) AS k FROM sided GROUP BY building)")
def leak_count(s, d):
    return features.leak_count(_sided(s, d), "building")


@query("SELECT id_aviso FROM targets ORDER BY md5('42:' || id_aviso), id_aviso LIMIT 100")
def sample_rows(s, d):
    return features.sample_n(L.slim(s, d).select("id_aviso"), 100, "id_aviso")


# ratio studies

_STUDY = """count(*) AS n, round(median(ape), 6) AS mdape, round(100 * avg((ape <= 10 + 1e-9::DOUBLE)::INT), 6) AS ppe10, round(100 * avg((ape <= 20 + 1e-9::DOUBLE)::INT), 6) AS ppe20, round(100 * avg(abs(ratio - mid)) / any_value(mid), 6) AS cod,
  round(avg(ratio) / (sum(pred) / sum(y)), 6) AS prd, round(1 - sum((y - pred) * (y - pred)) / sum((y - mean_y) * (y - mean_y)), 6) AS r2, round(avg(abs(y - pred)), 6) AS mae"""
_ERRORS = ", errors AS (SELECT *, abs(pred - y) / y * 100 AS ape, pred / y AS ratio FROM predictions WHERE y > 0 AND operacion = 'venta')"


def _sales(s, d):
    return stored(L.predictions(s, d).where("operacion = 'venta'"))


@query(f"{_ERRORS} SELECT {_STUDY} FROM errors, (SELECT median(ratio) AS mid, avg(y) AS mean_y FROM errors)")
def ratio_study(s, d):
    return ratio.ratio_study(_sales(s, d))


@query(f"{_ERRORS} SELECT segment, value, count(*) AS n, round(median(ape), 6) AS mdape, round(100 * avg((ape <= 10 + 1e-9::DOUBLE)::INT), 6) AS ppe10, round(median(ratio), 6) AS ratio FROM (SELECT 'comuna' AS segment, comuna AS value, ape, ratio FROM errors UNION ALL SELECT 'tipo', tipo, ape, ratio FROM errors UNION ALL SELECT 'sitio', sitio, ape, ratio FROM errors) GROUP BY ALL")
def ratio_by_segment(s, d):
    return ratio.by_segment(_sales(s, d), ["comuna", "tipo", "sitio"])


_FIFTHS = ", fifths AS (SELECT e.*, (CASE " + " ".join(f"WHEN y <= q[{i}] THEN {i}" for i in range(1, 6)) + " END)::INT AS quantile FROM errors e, (SELECT quantile_cont(y, [0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM errors))"


@query(f"{_ERRORS}{_FIFTHS} SELECT quantile, {_STUDY} FROM fifths JOIN (SELECT quantile, median(ratio) AS mid, avg(y) AS mean_y FROM fifths GROUP BY quantile) USING (quantile) GROUP BY quantile")
def ratio_by_quintile(s, d):
    return ratio.by_quantile(_sales(s, d))


@query(f"{_ERRORS}{_FIFTHS}, study AS (SELECT {_STUDY} FROM errors, (SELECT median(ratio) AS mid, avg(y) AS mean_y FROM errors)) SELECT mdape, cod, prd, (SELECT round(median(ratio), 6) FROM fifths WHERE quantile = 1) AS ratio_cheapest, (SELECT round(median(ratio), 6) FROM fifths WHERE quantile = 5) AS ratio_dearest FROM study")
def vertical_profile(s, d):
    return ratio.vertical_profile(_sales(s, d))


@query(f"{_ERRORS} SELECT round(a, 6) AS mdape_all, round(g, 6) AS mdape_group, round(a - g, 6) AS gain FROM (SELECT median(abs(m - y) / y * 100) AS a, median(abs(gm - y) / y * 100) AS g FROM errors JOIN (SELECT comuna, median(y) AS gm FROM errors GROUP BY comuna) USING (comuna), (SELECT median(y) AS m FROM errors))")
def group_median_gain(s, d):
    return ratio.group_median_gain(_sales(s, d), "comuna")


@query(f"{_ERRORS} SELECT least(floor((ape - 0) / (120::DOUBLE / 60)), 59)::INT AS bin, count(*) AS n FROM errors WHERE ape BETWEEN 0 AND 120 GROUP BY 1")
def error_histogram(s, d):
    return ratio.histogram(ratio.errors(_sales(s, d)), "ape", 0, 120)


@query(f"{_ERRORS} SELECT segment, n, round(CASE WHEN n >= 30 THEN m ELSE a END, 6) AS mdape FROM (SELECT 'casa' AS segment, count(*) FILTER (tipo = 'casa') AS n, median(ape) FILTER (tipo = 'casa') AS m, median(ape) AS a FROM errors UNION ALL SELECT 'none', 0, NULL, median(ape) FROM errors)")
def segment_error(s, d):
    return ratio.segment_error(_sales(s, d), {"casa": F.col("tipo") == "casa", "none": F.lit(False)})


@query(f", {_BUILDING}, floored AS (SELECT *, abs(pred - y) / y * 100 AS ape, pred / y AS ratio FROM (SELECT y, (SELECT median(y) FROM sided WHERE side = 'train' AND operacion = 'venta') AS pred FROM sided WHERE side = 'test' AND operacion = 'venta')) SELECT {_STUDY} FROM floored, (SELECT median(ratio) AS mid, avg(y) AS mean_y FROM floored)")
def median_floor(s, d):
    rows = _sided(s, d).where("operacion = 'venta'")
    return ratio.median_floor(rows.where("side = 'train'"), rows.where("side = 'test'"))


_MODELS = ", models AS (SELECT 'group' AS model, y, pred FROM predictions WHERE operacion = 'venta' UNION ALL SELECT 'all', y, (SELECT median(y) FROM targets WHERE operacion = 'venta') FROM predictions WHERE operacion = 'venta'), errors AS (SELECT *, abs(pred - y) / y * 100 AS ape, pred / y AS ratio FROM models)"


def _models(s, d):
    rows = _sales(s, d).select("y", "pred").withColumn("model", F.lit("group"))
    floor = rows.crossJoin(F.broadcast(grouped_medians(rows, [], {"m": F.col("y")}))).select("y", F.col("m").alias("pred"), F.lit("all").alias("model"))
    return ratio.ratio_study(rows.unionByName(floor), by=("model",))


@query(f"{_MODELS} SELECT model, {_STUDY} FROM errors JOIN (SELECT model, median(ratio) AS mid, avg(y) AS mean_y FROM errors GROUP BY model) USING (model) GROUP BY model")
def compare_models(s, d):
    return _models(s, d)


@query(f"{_MODELS}, study AS (SELECT model, {_STUDY} FROM errors JOIN (SELECT model, median(ratio) AS mid, avg(y) AS mean_y FROM errors GROUP BY model) USING (model) GROUP BY model) SELECT model, mdape, prd FROM study WHERE mdape <= (SELECT min(mdape) FROM study) + 0.25 ORDER BY abs(prd - 1), model LIMIT 1")
def pick_winner(s, d):
    return ratio.pick_winner(_models(s, d), "prd").select("model", "mdape", "prd")


@query(f"{_ERRORS}, study AS (SELECT {_STUDY} FROM errors, (SELECT median(ratio) AS mid, avg(y) AS mean_y FROM errors)) SELECT 'mdape_good' AS rule, mdape < 15 AS ok, mdape AS value FROM study UNION ALL SELECT 'mdape_excellent', mdape < 10, mdape FROM study UNION ALL SELECT 'ppe10', ppe10 > 50, ppe10 FROM study UNION ALL SELECT 'cod', cod BETWEEN 5 AND 15, cod FROM study UNION ALL SELECT 'prd', prd BETWEEN 0.98 AND 1.03, prd FROM study")
def acceptance(s, d):
    return ratio.acceptance(ratio.ratio_study(_sales(s, d)))


@query(f"""{_ERRORS}, sides AS (SELECT *, CASE WHEN ('0x' || substr(md5('42:' || coalesce('g:' || printf('%.4f,%.4f', lat, lon), 'd:' || direccion)), 1, 8))::BIGINT / 4294967296::DOUBLE < 0.2 THEN 'grouped' END AS g, CASE WHEN ('0x' || substr(md5('43:' || id_aviso), 1, 8))::BIGINT / 4294967296::DOUBLE < 0.2 THEN 'random' END AS r FROM errors)
SELECT 'mdape' AS metric, round(median(ape) FILTER (g IS NOT NULL), 6) AS grouped, round(median(ape) FILTER (r IS NOT NULL), 6) AS random FROM sides UNION ALL SELECT 'n', count(g), count(r) FROM sides""")
def compare_splits(s, d):
    rows = features.building_key(_sales(s, d))
    one = lambda group, seed: ratio.ratio_study(features.split_by_group(rows, group, seed=seed).where("side = 'test'"))
    return ratio.compare_splits(one("building", 42), one("id_aviso", 43)).where("metric IN ('mdape', 'n')").select("metric", "grouped", "random")


@query(f", {_BUILDING} SELECT count(*) AS n_test FROM (SELECT building, row_number() OVER (ORDER BY md5('42:' || building), building) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT building FROM keyed)) WHERE r <= ceil(n * 0.2::DOUBLE)")
def exact_split(s, d):
    sided = features.split_by_group(features.building_key(L.slim(s, d)), "building", mode="exact")
    return sided.where("side = 'test'").agg(F.count_distinct("building").alias("n_test"))


@query("SELECT situation, id_aviso FROM (SELECT tipo || '/' || operacion AS situation, id_aviso, row_number() OVER (PARTITION BY tipo, operacion ORDER BY md5('42:' || id_aviso), id_aviso) AS r FROM targets) WHERE r = 1")
def one_per_situation(s, d):
    return features.one_per_situation(L.slim(s, d), F.concat_ws("/", "tipo", "operacion"), "id_aviso").select("situation", "id_aviso")


@query("SELECT 'm2_total' AS \"column\", count(*) FILTER (t.m2_total IS DISTINCT FROM c.m2_total) AS n_different FROM typed t JOIN clean c USING (sitio, id_aviso) UNION ALL SELECT 'banos', count(*) FILTER (t.banos IS DISTINCT FROM c.banos) FROM typed t JOIN clean c USING (sitio, id_aviso)")
def frame_parity(s, d):
    return report.frame_parity(L.typed(s, d), L.clean(s, d), ["sitio", "id_aviso"], ["m2_total", "banos"])


# diagnostics


@query("SELECT round(sb / (sb + sw), 6) AS eta2 FROM (SELECT sum(n * (m - g) * (m - g)) AS sb, sum(n * v) AS sw FROM (SELECT comuna, count(*) AS n, avg(ln(y)) AS m, var_pop(ln(y)) AS v FROM targets WHERE operacion = 'venta' GROUP BY comuna), (SELECT avg(ln(y)) AS g FROM targets WHERE operacion = 'venta'))")
def eta_squared(s, d):
    return segment.eta_squared(L.slim(s, d).where("operacion = 'venta'").withColumn("ly", F.ln("y")), "ly", "comuna")


@query("SELECT comuna, count(*) AS n, round(100 * avg((tipo = 'casa')::INT), 4) AS pct_houses, round(median(m2_util), 4) AS m2_util, round(median(dormitorios), 4) AS dormitorios, round(median(y), 4) AS price, round(median(y / m2_util), 4) AS price_m2, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS share FROM targets WHERE operacion = 'venta' GROUP BY comuna")
def cluster_profile(s, d):
    return segment.profile(L.slim(s, d).where("operacion = 'venta'"), "comuna", "y")


@query("SELECT comuna, tipo, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY comuna), 4) AS share, row_number() OVER (PARTITION BY comuna ORDER BY count(*) DESC, tipo) = 1 AS dominant FROM targets GROUP BY comuna, tipo")
def composition(s, d):
    return segment.composition(L.slim(s, d), "comuna", "tipo")


@query("SELECT comuna, n, p25, p50, p75, round(p50 / min(p50) OVER (), 6) AS times_least FROM (SELECT comuna, count(y) AS n, round(quantile_cont(y, 0.25), 4) AS p25, round(quantile_cont(y, 0.5), 4) AS p50, round(quantile_cont(y, 0.75), 4) AS p75 FROM targets WHERE operacion = 'venta' GROUP BY comuna)")
def price_by_group(s, d):
    return segment.describe_price(L.slim(s, d).where("operacion = 'venta'"), "comuna", "y")


def _matrix(s, d):
    """All components of every embedding, scaled; a written table, since iterative fits plan it anew for each job."""
    rows = L.table(s, d, "embeddings")
    cols = [f"x{i}" for i in range(rows.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    rows = rows.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(cols)])
    return stored(segment.scale_matrix(rows, cols, ["vec_id"])), cols


@query()
def kmeans_sweep(s, d):
    rows, cols = _matrix(s, d)
    return segment.kmeans_sweep(rows, cols, seeds=tuple(range(10)))


@query()
def silhouette(s, d):
    rows, cols = _matrix(s, d)
    rows, made = rows.persist(), None
    for k in range(2, 11):
        one = segment.silhouette(segment.clustered(rows, cols, segment.kmeans(rows, cols, k)), cols, "vec_id").withColumn("k", F.lit(k))
        made = one if made is None else made.union(one)
    return made


@query()
def centroid_outliers(s, d):
    rows, cols = _matrix(s, d)
    return segment.centroid_outliers(segment.clustered(rows, cols, segment.kmeans(rows, cols, 4))).select("vec_id", "cluster", "centre_distance")


@query()
def hopkins_control(s, d):
    rows, cols = _matrix(s, d)
    one = lambda df, name: segment.hopkins(df, cols, "vec_id").withColumn("data", F.lit(name))
    return one(rows, "real").union(one(segment.shuffled(rows, cols, "vec_id"), "control"))


@query()
def pca_variance(s, d):
    rows, cols = _matrix(s, d)
    return segment.pca_variance(rows, cols)


@query()
def pca_loadings(s, d):
    rows, cols = _matrix(s, d)
    return segment.pca_loadings(rows, cols)


@query()
def eta_by_chance(s, d):
    return segment.eta_by_chance(L.slim(s, d).where("operacion = 'venta'").withColumn("ly", F.ln("y")), "ly", "comuna", "id_aviso")


# intervals and scoring


@query("""SELECT n, sort[greatest(1, least(n, ceil((n + 1) * 0.8)))::INT] AS shift FROM (SELECT count(e) AS n, list_sort(list(e)) AS sort FROM (SELECT greatest(lo - y, y - hi) AS e FROM predictions WHERE operacion = 'venta'))""")
def conformal_shift(s, d):
    return score.conformal_shift(_sales(s, d))


@query("SELECT sitio, count(*) AS n, round(100 * avg((y BETWEEN lo AND hi)::INT), 6) AS coverage, round(median(100 * (hi - lo) / pred), 6) AS width FROM predictions WHERE operacion = 'venta' GROUP BY sitio")
def coverage_report(s, d):
    return score.coverage_report(_sales(s, d), ("sitio",))


_VERDICT = "judged AS (SELECT *, 100 * (asked - pred) / pred AS gap, 100 * (asked - pred) / pred / 25 AS z FROM (SELECT *, pred * (0.5::DOUBLE + (id_aviso::BIGINT % 101) / 100::DOUBLE) AS asked FROM predictions WHERE operacion = 'venta')), labelled AS (SELECT *, CASE WHEN z <= -2 THEN 'MUY BARATO' WHEN z <= -1 THEN 'BARATO' WHEN z < 1 THEN 'EN PRECIO' WHEN z < 2 THEN 'CARO' ELSE 'MUY CARO' END AS veredicto FROM judged)"


def _judged(s, d):
    asked = F.col("pred") * (F.lit(0.5) + F.col("id_aviso").cast("long") % 101 / F.lit(100.0))
    return score.verdict(_sales(s, d).withColumns({"asked": asked, "error_tipico": F.lit(25.0)}), "asked")


@query(f", {_VERDICT} SELECT id_aviso, veredicto, round(least(greatest(50 - 1.5::DOUBLE * gap, 0), 100), 6) AS puntaje, asked BETWEEN lo AND hi AS dentro_del_rango FROM labelled")
def verdict(s, d):
    return _judged(s, d).select("id_aviso", "veredicto", F.round("puntaje", 6).alias("puntaje"), "dentro_del_rango")


@query(f", {_VERDICT} SELECT place::INT AS place, label, count(veredicto) AS n, round(100.0::DOUBLE * count(veredicto) / (SELECT count(*) FROM labelled), 4) AS share FROM (VALUES (0, 'MUY BARATO'), (1, 'BARATO'), (2, 'EN PRECIO'), (3, 'CARO'), (4, 'MUY CARO')) l(place, label) LEFT JOIN labelled ON veredicto = label GROUP BY ALL")
def label_counts(s, d):
    return score.label_counts(_judged(s, d))


@query(f""", {_BUILDING}, train_cells AS (SELECT DISTINCT printf('%.3f,%.3f', lat, lon) AS cell FROM sided WHERE side = 'train' AND lat IS NOT NULL), reasons AS (SELECT id_aviso, tipo = 'casa' AS house, (tipo = 'casa')::INT + (CASE WHEN lat IS NULL THEN 1 WHEN printf('%.3f,%.3f', lat, lon) NOT IN (SELECT cell FROM train_cells) THEN 1 ELSE 0 END) AS n, lat IS NULL AS no_geo FROM sided WHERE side = 'test')
SELECT id_aviso, CASE WHEN house OR n >= 2 THEN 'baja' WHEN n = 1 THEN 'media' ELSE 'alta' END AS confianza, n::INT AS n_motivos, greatest(9::DOUBLE, CASE WHEN house THEN 12::DOUBLE END, CASE WHEN no_geo THEN 10::DOUBLE END) AS error_tipico FROM reasons""")
def confidence(s, d):
    rows = _sided(s, d)
    made = score.confidence(rows.where("side = 'test'"), score.known_cells(rows.where("side = 'train'")), 9.0, 12.0, 10.0)
    return made.select("id_aviso", "confianza", F.size("motivos").alias("n_motivos"), "error_tipico")


@query(", y AS (SELECT 100 * 12 * (precio_uf * (60 + id_aviso::BIGINT % 90)) / (precio_uf * 40000) AS v FROM clean WHERE operacion = 'venta') SELECT count(v) AS n, " + ", ".join(f"round(quantile_cont(v, {p / 100}), 6) AS p{p}" for p in (5, 25, 50, 75, 95)) + ", round(100 * avg((v > 12 OR v < 1)::INT), 6) AS pct_odd FROM y")
def gross_yield(s, d):
    rows = L.clean(s, d).where("operacion = 'venta'").withColumns({"rent": F.col("precio_uf") * (60 + F.col("id_aviso").cast("long") % 90), "uf": F.lit(40000.0)})
    return score.yield_summary(score.gross_yield(rows, "rent", "precio_uf", "uf"))


@query("SELECT id_aviso, ((lat IS NULL)::INT + (m2_total IS NULL)::INT + (banos IS NULL)::INT)::INT AS n_missing FROM clean")
def missing_inputs(s, d):
    return score.missing_inputs(L.clean(s, d), ["lat", "m2_total", "banos"]).select("id_aviso", F.size("faltantes").alias("n_missing"))


# models; rows of checks have SQL that says what must come out


def _split_features(s, d, market="venta"):
    rows = stored(features.split_by_group(features.building_key(_featured(s, d).where(F.col("operacion") == market)), "building"))
    return rows.where("side = 'train'"), rows.where("side = 'test'")


@query()
def model_comparison(s, d):
    train, test = _split_features(s, d)
    made = None
    for kind in ("ridge", "random_forest", "boosting", "stochastic_boosting"):
        study = ratio.ratio_study(stored(model.predict(model.fit(train, kind, small=True), test).select("y", "pred"))).withColumn("model", F.lit(kind))
        made = study if made is None else made.unionByName(study)
    return made.unionByName(ratio.median_floor(train, test.select("y")).withColumn("model", F.lit("floor")))


@query()
def permutation_importance(s, d):
    train, test = _split_features(s, d)
    return model.permutation_importance(model.fit(train, "random_forest", small=True), test, "id_aviso")


@query()
def importance_by_block(s, d):
    """Each block's share, and the share of the fifteen features that matter most."""
    train, test = _split_features(s, d)
    each = stored(model.permutation_importance(model.fit(train, "ridge", small=True), test, "id_aviso"))
    top = ratio.top_rows(each, "importance").agg(F.lit("top_15").alias("block"), F.sum(F.greatest("importance", F.lit(0.0))).alias("s"))
    all_ = each.agg(F.sum(F.greatest("importance", F.lit(0.0))).alias("all_"))
    return model.by_block(each).union(top.crossJoin(all_).select("block", 100 * F.col("s") / F.col("all_")))


def _package(s, d, market):
    """(package fitted and saved, where, test rows)."""
    train, test = _split_features(s, d, market)
    rate, path = float(clean.infer_rate(L.typed(s, d)).first()["rate"]), place(s)
    made = package.fit(train, market, rate, trees=10)
    package.save(made, path, ratio.ratio_study(stored(model.predict(made.point, test).select("y", "pred"))).unpivot([], ["mdape", "prd", "cod"], "metric", "value"))
    return made, path, test


@query()
def quantile_forest_interval(s, d):
    """L4: coverage and width of the range before and after it is calibrated."""
    made, path, test = _package(s, d, "venta")
    rows = stored(package.estimate(test, made).select("y", "pred", "raw_lo", "raw_hi", "lo", "hi"))
    one = lambda lo, hi, name: score.coverage_report(rows, lo=lo, hi=hi).withColumn("range", F.lit(name))
    return one("raw_lo", "raw_hi", "raw").unionByName(one("lo", "hi", "calibrated"))


@query()
def score_batch(s, d):
    """M1, M5, M8: packages of both markets, saved and loaded, estimate the test listings of sales: sale and rent, rent in UF, warnings, verdict on the asking price."""
    _, sale, test = _package(s, d, "venta")
    _, rent, _ = _package(s, d, "arriendo")
    made = package.estimate_both(test, package.load(s, sale), package.load(s, rent), "precio_uf")
    return made.select("id_aviso", "pred_venta", "lo_venta", "hi_venta", "confianza_venta", "pred_arriendo", "lo_arriendo", "hi_arriendo", "arriendo_uf", F.size("advertencias").alias("n_advertencias"), "brecha_pct", "veredicto", "dentro_del_rango")


@query(f", {_BUILDING} SELECT operacion, count(*) AS n, 0::BIGINT AS n_different FROM sided WHERE side = 'test' GROUP BY operacion")
def package_reload(s, d):
    """Packages loaded from their folders estimate all test rows as they did when they were fitted."""
    one = lambda market: (lambda made, path, test: package.reload_check(test, made, path).select(F.lit(market).alias("operacion"), "n", "n_different"))(*_package(s, d, market))
    return one("venta").union(one("arriendo"))


@query()
def acceptance_rules(s, d):
    """All eight rules and the good and excellent bands of one package."""
    made, path, test = _package(s, d, "venta")
    rows = stored(package.estimate(test, made).select("id_aviso", "y", "pred", "lo", "hi"))
    return package.acceptance(ratio.ratio_study(rows), score.coverage_report(rows), model.FEATURES, package.reload_check(test, made, path))


@query(f""", {_BUILDING}, t AS (SELECT count(*) AS n FROM sided WHERE side = 'test' AND operacion = 'venta') SELECT * FROM (SELECT n FROM t), (VALUES ('an extra column changes nothing', true), ('more area raises most prices', true), ('no range is upside down or below zero', true), ('every range holds its estimate', true), ('five fields give a finite estimate', true), ('an unknown commune gives a finite estimate', true), ('the spelling of a commune changes nothing', true)) c("check", ok)""")
def model_audit(s, d):
    """N8, N9, N10, N11, N15, N16 on a fitted model: the point and the range of every test row, with its inputs changed in turn."""
    made, path, test = _package(s, d, "venta")
    spoken = F.when(F.col("comuna") == "nunoa", " Ñuñoa").when(F.col("comuna") == "la-florida", "La Florida").when(F.col("comuna") == "san-miguel", "SAN_MIGUEL ").otherwise("Macul")
    few = {c: F.lit(None).cast("double") for c in model.FEATURES if c not in ("m2_util", "log_m2_util", "dormitorios", "banos", "es_casa", "m2_por_dormitorio", "densidad_banos")}
    larger = {"m2_util": F.col("m2_util") + 20, "log_m2_util": F.ln(F.col("m2_util") + 20), "m2_por_dormitorio": (F.col("m2_util") + 20) / F.greatest(F.coalesce("dormitorios", F.lit(1)), F.lit(1))}
    variants = {"base": test, "extra": test.withColumn("y", F.col("y") * 100), "larger": test.withColumns(larger), "few": test.withColumns(few), "unknown": test.withColumn("comuna", F.lit("no-such")), "spelled": test.withColumn("comuna", text.slug(spoken))}
    asked = None
    for name, rows in variants.items():
        one = model.predict(made.point, rows).select("id_aviso", F.lit(name).alias("variant"), "pred")
        asked = one if asked is None else asked.union(one)
    wide = asked.groupBy("id_aviso").pivot("variant", list(variants)).agg(F.first("pred"))
    ranged = package.estimate(test, made).select("id_aviso", "pred", "lo", "hi")
    plausible = lambda c: F.count_if(F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False)) & (F.col(c) > 0)) == F.count("*")
    seen = wide.join(ranged, "id_aviso").agg(
        F.count("*").alias("n"), (F.max(F.abs(F.col("extra") - F.col("base"))) == 0).alias("c0"), (F.avg((F.col("larger") > F.col("base")).cast("double")) > 0.85).alias("c1"), F.bool_and((F.col("lo") < F.col("hi")) & (F.col("lo") >= 0)).alias("c2"),
        F.bool_and(F.col("pred").between(F.col("lo"), F.col("hi"))).alias("c3"), plausible("few").alias("c4"), plausible("unknown").alias("c5"), (F.max(F.abs(F.col("spelled") - F.col("base"))) == 0).alias("c6"),
    )
    names = ["an extra column changes nothing", "more area raises most prices", "no range is upside down or below zero", "every range holds its estimate", "five fields give a finite estimate", "an unknown commune gives a finite estimate", "the spelling of a commune changes nothing"]
    return seen.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"c{i}").alias("ok")) for i, c in enumerate(names)])).alias("r")).select("n", "r.*")


# pages


@query(r"""SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS dominio, 'unknown_host' AS url_error FROM pages""")
def canonical_url(s, d):
    return extract.canonical_url(L.table(s, d, "pages").select("page_id", "url")).select("page_id", "dominio", "url_error")


@query(r"""SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, length(html)::INT AS n_chars FROM pages""")
def page_titles(s, d):
    return L.table(s, d, "pages").select("page_id", extract.extracted(F.col("html"), "<title>([^<]*)</title>").alias("title"), F.length("html").alias("n_chars"))


@query(r"""SELECT page_id, (i - 1)::INT AS position, h[i] AS href FROM (SELECT page_id, h, unnest(generate_series(1, len(h))) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages))""")
def page_links(s, d):
    return extract.links(L.table(s, d, "pages"))


@query(r"""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN page_id % 10 = 0 THEN 'bloqueado' WHEN page_id % 10 = 1 THEN 'no_existe' WHEN page_id % 10 = 2 THEN 'error_http' WHEN page_id % 10 = 3 THEN 'red' WHEN length(html) < 500 OR NOT (contains(html, 'application/ld+json') OR contains(html, '__NORDIC_RENDERING_CTX__') OR contains(html, '<th')) THEN 'challenge' ELSE 'ok' END AS outcome FROM pages) GROUP BY outcome""")
def fetch_outcomes(s, d):
    m = F.col("page_id") % 10
    rows = L.table(s, d, "pages").withColumn("status_code", F.when(m == 0, 403).when(m == 1, 404).when(m == 2, 500).when(m == 3, None).otherwise(200))
    return extract.fetch_outcome(rows, least=500).groupBy("outcome").agg(F.count("*").alias("n"))
