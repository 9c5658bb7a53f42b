"""Queries of sources, merges, services and the audit of scored frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.functions.order import grouped_medians
from hearth.functions.text import slug
from hearth.operators import clean, features, geo, ingest, ratio, report, score, segment
from hearth.plans import listings as L
from hearth.plans.queries import query
from hearth.sources import bucketed, tables
from hearth.sources.scratch import place, stored


def KEY() -> Column:
    return F.col("id_aviso").cast("long")


# sources


@query(""" SELECT column_name AS "column", CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(column_type) END AS type FROM (DESCRIBE orders)""")
def table_columns(s, d):
    """A4; local and zoned timestamps count as one type."""
    return tables.table_columns(L.table(s, d, "orders")).withColumn("type", F.replace("type", F.lit("_ntz"), F.lit("")))


@query(""" SELECT id_aviso, comuna, direccion, CASE WHEN m2_total IS NULL THEN 'SIN_DATO' ELSE m2_total::BIGINT::VARCHAR END AS m2_total, 'SIN_DATO' AS titulo FROM typed""")
def csv_round_trip(s, d):
    """Missing text as the sentinel, written as CSV and read back as text."""
    path = place(s)
    raw = L.raw_listings(s, d)
    blank = raw.withColumn("titulo", F.lit(None).cast("string"))
    tables.write_csv(tables.restore_sentinel(blank, ["titulo"]), path)
    return tables.read_csv_text(s, path, raw.schema).select("id_aviso", "comuna", "direccion", "m2_total", "titulo")


@query(""" SELECT id_aviso, m2_util, NULL::VARCHAR AS descripcion, NULL::DOUBLE AS uf_usada FROM typed""")
def migrated(s, d):
    """An older frame gets the columns and types that a newer schema declares."""
    wanted = StructType().add("id_aviso", "string").add("m2_util", "double").add("descripcion", "string").add("uf_usada", "double")
    path = place(s)
    tables.create_table(s, wanted, path)
    older = L.raw_listings(s, d).select("id_aviso", "m2_util")
    return s.read.parquet(path).unionByName(tables.migrate(older, wanted))


@query(""" SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS""")
def fresh_events(s, d):
    """Rows no older than a day before the last one."""
    rows = L.table(s, d, "events").select("event_id", "ts")
    last = rows.agg(F.max("ts").alias("last"))
    return tables.fresh(rows.crossJoin(F.broadcast(last)), "ts", F.col("last")).select("event_id")


# merging


@query(""" SELECT comuna, operacion, tipo, page::INT AS page, 'https://www.portalinmobiliario.com/' || operacion || '/' || tipo || '/' || comuna || '-metropolitana/' || CASE WHEN page > 0 THEN '_Desde_' || (page * 48 + 1) ELSE '' END AS url
  FROM (SELECT DISTINCT comuna FROM typed), (SELECT DISTINCT operacion FROM typed), (SELECT DISTINCT tipo FROM typed), (SELECT unnest(range(3)) AS page)""")
def crawl_frontier(s, d):
    """B1, B2: every search that the listings' values allow, three pages each."""
    rows = L.typed(s, d)
    return ingest.frontier(ingest.searches_of(rows), 3).select("comuna", "operacion", "tipo", F.col("page").cast("int").alias("page"), "url")


@query(""" SELECT sitio, id_aviso, CASE WHEN k % 3 = 0 AND k % 6 <> 0 THEN m2_util + 1 ELSE m2_util END AS m2_util, CASE WHEN k % 3 = 0 THEN 1 ELSE detalle_ok END AS detalle_ok, comuna FROM (SELECT *, id_aviso::BIGINT AS k FROM typed)""")
def detail_update(s, d):
    """Details replace what they give, never by null, and mark their listing as done; unknown ones add nothing."""
    base = L.typed(s, d).select("sitio", "id_aviso", "m2_util", "detalle_ok", "comuna")
    detail = base.where(KEY() % 3 == 0).select("sitio", "id_aviso", F.when(KEY() % 6 != 0, F.col("m2_util") + 1).alias("m2_util"))
    strangers = detail.withColumn("id_aviso", F.concat(F.lit("new"), "id_aviso"))
    return ingest.update_detail(base, detail.union(strangers), ["m2_util"])


@query(""" SELECT l_orderkey, l_linenumber, max(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity + 100 ELSE l_quantity END) AS l_quantity, (CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 1 END)::INT AS at FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def upsert_newer_and_older(s, d):
    """Newer rows win over the base, older ones do not."""
    base = L.table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity")).withColumn("at", F.lit(1))
    newer = base.where("l_linenumber % 2 = 1").withColumns({"l_quantity": F.col("l_quantity") + 100, "at": F.lit(2)})
    older = base.where("l_linenumber % 3 = 0").withColumns({"l_quantity": F.lit(0.0), "at": F.lit(0)})
    return ingest.upsert_latest(base, newer.union(older), ["at"], ["l_orderkey", "l_linenumber"])


BUCKETS = 8


@query(""", b AS (SELECT sitio, id_aviso, id_aviso::BIGINT AS k, m2_util, precio_uf, comuna FROM typed) SELECT sitio, id_aviso, CASE WHEN k % 3 = 0 AND k % 6 <> 0 THEN m2_util + 1 ELSE m2_util END AS m2_util, CASE WHEN k % 3 = 0 THEN coalesce(precio_uf + 1, precio_uf) ELSE precio_uf END AS precio_uf, comuna FROM b""")
def merge_into_buckets(s, d):
    """A batch merged into a table in buckets of its keys, which is not shuffled."""
    base = L.typed(s, d).select("sitio", "id_aviso", "m2_util", "precio_uf", "comuna")
    table = bucketed.write_bucketed(base, place(s), ["sitio", "id_aviso"], BUCKETS)
    batch = base.where(KEY() % 3 == 0).select("sitio", "id_aviso", F.when(KEY() % 6 != 0, F.col("m2_util") + 1).alias("m2_util"), (F.col("precio_uf") + 1).alias("precio_uf"))
    return ingest.merge_partial(table, batch, ["m2_util", "precio_uf"])


@query(""" SELECT l_orderkey, l_linenumber, max(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity + 100 ELSE l_quantity END) AS l_quantity, (CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 1 END)::INT AS at FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def upsert_into_buckets(s, d):
    """Newer rows replace those of a table in buckets, older ones do not; the table is opened anew, as by a later session."""
    base = L.table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity")).withColumn("at", F.lit(1))
    path, keys = place(s), ["l_orderkey", "l_linenumber"]
    bucketed.write_bucketed(base, path, keys, BUCKETS)
    table = bucketed.read_bucketed(s, path, keys, BUCKETS)
    newer = base.where("l_linenumber % 2 = 1").withColumns({"l_quantity": F.col("l_quantity") + 100, "at": F.lit(2)})
    older = base.where("l_linenumber % 3 = 0").withColumns({"l_quantity": F.lit(0.0), "at": F.lit(0)})
    return ingest.upsert_keyed(table, newer.union(older), ["at"], keys)


@query(""" SELECT sitio, id_aviso, CASE WHEN id_aviso::BIGINT % 2 = 0 THEN m2_util * 2 ELSE m2_total END AS m2_total FROM typed""")
def written_back(s, d):
    """A computed column by key; other rows keep what they hold."""
    rows = L.typed(s, d).select("sitio", "id_aviso", "m2_util", "m2_total")
    computed = rows.where(KEY() % 2 == 0).select("sitio", "id_aviso", (F.col("m2_util") * 2).alias("m2_total"))
    return ingest.write_back(rows, computed, "m2_total", ["sitio", "id_aviso"]).select("sitio", "id_aviso", "m2_total")


@query(""" SELECT poi_id, CASE WHEN categoria = 'metro' THEN nombre || ' nuevo' ELSE nombre END AS nombre, categoria FROM places""")
def replaced_category(s, d):
    """One category is replaced, the others stay."""
    path, rows = place(s), L.places(s, d).select("poi_id", "nombre", "categoria")
    ingest.overwrite_partitions(rows, path, "categoria")
    ingest.overwrite_partitions(rows.where("categoria = 'metro'").withColumn("nombre", F.concat("nombre", F.lit(" nuevo"))), path, "categoria")
    return s.read.schema(rows.schema).parquet(path)


# services

_TYPES = [["school", "park"], ["supermarket"], ["hospital"], ["grocery_store", "supermarket"], ["dog_park"]]


def _answered(s: SparkSession, d: str) -> DataFrame:
    """A cached answer for each supplier: up to 24 places, some without coordinates; every eleventh call failed."""
    at = F.col("s_suppkey")
    place = lambda j: F.concat(
        F.lit('{"displayName": {"text": "lugar '), j.cast("string"), F.lit('"}, "types": '), F.element_at(F.array(*[F.lit(str(t).replace("'", '"')) for t in _TYPES]), (j % 5 + 1).cast("int")),
        F.when(j % 6 == 5, F.lit("}")).otherwise(F.concat(F.lit(', "location": {"latitude": -33.4'), (10 + (at + j * 7) % 80).cast("string"), F.lit(', "longitude": -70.6'), (10 + (at * 3 + j) % 80).cast("string"), F.lit("}}"))),
    )
    body = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), at % 24), place), ", "), F.lit("]"))
    return L.table(s, d, "supplier").select(F.concat(F.lit("p"), at).alias("punto"), F.lit(-33.45).alias("lat"), F.lit(-70.65).alias("lon"), body.alias("respuesta"), F.when(at % 11 == 0, "error").otherwise("ok").alias("estado"))


_ANSWERS = """, a AS (SELECT 'p' || s_suppkey AS point, s_suppkey AS s, unnest(range(s_suppkey % 24 + 1)) AS j FROM supplier WHERE s_suppkey % 11 <> 0),
t AS (SELECT point, 'lugar ' || j AS nombre, unnest(CASE j % 5 WHEN 0 THEN ['educacion', 'parque'] WHEN 1 THEN ['supermercado'] WHEN 3 THEN ['supermercado'] WHEN 4 THEN ['parque'] ELSE [] END) AS categoria, j,
  ('-33.4' || (10 + (s + j * 7) % 80))::DOUBLE AS y, ('-70.6' || (10 + (s * 3 + j) % 80))::DOUBLE AS x FROM a),
m AS (SELECT *, 2 * 6371000::DOUBLE * asin(sqrt(least(1::DOUBLE, power(sin((radians(y) - radians(-33.45::DOUBLE)) / 2), 2) + cos(radians(-33.45::DOUBLE)) * cos(radians(y)) * power(sin((radians(x) - radians(-70.65::DOUBLE)) / 2), 2)))) AS d FROM t)
"""


@query(_ANSWERS + """SELECT point, categoria, round_even(min(d), 0)::INT AS mas_cercano_m, arg_min(nombre, (d, nombre)) AS nombre, count(*) FILTER (d <= 1000) AS n_1km FROM m WHERE j % 6 <> 5 GROUP BY point, categoria""")
def dense_services(s, d):
    """Services out of cached answers, by category."""
    return geo.dense(geo.answers(_answered(s, d)))


@query(""" SELECT 'p' || s_suppkey AS point, s_suppkey % 24 + 1 >= 20 AS truncated FROM supplier WHERE s_suppkey % 11 <> 0""")
def truncated_answers(s, d):
    """answers that were cut."""
    return geo.answers(_answered(s, d)).select("point", "truncated")


@query(_ANSWERS + """SELECT point, categoria, count(*) AS n FROM m GROUP BY point, categoria""")
def places_by_category(s, d):
    """answered places of each point by category."""
    rows = geo.answers(_answered(s, d)).select("point", F.explode("places").alias("p")).select("point", F.col("p.types").alias("types"))
    return geo.places_by_category(rows)


@query(""" SELECT categoria, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM points), 6) AS pct FROM near GROUP BY categoria""")
def service_coverage(s, d):
    """percent of points with a known nearest place."""
    return geo.coverage(L.points(s, d), geo.nearest(L.points(s, d), L.places(s, d)))


@query(""", b AS (SELECT min(lat) AS y0, max(lat) AS y1, min(lon) AS x0, max(lon) AS x1 FROM points) SELECT round(y0 + i * ((y1 - y0) / 5), 9) AS lat, round(x0 + j * ((x1 - x0) / 5), 9) AS lon FROM b, (SELECT unnest(range(6)) AS i), (SELECT unnest(range(6)) AS j)""")
def search_grid(s, d):
    """a grid of 6 x 6 over all points."""
    box = L.points(s, d).agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    return geo.grid(s, tuple(box), 6).select(F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query(""", k AS (SELECT id_aviso, id_aviso::BIGINT AS k FROM targets) SELECT id_aviso, CASE WHEN k % 7 <> 0 THEN (k % 2000)::DOUBLE END AS dist_metro_m, round(CASE WHEN k % 7 <> 0 THEN ln(1 + k % 2000) END, 6) AS log_dist_metro, CASE WHEN k % 7 <> 0 THEN (k % 5)::DOUBLE END AS n_metro_1km,
  CASE WHEN k % 7 <> 0 AND k % 3 = 0 THEN 450::DOUBLE END AS dist_parque_m, CASE WHEN k % 7 <> 0 THEN (k % 2)::DOUBLE END AS servicios_truncado, (k % 7 = 0)::INT::DOUBLE AS sin_servicios FROM k""")
def service_features(s, d):
    """Services text with and without values, categories and the mark of cut answers."""
    park = F.when(KEY() % 3 == 0, ', "parque": {"mas_cercano_m": 450, "nombre": "P", "n_1km": 1}').otherwise("")
    cut = F.when(KEY() % 2 == 1, ', "_truncado": true}').otherwise("}")
    body = F.concat(F.lit('{"metro": {"mas_cercano_m": '), (KEY() % 2000).cast("string"), F.lit(', "nombre": "M", "n_1km": '), (KEY() % 5).cast("string"), F.lit("}"), park, cut)
    made = features.build_features(L.targets(s, d).withColumn("servicios_cercanos", F.when(KEY() % 7 == 0, "SIN_DATO").otherwise(body)))
    return made.select("id_aviso", "dist_metro_m", F.round("log_dist_metro", 6).alias("log_dist_metro"), "n_metro_1km", "dist_parque_m", "servicios_truncado", "sin_servicios")


# audit


def _scored(s: SparkSession, d: str, extra: Column | float = 0.0) -> DataFrame:
    """Sales with a price by area: the commune's median price a square metre, and a range around it."""
    rows = L.slim(s, d).where("operacion = 'venta'")
    rates = grouped_medians(rows, ["comuna"], {"rate": F.col("y") / F.col("m2_util")})
    made = stored(rows.join(rates, "comuna")).withColumn("pred", F.col("rate") * (F.col("m2_util") + extra))
    return made.withColumns({"lo": F.col("pred") * (0.7 + KEY() % 5 * 0.1), "hi": F.col("pred") * (0.9 + KEY() % 5 * 0.1)})


_SCORED = """, g AS (SELECT comuna, median(y / m2_util) AS rate FROM targets WHERE operacion = 'venta' GROUP BY comuna), z AS (SELECT *, rate * m2_util AS pred, id_aviso::BIGINT AS k FROM targets JOIN g USING (comuna) WHERE operacion = 'venta'),
w AS (SELECT *, pred * (0.7::DOUBLE + k % 5 * 0.1::DOUBLE) AS lo, pred * (0.9::DOUBLE + k % 5 * 0.1::DOUBLE) AS hi FROM z)
"""


@query(_SCORED + """SELECT 'served' AS range, count(*) AS n, 0::BIGINT AS n_outside FROM w UNION ALL SELECT 'raw', count(*), count(*) FILTER (NOT pred BETWEEN lo AND hi) FROM w""")
def range_holds_estimate(s, d):
    """Estimates outside their range, before and after it is made coherent."""
    raw = _scored(s, d)
    return report.outside(score.coherent(raw)).select(F.lit("served").alias("range"), "n", "n_outside").union(report.outside(raw).select(F.lit("raw"), "n", "n_outside"))


@query(_SCORED + """SELECT count(*) AS n, 0::BIGINT AS n_different FROM w""")
def spelling_of_comuna(s, d):
    """Estimates of listings whose commune is spelled with capitals, accents and spaces."""
    spelled = F.when(F.col("comuna") == "nunoa", " Ñuñoa").when(F.col("comuna") == "la-florida", "La Florida").when(F.col("comuna") == "san-miguel", "SAN_MIGUEL ").otherwise("Macul")
    rows = _scored(s, d)
    rates = rows.groupBy("comuna").agg(F.max("rate").alias("other"))
    again = rows.withColumn("comuna", slug(spelled)).join(F.broadcast(rates), "comuna", "left")
    return again.agg(F.count("*").alias("n"), F.count_if(~(F.col("other") * F.col("m2_util")).eqNullSafe(F.col("pred"))).alias("n_different"))


@query(""", e AS (SELECT t.id_aviso, n.point IS NOT NULL AS has FROM typed t LEFT JOIN celled c USING (sitio, id_aviso) LEFT JOIN near n ON n.point = c.cell AND n.categoria = 'metro' AND n.mas_cercano_m <= 15000) SELECT count(*) AS n_before, count(*) AS n_after, round(100.0::DOUBLE * count(*) FILTER (has) / count(*), 6) AS pct FROM e""")
def enrichment_check(s, d):
    """Rows before and after services are handed out, and the share that has them."""
    near = geo.nearest(L.points(s, d), L.places(s, d))
    full = geo.hand_out(L.clean(s, d), geo.summarise(near, near.limit(0), near.select("point", F.lit(False).alias("truncated")).distinct()))
    return report.enriched(L.typed(s, d), full, "servicios")


@query(_SCORED + """, q AS (SELECT median(abs(pred / y - 1)) * 100 AS v, count(*)::DOUBLE AS n FROM w) SELECT 'mdape' AS metric, round(v, 6) AS found, true AS ok FROM q UNION ALL SELECT 'n', n, false FROM q""")
def metrics_of_card(s, d):
    """A study beside its card; one published number is off."""
    rows = _scored(s, d)
    made = grouped_medians(rows, [], {"m": F.abs(F.col("pred") / F.col("y") - 1)}, (F.count("*").cast("double").alias("n"),))
    study = made.select(F.round(100 * F.col("m"), 6).alias("mdape"), "n")
    card = study.select(F.explode(F.array(F.struct(F.lit("mdape").alias("metric"), (F.col("mdape") + 0.005).alias("value")), F.struct(F.lit("n").alias("metric"), (F.col("n") + 1).alias("value")))).alias("c")).select("c.*")
    return report.same_metrics(study, card, {"mdape": 0.01, "n": 0.5}).select("metric", "found", "ok")


@query(_SCORED + """SELECT 'extra column' AS check, 0::DOUBLE AS value FROM (SELECT count(*) FROM w) UNION ALL SELECT 'larger area', round(max(rate) * 20, 6) FROM w UNION ALL SELECT 'share rising', 100::DOUBLE FROM (SELECT count(*) FROM w)""")
def reaction_to_inputs(s, d):
    """A column that holds the target changes nothing, 20 square metres more raise every price."""
    base, larger = _scored(s, d), _scored(s, d, 20.0)
    leaky = _scored(s, d).withColumn("target_again", F.col("y"))
    rows = [report.largest_change(base, leaky, "id_aviso").select(F.lit("extra column").alias("check"), F.col("largest").alias("value")), report.largest_change(base, larger, "id_aviso").select(F.lit("larger area"), F.round("largest", 6)), report.monotone_share(base, larger, "id_aviso").select(F.lit("share rising"), "share")]
    return rows[0].union(rows[1]).union(rows[2])


@query(_SCORED + """SELECT count(*) AS n, count(*) FILTER (NOT coalesce(pred BETWEEN 2000 AND 20000, false)) AS n_bad FROM w""")
def implausible_estimates(s, d):
    """Estimates that are missing, infinite or out of range."""
    return report.implausible(_scored(s, d), "pred", 2000.0, 20000.0)


@query(""" SELECT 'n_dates' AS "column", (SELECT count(DISTINCT fecha_scrape) FILTER (operacion = 'venta') = count(DISTINCT fecha_scrape) FILTER (operacion = 'arriendo') FROM typed) AS equal UNION ALL SELECT 'filled', (SELECT count(m2_total) FILTER (operacion = 'venta') = count(m2_total) FILTER (operacion = 'arriendo') FROM typed) UNION ALL SELECT 'rate', (SELECT round(median(precio_clp / precio_uf) FILTER (operacion = 'venta' AND precio_uf > 0), 6) = round(median(precio_clp / precio_uf) FILTER (operacion = 'arriendo' AND precio_uf > 0), 6) FROM typed) UNION ALL SELECT 'median_uf', (SELECT median(precio_uf) FILTER (operacion = 'venta') = median(precio_uf) FILTER (operacion = 'arriendo') FROM typed)""")
def params_agreement(s, d):
    """Parameters of the sale and the rent frame; rates and dates agree, prices don't."""
    def params(market: str) -> DataFrame:
        rows = L.typed(s, d).where(F.col("operacion") == market)
        rate = F.when(F.col("precio_uf") > 0, F.col("precio_clp") / F.col("precio_uf"))
        dates = rows.agg(F.count_distinct("fecha_scrape").alias("n_dates"), F.count("m2_total").alias("filled"))
        return grouped_medians(rows, [], {"rate": rate, "median_uf": F.col("precio_uf")}).withColumn("rate", F.round("rate", 6)).crossJoin(dates)

    return report.params_agreement(params("venta"), params("arriendo"), ["rate", "n_dates", "filled", "median_uf"])


@query(""" SELECT sum((m2_total IS NULL)::BIGINT + (bodegas IS NULL)::BIGINT + (precio_uf IS NULL)::BIGINT + (lat IS NULL)::BIGINT)::BIGINT AS n_nulls FROM typed""")
def null_cells_typed(s, d):
    """N3 on a frame that has nulls."""
    return report.nulls(L.typed(s, d).select("m2_total", "bodegas", "precio_uf", "lat"))


@query(_SCORED + """, q AS (SELECT quantile_cont(y / pred, 0.25) AS a, quantile_cont(y / pred, 0.5) AS b, quantile_cont(y / pred, 0.75) AS c FROM w) SELECT round(a, 6) AS p25, round(b, 6) AS p50, round(c, 6) AS p75, c - a < b / 100 AS stable, abs(b - 1) <= 0.5 AS near FROM q""")
def rate_spread(s, d):
    """N4 on ratios that spread, with the check against a reference value."""
    rows = _scored(s, d).select(F.col("y").alias("precio_clp"), F.col("pred").alias("precio_uf"))
    return report.rate_stability(rows, 1.0, 0.5)


@query(""", r AS (SELECT precio_clp / precio_uf AS v FROM typed WHERE precio_uf > 0) SELECT round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) < quantile_cont(v, 0.5) / 100 AS stable, abs(quantile_cont(v, 0.5) - 39999.5) <= 1 AS near FROM r""")
def rate_near_reference(s, d):
    """The implied rate against a published one."""
    return report.rate_stability(L.typed(s, d), 39999.5)


# pages, exports, modes and parts of studies


@query(""" SELECT page_id, length(html)::INT AS n_chars, md5(html) AS digest FROM pages""")
def gz_pages(s, d):
    """A10: every page as a gzip file of its own, named by its key in the path, and read back whole."""
    path = place(s)
    tables.write_pages(L.table(s, d, "pages"), path, "page_id")
    return tables.read_pages(s, path).select(F.col("page_id").cast("long").alias("page_id"), F.length("html").alias("n_chars"), F.md5(F.col("html").cast("binary")).alias("digest"))


@query(_SCORED + """, m AS (SELECT round(median(abs(pred / y - 1)) * 100, 6) AS v, count(*)::DOUBLE AS n FROM w) SELECT 'area' AS model, 'mdape' AS metric, v AS value FROM m UNION ALL SELECT 'area', 'n', n FROM m""")
def card_round_trip(s, d):
    """A metrics card written as JSON lines and read back."""
    made = grouped_medians(_scored(s, d), [], {"m": F.abs(F.col("pred") / F.col("y") - 1)}, (F.count("*").cast("double").alias("n"),))
    card = made.select(F.lit("area").alias("model"), F.round(100 * F.col("m"), 6).alias("mdape"), "n").unpivot(["model"], ["mdape", "n"], "metric", "value")
    path = place(s)
    tables.write_card(card, path)
    return s.read.schema(card.schema).json(path)


@query(""" SELECT "column" FROM (UNPIVOT (SELECT """ + ", ".join(f"count({c}) AS {c}" for c in ("sitio", "id_aviso", "comuna", "m2_util", "m2_total", "lat", "detalle_ok")) + """, 0 AS url, 0 AS titulo, 0 AS barrio FROM typed) ON COLUMNS(*) INTO NAME "column" VALUE n) WHERE n > 0""")
def columns_with_values(s, d):
    """Columns that hold no value at all are dropped."""
    rows = L.typed(s, d).select("sitio", "id_aviso", "comuna", "m2_util", "m2_total", "lat", "detalle_ok", "url", "titulo", "barrio")
    return s.createDataFrame([(c,) for c in clean.drop_empty(rows).columns], "column string")


@query(""" SELECT m AS prices, count(CASE WHEN m = 'clp' THEN precio_uf ELSE coalesce(precio_uf, precio_clp / rate) END) AS n_uf, count(CASE WHEN m = 'uf' THEN precio_clp ELSE coalesce(precio_clp, precio_uf * rate) END) AS n_clp FROM typed, rate, (VALUES ('both'), ('uf'), ('clp')) v(m) GROUP BY m""")
def price_modes(s, d):
    """Prices rebuilt both ways, for sales only in UF, for rents only in CLP."""
    rows, made = L.typed(s, d), None
    rate = stored(clean.infer_rate(rows))
    for mode in ("both", "uf", "clp"):
        one = clean.repair(rows, rate, prices=mode).agg(F.lit(mode).alias("prices"), F.count("precio_uf").alias("n_uf"), F.count("precio_clp").alias("n_clp"))
        made = one if made is None else made.union(one)
    return made


@query(""" SELECT count(*) AS n, round(100 * avg((s_suppkey % 24 + 1 >= 20)::INT), 6) AS pct FROM supplier WHERE s_suppkey % 11 <> 0""")
def truncated_answers_share(s, d):
    """the percent of answered points whose answer was cut."""
    return geo.truncated_share(geo.answers(_answered(s, d)))


@query(""", b AS (SELECT id_aviso, m2_util, tipo FROM targets) SELECT id_aviso, m2_util, round(ln(m2_util), 6) AS log_m2_util, NULL::DOUBLE AS antiguedad, m2_util AS m2_por_dormitorio, (tipo = 'casa')::INT::DOUBLE AS es_casa, 1::DOUBLE AS sin_geo, 1::DOUBLE AS sin_servicios FROM b""")
def features_of_few_fields(s, d):
    """Listings of which only area and kind are known, as an estimate gets them; absent columns count as null, forbidden ones are refused."""
    made = features.select_blocks(features.scoring_input(L.slim(s, d).select("id_aviso", "m2_util", "tipo")), ["id_aviso"])
    return made.select("id_aviso", "m2_util", F.round("log_m2_util", 6).alias("log_m2_util"), "antiguedad", "m2_por_dormitorio", "es_casa", "sin_geo", "sin_servicios")


_KEYED = ", keyed AS (SELECT *, coalesce('g:' || printf('%.4f,%.4f', lat, lon), 'd:' || direccion) AS building FROM targets), u AS (SELECT *, ('0x' || substr(md5('42:' || building), 1, 8))::BIGINT / 4294967296::DOUBLE AS u1, ('0x' || substr(md5('7:' || building), 1, 8))::BIGINT / 4294967296::DOUBLE AS u2 FROM keyed)"


@query(_KEYED + " SELECT CASE WHEN u2 < 0.25 THEN 'test' ELSE 'train' END AS part, count(*) AS n, count(DISTINCT building) AS n_buildings FROM u WHERE NOT u1 < 0.2 GROUP BY 1")
def calibration_split(s, d):
    """H4: the training side divided again by building, three quarters to fit and one to calibrate."""
    train = features.split_by_group(features.building_key(L.slim(s, d)), "building").where("side = 'train'")
    return features.split_by_group(train, "building", 0.25, 7, name="part").groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("building").alias("n_buildings"))


@query(_SCORED + """, m AS (SELECT round(median(abs(pred / y - 1)) * 100, 6) AS v FROM w WHERE y > 0) SELECT v AS mdape, round(v / 100 / 0.6745::DOUBLE, 9) AS sigma FROM m""")
def implied_sigma(s, d):
    """The deviation of the log error that the median error implies."""
    study = ratio.ratio_study(_scored(s, d))
    return study.select("mdape", F.round(ratio.implied_sigma(F.col("mdape")), 9).alias("sigma"))


@query(""", g AS (SELECT comuna || '/' || tipo AS cluster, count(*) AS n FROM targets GROUP BY ALL) SELECT cluster, n, round(100.0::DOUBLE * n / sum(n) OVER (), 4) AS share, n = min(n) OVER () AS is_least FROM g""")
def least_cluster(s, d):
    """Sizes of groups and the least share."""
    return segment.least_share(L.slim(s, d).withColumn("cluster", F.concat_ws("/", "comuna", "tipo")), "cluster")


@query(""", e AS (SELECT *, greatest(lo - y, y - hi) AS e FROM predictions WHERE operacion = 'venta'), c AS (SELECT list_sort(list(e)) AS l, count(*) AS n FROM e), s AS (SELECT l[greatest(1, least(n, ceil((n + 1) * 0.8)))::INT] AS shift FROM c) SELECT id_aviso, round(greatest(lo - shift, 0), 6) AS lo, round(hi + shift, 6) AS hi FROM e, s""")
def widened_interval(s, d):
    """L3: the range less and plus the calibrated shift, its lower end not below 0."""
    rows = stored(L.predictions(s, d).where("operacion = 'venta'"))
    return score.apply_interval(rows, score.conformal_shift(rows)).select("id_aviso", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(""", v AS (SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN embedding[1]::DOUBLE END AS a, embedding[2]::DOUBLE AS b FROM embeddings), m AS (SELECT median(a) AS ma, median(b) AS mb FROM v), f AS (SELECT vec_id, coalesce(a, ma) AS a, coalesce(b, mb) AS b FROM v, m)
SELECT vec_id, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 6) AS a, round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 6) AS b FROM f""")
def scaled_matrix(s, d):
    """Missing values as the column's median, then scaled by the population deviation."""
    rows = L.table(s, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 != 0, F.col("embedding")[0].cast("double")).alias("a"), F.col("embedding")[1].cast("double").alias("b"))
    return segment.scale_matrix(rows, ["a", "b"], ["vec_id"]).select("vec_id", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


@query(""", s AS (SELECT sitio, id_aviso, m2_util, count(*) OVER (PARTITION BY sitio, id_aviso) AS n FROM typed) SELECT 'rows_a' AS side, count(*) AS n FROM typed UNION ALL SELECT 'rows_b', count(*) + count(*) FILTER (id_aviso::BIGINT % 10 = 0) - count(*) FILTER (id_aviso::BIGINT % 9 = 0) FROM typed UNION ALL SELECT 'only_a', count(*) FILTER (id_aviso::BIGINT % 9 = 0) FROM typed UNION ALL SELECT 'only_b', count(*) FILTER (id_aviso::BIGINT % 10 = 0) FROM typed""")
def mirror_with_strangers(s, d):
    """A mirror that lacks some keys and holds others of its own."""
    a = L.typed(s, d).select("sitio", "id_aviso")
    b = a.where(KEY() % 9 != 0).union(a.where(KEY() % 10 == 0).withColumn("id_aviso", F.concat(F.lit("x"), "id_aviso")))
    names = ["rows_a", "rows_b", "only_a", "only_b"]
    return report.mirror_parity(a, b, ["sitio", "id_aviso"]).unpivot([], names, "side", "n")
