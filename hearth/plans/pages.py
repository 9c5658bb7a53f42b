"""Queries of page reading: listing pages rendered from orders, read back and held against the orders' numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import numbers
from hearth.operators import extract, ingest
from hearth.plans import listings as L
from hearth.plans.queries import query

RATE = 40000.0


def K() -> Column:
    return F.col("o_orderkey")


def B() -> Column:
    return F.col("o_custkey")


def text(*parts: Column | str) -> Column:
    """Columns and literal texts end to end."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def pick(c: Column, *names: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (c % len(names) + 1).cast("int"))


def _rendered(s: SparkSession, d: str) -> DataFrame:
    """One page for each order: the page's own model on a quarter, linked data on most, markup, projects with ranges, gaps and odd values."""
    sale, project = K() % 3 != 0, K() % 13 == 0
    value = F.when(sale, 100 + K() % 120000).otherwise(100000 + K() % 500 * 2000)
    code = F.when(sale, "CLF").otherwise("CLP")
    market, kind, commune = F.when(sale, "Venta").otherwise("Arriendo"), F.when(K() % 5 == 0, "Casas").otherwise("Departamentos"), pick(B(), "Macul", "La Florida", "Ñuñoa", "San Miguel", "Providencia")
    names = text(*[x for n in ("Inmuebles", kind, market, "RM (Metropolitana)", commune, "Plaza") for x in ('{"item": {"name": "', n, '"}}, ')], '{"item": {}}')
    script = lambda body: text('<script type="application/ld+json">', body, "</script>")
    crumbs = script(text('{"@type": "BreadcrumbList", "itemListElement": [', names, "]}"))
    product = F.when(K() % 6 == 1, "").otherwise(script(text('{"@type": "Product", "name": "Nombre ', K(), '", "productID": "MLC', K(), '", "offers": {"price": ', value, ', "priceCurrency": "', code, '"}}')))
    model = text('<script id="__NORDIC_RENDERING_CTX__" nonce="x">_n.ctx.r={"app": {"a": [{"type": "price", "price": {"value": ', value + 7, ', "currency_id": "', code, '"}}, {"type": "header", "title": {"text": "Titulo ', K(), '"}}]}};more</script>')
    row = lambda label, *value: text(f'<tr><th class="a">{label}</th> <td><span>', *value, "</span></td></tr>")
    util = F.lit(15) + (B() * 7 + K()) % 200
    rows = [
        row("Superficie total", F.when(project, "21.5 m² a 239.48 m²").otherwise(text(util + K() % 40 - 3, " m²"))), F.when(K() % 8 == 0, "").otherwise(row("Superficie útil", util, ",5 m²")),
        row("Dormitorios", F.when(project, "1 a 3").otherwise(((B() + K()) % 16).cast("string"))), row("Baños", K() % 14), row("Estacionamientos", K() % 13), row("Bodegas", K() % 3), row("Antigüedad", B() % 76, " años"), row("Gastos comunes", "$ ", K() % 9 * 20, ".000"), row("Otra", "1 a 3"),
    ]
    html = text(
        "<html>", script("{broken"), crumbs, product, F.when(K() % 4 == 0, model).otherwise(""), F.when(K() % 9 == 0, "").otherwise(text("<h1>Casa &amp; patio ", K(), "</h1>")), '"latitude": -35.67',
        '<img src="map?center=-33.', 40 + B() % 40, "5,-70.", 44 + K() % 30, '1&zoom=1">', "<table>", *rows, "</table>", "<p>Calle ", B() % 500, ", Barrio ", K() % 7, ", ", commune, ", RM (Metropolitana)</p>",
        '<p class="ui-pdp-description__content">Texto ', K(), " <b>amplio</b> &aacute;rea</p><p>Publicado hace ", 1 + K() % 5, " ", pick(K(), "días", "meses", "años"), "</p></html>",
    )
    return L.spread(L.table(s, d, "orders").select("o_orderkey", "o_custkey")).select(K().alias("page_id"), html.alias("html"))


_PAGES = """, p AS (SELECT o_orderkey AS k, o_custkey AS b, o_orderkey % 3 <> 0 AS sale, o_orderkey % 13 = 0 AS project, 15 + (o_custkey * 7 + o_orderkey) % 200 AS mu, ['Macul', 'La Florida', 'Ñuñoa', 'San Miguel', 'Providencia'][(o_custkey % 5 + 1)::INT] AS commune,
  CASE WHEN o_orderkey % 3 <> 0 THEN 100 + o_orderkey % 120000 ELSE 100000 + o_orderkey % 500 * 2000 END AS v FROM orders),
q AS (SELECT *, (CASE WHEN k % 4 = 0 THEN v + 7 WHEN k % 6 <> 1 THEN v END)::DOUBLE AS valor, CASE WHEN k % 8 <> 0 THEN mu + 0.5::DOUBLE END AS util, CASE WHEN NOT project THEN (mu + k % 40 - 3)::DOUBLE END AS total, CASE WHEN NOT project THEN ((b + k) % 16)::INT END AS beds,
  ('-33.' || (40 + b % 40) || '5')::DOUBLE AS y, ('-70.' || (44 + k % 30) || '1')::DOUBLE AS x FROM p),
r AS (SELECT *, CASE WHEN sale THEN round_even(valor * 40000, 0) ELSE valor END AS clp, CASE WHEN sale THEN valor ELSE round_even(valor / 40000, 2) END AS uf, y BETWEEN -33.70::DOUBLE AND -33.40::DOUBLE AND x BETWEEN -70.70::DOUBLE AND -70.45::DOUBLE AS inside FROM q)
"""


@query(_PAGES + """SELECT k AS page_id, CASE WHEN valor IS NOT NULL THEN CASE WHEN sale THEN 'UF' ELSE 'CLP' END END AS precio_moneda, valor AS precio_valor, clp AS precio_clp, uf AS precio_uf FROM r""")
def page_prices(s, d):
    """The page's own model before the offer."""
    made = extract.assemble(extract.extract_listing(_rendered(s, d)), F.lit(RATE))
    return made.select("page_id", "precio_moneda", "precio_valor", "precio_clp", "precio_uf")


@query(_PAGES + """SELECT k AS page_id, CASE WHEN k % 4 = 0 THEN 'Titulo ' || k WHEN k % 9 <> 0 THEN 'Casa & patio ' || k WHEN k % 6 <> 1 THEN 'Nombre ' || k END AS titulo, CASE WHEN k % 6 <> 1 THEN k::VARCHAR END AS id_aviso, 'Texto ' || k || '  amplio  área' AS descripcion, left('Texto ' || k || '  amplio  área', 9) AS corta,
  'Calle ' || (b % 500) || ', Barrio ' || (k % 7) || ', ' || commune || ', RM (Metropolitana)' AS direccion, CASE WHEN k % 4 = 0 THEN 'json_render' ELSE 'html' END AS fuente FROM r""")
def page_texts(s, d):
    """Texts with their origin, references resolved."""
    made = extract.extract_listing(_rendered(s, d))
    return made.select("page_id", "titulo", "id_aviso", "descripcion", extract.shortened(F.col("descripcion"), 9).alias("corta"), "direccion", "fuente")


@query(_PAGES + """SELECT k AS page_id, CASE WHEN sale THEN 'venta' ELSE 'arriendo' END AS operacion, CASE WHEN k % 5 = 0 THEN 'casa' ELSE 'departamento' END AS tipo, CASE commune WHEN 'Macul' THEN 'macul' WHEN 'La Florida' THEN 'la-florida' WHEN 'Ñuñoa' THEN 'nunoa' WHEN 'San Miguel' THEN 'san-miguel' ELSE commune END AS comuna, 'Plaza' AS barrio,
  commune = 'Providencia' AS fuera_de_cobertura, CASE WHEN inside THEN y END AS lat, CASE WHEN inside THEN x END AS lon FROM r""")
def page_places(s, d):
    """The category path, coverage and the map's centre."""
    made = extract.assemble(extract.extract_listing(_rendered(s, d)), F.lit(RATE))
    return made.select("page_id", "operacion", "tipo", "comuna", "barrio", "fuera_de_cobertura", "lat", "lon")


@query(_PAGES + """SELECT k AS page_id, project::INT AS es_proyecto, util AS m2_util, CASE WHEN NOT coalesce(util > total, false) THEN total END AS m2_total, CASE WHEN beds <= 12 THEN beds END AS dormitorios, CASE WHEN k % 14 BETWEEN 1 AND 12 THEN (k % 14)::INT END AS banos, (k % 13)::INT AS estacionamientos, (k % 3)::INT AS bodegas,
  (b % 76)::INT AS antiguedad_anos, (2026 - b % 76)::INT AS ano_construccion, (k % 9 * 20000)::DOUBLE AS gastos_comunes_clp, 1 AS detalle_ok, ((commune = 'Providencia')::INT + project::INT + (valor IS NULL)::INT + (NOT inside)::INT + coalesce(util > total, false)::INT + coalesce(beds > 12, false)::INT
  + (k % 14 IN (0, 13))::INT + coalesce(sale AND NOT uf BETWEEN 200 AND 100000, false)::INT + coalesce(NOT sale AND NOT clp BETWEEN 80000 AND 10000000, false)::INT)::INT AS n_warnings FROM r""")
def page_records(s, d):
    """Specifications, projects, sane values and the number of warnings."""
    made = extract.assemble(extract.extract_listing(_rendered(s, d)), F.lit(RATE))
    cols = ["es_proyecto", "m2_util", "m2_total", "dormitorios", "banos", "estacionamientos", "bodegas", "antiguedad_anos", "ano_construccion", "gastos_comunes_clp", "detalle_ok"]
    return made.select("page_id", *cols, F.size("advertencias").alias("n_warnings"))


@query(""", p AS (SELECT o_orderkey AS k, (1 + o_orderkey % 5) * [1, 30, 365][(o_orderkey % 3 + 1)::INT] AS days FROM orders) SELECT k AS page_id, days::INT AS days, (DATE '2026-01-31' - days::INT)::DATE AS published FROM p""")
def page_dates(s, d):
    """Age and date of publication."""
    days, day = extract.published_ago(F.col("html"), F.lit("2026-01-31").cast("date"))
    return _rendered(s, d).select("page_id", days.alias("days"), day.alias("published"))


@query(""", p AS (SELECT o_orderkey AS k, ['https://www.portalinmobiliario.com', 'casa.mercadolibre.cl', 'HTTPS://x', 'https://other.example', ''][(o_orderkey % 5 + 1)::INT] AS host,
  CASE WHEN o_orderkey % 7 = 0 THEN '/perfil/MLC-' || (1000000 + o_orderkey) WHEN o_orderkey % 11 = 0 THEN '/casa' ELSE '/MLC-' || (1000000 + o_orderkey) || '-casa-_JM' END AS path FROM orders),
e AS (SELECT *, CASE k % 5 WHEN 0 THEN 'www.portalinmobiliario.com' WHEN 1 THEN 'casa.mercadolibre.cl' WHEN 2 THEN 'https' WHEN 3 THEN 'other.example' END AS dominio,
  CASE WHEN k % 5 = 4 THEN 'empty' WHEN k % 5 > 1 THEN 'unknown_host' WHEN k % 7 = 0 THEN 'not_a_listing' WHEN k % 11 = 0 AND k % 2 = 0 THEN 'no_id' END AS url_error FROM p)
SELECT k AS page_id, dominio, url_error, CASE WHEN url_error IS NULL THEN CASE k % 5 WHEN 0 THEN 'pi' ELSE 'ml' END END AS sitio, CASE WHEN url_error IS NULL THEN (1000000 + k)::VARCHAR END AS id_aviso, CASE WHEN url_error IS NULL THEN 'https://' || dominio || path END AS canonical FROM e""")
def listing_urls(s, d):
    """Hosts, barred paths, ids in path or query, with and without scheme."""
    host = pick(K(), "https://www.portalinmobiliario.com", "casa.mercadolibre.cl", "HTTPS://x", "https://other.example", "")
    path = F.when(K() % 7 == 0, text("/perfil/MLC-", 1000000 + K())).when(K() % 11 == 0, "/casa").otherwise(text("/MLC-", 1000000 + K(), "-casa-_JM"))
    query_ = F.when((K() % 11 == 0) & (K() % 2 == 1), text("?item=MLC", 1000000 + K())).otherwise("?a=1")
    url = F.when(K() % 5 == 4, "  ").otherwise(text(host, path, query_, "#polycard_client=x"))
    made = extract.canonical_url(L.table(s, d, "orders").select(K().alias("page_id"), url.alias("url")))
    return made.select("page_id", "dominio", "url_error", "sitio", "id_aviso", "canonical")


def _results(s: SparkSession, d: str) -> DataFrame:
    """A page of results for each order: up to three cards and an advertisement without an id."""
    card = lambda j, link: text('<li class="card"><a href="https://x/', link, '">ver</a><span>', F.when((K() + j) % 6 == 0, "Monoambiente").otherwise(text((K() + j) % 6, " dormitorios")), "</span><span>", 1 + (K() + j) % 3, " baños</span><span>", 20 + (B() + j) % 90, " m² útiles</span><p>Calle ", B() % 50, ", Barrio ", (K() + j) % 9, ", Macul</p></li>")
    cards = [F.when(K() % 4 >= j, card(j, text("MLC-", 10000000 + K() * 10 + j, "-casa"))).otherwise("") for j in (1, 2, 3)]
    return L.spread(L.table(s, d, "orders").select("o_orderkey", "o_custkey")).select(K().alias("page_id"), text("<ol>", *cards, card(4, "anuncio"), "</ol>").alias("html"))


@query(""", c AS (SELECT o_orderkey AS k, o_custkey AS b, unnest([1, 2, 3]) AS j FROM orders) SELECT k AS page_id, (j - 1)::INT AS position, (10000000 + k * 10 + j)::VARCHAR AS id_aviso, ((k + j) % 6)::INT AS dormitorios, (1 + (k + j) % 3)::INT AS banos, (20 + (b + j) % 90)::DOUBLE AS m2_util, 'Barrio ' || ((k + j) % 9) AS barrio FROM c WHERE k % 4 >= j""")
def result_cards(s, d):
    """Cards of a results page without advertisements, their attributes and neighbourhood."""
    cards = extract.explode_cards(_results(s, d), r'(?s)<li class="card">.*?</li>', ["page_id"])
    cards = ingest.drop_artefacts(cards.withColumn("id_aviso", extract.extracted(F.col("card"), extract.LISTING_ID)))
    spans = F.regexp_extract_all("card", F.lit("<span>(.*?)</span>"), F.lit(1))
    barrio = extract.neighbourhood_of(extract.extracted(F.col("card"), "<p>(.*?)</p>"))
    return cards.select("page_id", "position", "id_aviso", extract.card_attributes(spans).alias("told"), barrio.alias("barrio")).select("page_id", "position", "id_aviso", "told.*", "barrio")


@query(""" SELECT o_orderkey AS k, (o_orderkey // 100)::INT AS cut, (o_orderkey * 1000 + 234)::INT AS grouped FROM orders""")
def whole_numbers(s, d):
    """D3: numbers cut to integers, and the first grouped integer of a text."""
    cents = text(F.floor(K() / 100), ",", F.lpad((K() % 100).cast("string"), 2, "0"), " m²")
    return L.table(s, d, "orders").select(K().alias("k"), numbers.entero(cents).alias("cut"), numbers.extract_int(text("total ", K(), ".234 pesos")).alias("grouped"))
