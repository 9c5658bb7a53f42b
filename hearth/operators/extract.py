"""Listings out of web pages: column expressions over a table of pages (page_id, url, html)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from hearth.functions.numbers import as_double, currency, es_rango, let, numero, prices
from hearth.functions.text import clean_text, covered, plain
from hearth.operators.asof import asof_join

#: Hosts that are read, paths that are no listing, and markers in pages (fixed values).
HOSTS = {
    "portalinmobiliario.com": "pi", "www.portalinmobiliario.com": "pi",
    "mercadolibre.cl": "ml", "www.mercadolibre.cl": "ml", "casa.mercadolibre.cl": "ml",
    "departamento.mercadolibre.cl": "ml", "inmueble.mercadolibre.cl": "ml", "articulo.mercadolibre.cl": "ml",
}
NO_LISTING = ["/perfil/", "/tienda/", "/pagina/", "/catalogo/", "/ofertas", "/listado.", "/propiedades/", "/diario/", "/financiamiento/"]
LISTING_ID = r"(?i)MLC-?(\d{6,})"
CONTEXT = r'<script id="__NORDIC_RENDERING_CTX__"[^>]*>_n\.ctx\.r='
LD_JSON = r'(?s)<script type="application/ld\+json"[^>]*>(.*?)</script>'
SPEC_ROW = r"(?s)<th[^>]*>(.*?)</th>\s*<td[^>]*>(.*?)</td>"
MAP_CENTRE = r"center=(-?\d+\.\d+)(?:%2C|,)(-?\d+\.\d+)"
HEADING = r"(?s)<h1[^>]*>(.*?)</h1>"
DESCRIPTION = r"(?s)ui-pdp-description__content[^>]*>(.*?)</p>"
ADDRESS = r">\s*([^<>{}]{5,160}?(?:RM \(Metropolitana\)|Metropolitana))\s*<"
#: Beginning of a specification's plain label to its column; the first that fits counts (fixed values).
SPEC_COLUMNS = [
    ("superficie total", "m2_total"), ("superficie util", "m2_util"), ("superficie construida", "m2_util"), ("dormitorios", "dormitorios"), ("banos", "banos"),
    ("estacionamientos", "estacionamientos"), ("bodegas", "bodegas"), ("antiguedad", "antiguedad_anos"), ("gastos comunes", "gastos_comunes_clp"),
]
#: Columns of whole numbers, the bounds of sane values, and the length below which a page is no listing (fixed values).
WHOLE = {"dormitorios", "banos", "estacionamientos", "bodegas", "antiguedad_anos"}
LIMITS = {"lat": (-33.70, -33.40), "lon": (-70.70, -70.45), "m2": (10.0, 2000.0), "venta": (200.0, 100_000.0), "arriendo": (80_000.0, 10_000_000.0)}
LEAST_LENGTH = 50_000


def extracted(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def canonical_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """df with dominio, sitio, id_aviso, canonical and url_error (null for a listing's URL)."""
    raw = F.trim(F.coalesce(url_col, F.lit("")))
    full = F.when(raw.rlike("^https?://"), raw).otherwise(F.concat(F.lit("https://"), raw))
    made = df.withColumn("full_", full).withColumns({
        "dominio": F.lower(extracted(F.col("full_"), r"^https?://([^/?#:]*)")),
        "path_": F.coalesce(extracted(F.col("full_"), r"^https?://[^/?#]*(/[^?#]*)"), F.lit("")),
        "query_": F.coalesce(extracted(F.col("full_"), r"^[^?#]*\?([^#]*)"), F.lit("")),
    })
    site = F.try_element_at(F.create_map(*[F.lit(x) for p in HOSTS.items() for x in p]), "dominio")
    number = F.coalesce(extracted(F.col("path_"), LISTING_ID), extracted(F.col("query_"), LISTING_ID))
    barred = F.exists(F.array(*[F.lit(p) for p in NO_LISTING]), lambda p: F.contains(F.lower("path_"), p))
    error = F.when(raw == "", "empty").when(site.isNull(), "unknown_host").when(barred, "not_a_listing").when(number.isNull(), "no_id")
    made = made.withColumns({"sitio": site, "id_aviso": number, "url_error": error})
    ok = F.col("url_error").isNull()
    return made.withColumns({"canonical": F.when(ok, F.concat(F.lit("https://"), "dominio", "path_")), "id_aviso": F.when(ok, F.col("id_aviso")), "sitio": F.when(ok, F.col("sitio"))}).drop("full_", "path_", "query_")


def shortened(c: Column, most: int = 2000) -> Column:
    """The beginning of a description, as bulk listings keep it."""
    return F.substring(c, 1, most)


def json_ld(html: Column) -> Column:
    """All blocks of linked data that are JSON, in order."""
    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(LD_JSON), F.lit(1)), lambda b: F.try_parse_json(b)), lambda v: v.isNotNull())


def of_type(blocks: Column, kind: str) -> Column:
    """The first block of a type."""
    return F.try_element_at(F.filter(blocks, lambda v: F.try_variant_get(v, "$['@type']", "string") == kind), F.lit(1))


def breadcrumb(blocks: Column) -> Column:
    """The names of the category path."""
    items = F.try_variant_get(of_type(blocks, "BreadcrumbList"), "$.itemListElement", "array<variant>")
    return F.transform(items, lambda i: F.coalesce(F.try_variant_get(i, "$.item.name", "string"), F.lit("")))


def last_start(names: Column, words: list[str]) -> Column:
    """The word that the last name with one of these beginnings begins with."""
    found = F.transform(names, lambda n: F.coalesce(*[F.when(F.startswith(F.lower(n), F.lit(w)), w) for w in words], F.lit(None).cast("string")))
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(-1))


def after_region(names: Column, steps: int) -> Column:
    """The name so many places after the region."""
    is_region = F.transform(names, lambda n: F.contains(F.lower(n), F.lit("metropolitana")) | (F.trim(F.lower(n)) == "rm"))
    at = F.array_position(is_region, True)
    return F.when(at > 0, F.try_element_at(names, (at + steps).cast("int")))


def specs(html: Column) -> Column:
    """Labels and texts of the specification table, in page order."""
    tagless = lambda row, group: F.trim(F.regexp_replace(F.regexp_extract(row, SPEC_ROW, group), "<[^>]+>", " "))
    return F.transform(F.regexp_extract_all(html, F.lit(SPEC_ROW), F.lit(0)), lambda row: F.struct(tagless(row, 1).alias("label"), tagless(row, 2).alias("text")))


def render_context(html: Column) -> Column:
    """The page's own model; text after the JSON is no fault."""
    start = F.regexp_instr(html, F.lit(CONTEXT))
    body = F.when(start > 0, F.regexp_replace(F.substring(html, start, F.length(html)), "^" + CONTEXT, ""))
    return F.try_parse_json(F.coalesce(F.substring_index(body, "</script>", 1), body))


@F.pandas_udf(ArrayType(StringType()))
def find_nodes(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """All objects of a type anywhere in a JSON tree, as JSON texts; SQL paths don't search all depths."""

    def search(text: str | None, kind: str) -> list[str] | None:
        if text is None:
            return None
        found, stack = [], [json.loads(text)]
        while stack:
            node = stack.pop()
            if isinstance(node, dict):
                if node.get("type") == kind:
                    found.append(json.dumps(node, ensure_ascii=False))
                stack += node.values()
            elif isinstance(node, list):
                stack += node
        return found

    for text, kind in texts:
        yield pd.Series([search(t, k) for t, k in zip(text, kind, strict=True)], dtype=object)


def fetch_outcome(df: DataFrame, status_col: str = "status_code", html_col: str = "html", least: int = LEAST_LENGTH) -> DataFrame:
    """df with outcome: ok, bloqueado, no_existe, challenge, red or error_http."""
    s, h = F.col(status_col), F.col(html_col)
    holds = F.coalesce(F.contains(h, F.lit("application/ld+json")) | F.contains(h, F.lit("__NORDIC_RENDERING_CTX__")) | F.contains(h, F.lit("<th")), F.lit(False))
    challenge = h.isNull() | (F.length(h) < least) | ~holds
    return df.withColumn("outcome", F.when(s.isNull(), "red").when(s.isin(403, 429), "bloqueado").when(s.isin(404, 410), "no_existe").when(s >= 400, "error_http").when(challenge, "challenge").otherwise("ok"))


def published_ago(text: Column, as_of: Column) -> tuple[Column, Column]:
    """(days, date) of "Publicado hace N dias/meses/años"."""
    pattern = r"(?i)Publicado hace (\d+) (d[ií]a|mes|a[ñn]o)"
    n, unit = extracted(text, pattern, 1).try_cast("int"), F.lower(extracted(text, pattern, 2))
    days = n * F.when(F.startswith(unit, F.lit("d")), 1).when(F.startswith(unit, F.lit("m")), 30).otherwise(365)
    return days, F.date_sub(as_of, days)


def explode_cards(pages: DataFrame, card: str, keep: list[str]) -> DataFrame:
    """One row for each match of the card's expression, with its place on the page."""
    return pages.select(*keep, F.posexplode(F.regexp_extract_all("html", F.lit(card), F.lit(0))).alias("position", "card"))


def card_attributes(texts: Column) -> Column:
    """(dormitorios, banos, m2_util) from a card's short texts; a single room counts as 0."""

    def read(low: Column) -> Column:
        first = lambda word: F.try_element_at(F.filter(low, lambda t: F.contains(t, F.lit(word))), F.lit(1))
        digits = lambda c: extracted(c, r"(\d+)").try_cast("int")
        rooms = F.when(F.exists(low, lambda t: F.contains(t, F.lit("monoambiente"))), 0).otherwise(digits(first("dormitorio")))
        return F.struct(rooms.alias("dormitorios"), digits(first("bano")).alias("banos"), numero(first("m²")).alias("m2_util"))

    return let(F.transform(texts, lambda t: plain(t)), read)


def neighbourhood_of(address: Column) -> Column:
    """The last but one part of an address of two or more."""
    parts = F.split(address, r"\s*,\s*")
    return F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2)))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, position, href) of a page's links."""
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))).alias("position", "href"))


def extract_listing(pages: DataFrame) -> DataFrame:
    """pages with the raw fields of a listing: the page's own model first, then linked data, then the markup."""
    ctx = pages.withColumns({"context": render_context(F.col("html")), "blocks": json_ld(F.col("html"))})
    node = lambda kind: F.try_parse_json(F.try_element_at(find_nodes(F.to_json("context"), F.lit(kind)), F.lit(1)))
    ctx = ctx.withColumns({"price_node": node("price"), "place_node": node("location"), "header_node": node("header"), "product": of_type(F.col("blocks"), "Product"), "path": breadcrumb(F.col("blocks"))})
    get = lambda c, p, t="string": F.try_variant_get(F.col(c), p, t)
    code = F.coalesce(get("price_node", "$.price.currency_id"), get("price_node", "$.currency_id"), get("product", "$.offers.priceCurrency"))
    out = ctx.withColumns({
        "id_aviso": F.nullif(F.replace(get("product", "$.productID"), F.lit("MLC"), F.lit("")), F.lit("")),
        "titulo": F.coalesce(get("header_node", "$.title.text"), get("header_node", "$.title"), clean_text(extracted(F.col("html"), HEADING)), F.nullif(F.trim(get("product", "$.name")), F.lit(""))),
        "precio_valor": F.coalesce(get("price_node", "$.price.value", "double"), get("price_node", "$.value", "double"), get("product", "$.offers.price", "double")),
        "precio_moneda": currency(code),
        "lat": as_double(F.coalesce(get("place_node", "$.map_info.location.latitude"), extracted(F.col("html"), MAP_CENTRE, 1))),
        "lon": as_double(F.coalesce(get("place_node", "$.map_info.location.longitude"), extracted(F.col("html"), MAP_CENTRE, 2))),
        "direccion": clean_text(extracted(F.col("html"), ADDRESS)),
        "descripcion": clean_text(extracted(F.col("html"), DESCRIPTION)),
        "specs": specs(F.col("html")),
        "operacion": last_start(F.col("path"), ["venta", "arriendo"]),
        "tipo": last_start(F.col("path"), ["casa", "departamento"]),
        "comuna_cruda": after_region(F.col("path"), 1),
        "barrio": after_region(F.col("path"), 2),
        "fuente": F.when(F.col("context").isNotNull(), "json_render").otherwise("html"),
    })
    return out.drop("context", "blocks", "price_node", "place_node", "header_node", "product", "path")


def assemble(raw: DataFrame, rate: Column, year: int = 2026) -> DataFrame:
    """Typed records of extract_listing(): coverage, ranges as projects, sane values, and why values are missing."""
    column = lambda label: let(plain(label), lambda p: F.coalesce(*[F.when(F.startswith(p, F.lit(k)), c) for k, c in SPEC_COLUMNS]))
    names = list(dict.fromkeys(c for _, c in SPEC_COLUMNS))

    def sorted_out(s: Column) -> Column:
        """Each specification once: its column, whether it gives a range, its number."""
        return F.struct(column(s["label"]).alias("column"), es_rango(s["text"]).alias("is_range"), numero(s["text"]).alias("number"))

    def one_by_one(rows: Column) -> Column:
        """Whether a known column gives a range, and the last number of each column that can be read."""
        whole = lambda col, s: s["number"].try_cast("int") if col in WHOLE else s["number"]
        last = lambda col: F.try_element_at(F.filter(rows, lambda s: (s["column"] == col) & ~s["is_range"] & whole(col, s).isNotNull()), F.lit(-1))
        return F.struct(F.exists(rows, lambda s: s["is_range"]).alias("project"), *[whole(col, last(col)).alias(col) for col in names])

    told = let(F.filter(F.transform("specs", sorted_out), lambda s: s["column"].isNotNull()), one_by_one)
    raw = raw.withColumn("told_", told)
    made = raw.withColumns({c: F.col(f"told_.{c}") for c in names} | {"uf_usada": rate, "es_proyecto": F.coalesce("told_.project", F.lit(False)).cast("int"), "comuna": F.coalesce(covered(F.col("comuna_cruda")), F.col("comuna_cruda")), "fuera_de_cobertura": covered(F.col("comuna_cruda")).isNull()})
    clp, uf = prices(F.col("precio_valor"), F.col("precio_moneda"), F.col("uf_usada"))
    inside = F.coalesce(F.col("lat").between(*LIMITS["lat"]) & F.col("lon").between(*LIMITS["lon"]), F.lit(False))
    sane = lambda c, lo, hi: F.when(F.col(c).between(lo, hi), F.col(c))
    util, total = sane("m2_util", *LIMITS["m2"]), sane("m2_total", *LIMITS["m2"])
    bad = lambda c, lo, hi: F.when(~F.col(c).between(lo, hi), f"{c} out of range")
    made = made.withColumns({"precio_clp": clp, "precio_uf": uf})
    why = F.array(
        F.when(F.col("fuera_de_cobertura"), "commune not covered"), F.when(F.col("es_proyecto") == 1, "project of several units"), F.when(rate.isNull(), "no exchange rate"), F.when(F.col("precio_valor").isNull(), "no price"),
        F.when(F.col("lat").isNull() | F.col("lon").isNull(), "no coordinates").when(~inside, "coordinates out of range"),
        bad("m2_util", *LIMITS["m2"]), bad("m2_total", *LIMITS["m2"]), F.when(util > total, "m2_util above m2_total"), bad("dormitorios", 0, 12), bad("banos", 1, 12),
        F.when((F.col("operacion") == "venta") & ~F.col("precio_uf").between(*LIMITS["venta"]), "sale price out of range"), F.when((F.col("operacion") == "arriendo") & ~F.col("precio_clp").between(*LIMITS["arriendo"]), "rent out of range"),
    )
    return made.withColumns({
        "advertencias": F.filter(why, lambda w: w.isNotNull()), "lat": F.when(inside, F.col("lat")), "lon": F.when(inside, F.col("lon")),
        "m2_util": util, "m2_total": F.when(F.coalesce(util <= total, F.lit(True)), total), "dormitorios": sane("dormitorios", 0, 12), "banos": sane("banos", 1, 12),
        "ano_construccion": F.when(F.col("antiguedad_anos").between(0, 200), F.lit(year) - F.col("antiguedad_anos")), "detalle_ok": F.lit(1),
    }).drop("comuna_cruda", "specs", "told_")


def with_rate(df: DataFrame, rates: DataFrame, date_col: str) -> DataFrame:
    """df with the last good rate on or before its date and where it comes from. rates: day, rate (null: failed).

    An as-of join on distinct dates; of several rates of a day the largest counts, and days before the first rate have none.
    """
    good = rates.where("rate IS NOT NULL").select(F.col("day").alias("rate_day"), "rate")
    joined = asof_join(df, good, date_col, "rate_day", ["rate"])
    return joined.withColumn("rate_origin", F.when(F.col("rate").isNull(), "none").when(F.col("rate_day") == F.col(date_col), "same_day").otherwise("fallback")).drop("rate_day")
