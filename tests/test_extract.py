"""Whole records out of small pages, and traps of page reading."""

import json

from pyspark.sql import functions as F

from hearth.operators import extract


def page(path, specs, offer, centre="-33.456,-70.598", extra=""):
    crumbs = {"@type": "BreadcrumbList", "itemListElement": [{"item": {"name": n}} for n in path]}
    product = {"@type": "Product", "name": "Nombre", "productID": "MLC123456", "offers": offer}
    rows = "".join(f"<tr><th class='a'>{k}</th> <td><span>{v}</span></td></tr>" for k, v in specs)
    blocks = "".join(f'<script type="application/ld+json">{b}</script>' for b in ("{broken", json.dumps(crumbs), json.dumps(product)))
    return f'<html>{blocks}<h1>Casa &amp; jard&iacute;n</h1>"latitude": -35.67<img src="map?center={centre}&zoom=1"><table>{rows}</table><p>Calle 1, Ñuñoa, RM (Metropolitana)</p>{extra}</html>'


HOUSE = page(["Inmuebles", "Casas", "Venta", "Propiedades usadas", "RM (Metropolitana)", "Ñuñoa", "Plaza"], [("Superficie total", "458 m²"), ("Superficie útil", "173 m²"), ("Dormitorios", "6"), ("Baños", "3"), ("Estacionamientos", "4"), ("Antigüedad", "86 años"), ("Otra", "1 a 3")], {"price": 11900, "priceCurrency": "CLF"})
FLAT = page(["Departamentos", "Arriendo", "RM (Metropolitana)", "Macul"], [("Dormitorios", "2"), ("Baños", "2"), ("Superficie útil", "173"), ("Superficie total", "85"), ("Gastos comunes", "$ 90.000")], {"price": 450000, "priceCurrency": "CLP"}, centre="-35.675148,-71.54297")
PROJECT = page(["Departamentos", "Venta", "RM (Metropolitana)", "Providencia"], [("Superficie total", "21.5 m² a 239.48 m²"), ("Dormitorios", "1 a 3")], {"price": 6471, "priceCurrency": "CLF"}, extra='<script id="__NORDIC_RENDERING_CTX__" nonce="x">_n.ctx.r={"appProps": {"a": [{"type": "price", "price": {"value": 6471, "currency_id": "CLF"}}, {"type": "header", "title": {"text": "Proyecto"}}]}};more</script>')


def records(spark):
    pages = spark.createDataFrame([("house", HOUSE), ("flat", FLAT), ("project", PROJECT), ("empty", ""), ("null", None)], "page_id string, html string")
    return {r["page_id"]: r for r in extract.assemble(extract.extract_listing(pages), F.lit(40000.0)).collect()}


def test_records(spark):
    got = records(spark)
    house, flat, project = got["house"], got["flat"], got["project"]
    assert (house.operacion, house.tipo, house.comuna, house.barrio) == ("venta", "casa", "nunoa", "Plaza")
    assert (house.m2_util, house.m2_total, house.dormitorios, house.banos, house.estacionamientos) == (173.0, 458.0, 6, 3, 4)
    assert (house.precio_moneda, house.precio_valor, house.precio_uf, house.precio_clp) == ("UF", 11900.0, 11900.0, 476_000_000.0)
    assert (house.lat, house.lon, house.advertencias, house.titulo, house.ano_construccion) == (-33.456, -70.598, [], "Casa & jardín", 1940)
    assert (house.id_aviso, house.direccion, house.fuente) == ("123456", "Calle 1, Ñuñoa, RM (Metropolitana)", "html")
    assert (flat.operacion, flat.tipo, flat.comuna, flat.precio_clp, flat.gastos_comunes_clp) == ("arriendo", "departamento", "macul", 450000.0, 90000.0)
    assert (flat.m2_util, flat.m2_total, flat.lat, flat.lon) == (173.0, None, None, None)
    assert {"m2_util above m2_total", "coordinates out of range"} <= set(flat.advertencias)
    assert (project.m2_total, project.dormitorios, project.precio_valor, project.es_proyecto, project.fuera_de_cobertura) == (None, None, 6471.0, 1, True)
    assert (project.titulo, project.fuente, project.comuna) == ("Proyecto", "json_render", "Providencia")
    assert got["empty"].precio_valor is None and got["null"].html is None


def test_fetch_outcome(spark):
    rows = [("ok", 200, "<th" + "x" * 60000), ("challenge", 200, "<th"), ("challenge", 200, "x" * 300000), ("bloqueado", 403, ""), ("no_existe", 404, None), ("error_http", 500, ""), ("red", None, None)]
    df = spark.createDataFrame(rows, "want string, status_code int, html string")
    assert all(r.want == r.outcome for r in extract.fetch_outcome(df).collect())


def test_published_and_cards(spark):
    df = spark.createDataFrame([("Publicado hace 3 meses",), ("Publicado hace 2 años",), ("hoy",)], "t string")
    days, _ = extract.published_ago(F.col("t"), F.lit("2026-01-31").cast("date"))
    assert [r[0] for r in df.select(days).collect()] == [90, 730, None]
    cards = spark.createDataFrame([(["Monoambiente", "1 baño", "28 m² útiles"],), (["3 dormitorios", "2 baños"],), ([],)], "a array<string>")
    got = [tuple(r) for r in cards.select(extract.card_attributes(F.col("a")).alias("r")).select("r.*").collect()]
    assert got == [(0, 1, 28.0), (3, 2, None), (None, None, None)]
    assert spark.createDataFrame([("A, Barrio, Macul",), ("solo",)], "t string").select(extract.neighbourhood_of(F.col("t"))).collect()[0][0] == "Barrio"
