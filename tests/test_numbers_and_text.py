"""Literal cases of numbers, money, ranges, names and URLs."""

import pytest
from pyspark.sql import functions as F

from hearth.functions import numbers, text
from hearth.operators import extract


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_numero(spark):
    cases = {"458 m²": 458, "1.234.567": 1234567, "1.234,56": 1234.56, "21.5 m²": 21.5, "$ 486.476.332": 486476332, "Inmediata": None, "1.234": 1234, "": None, "-33.457": -33457, "a 1.2345": 1.2345}
    assert column(spark, [*cases, None], numbers.numero) == [*cases.values(), None]
    assert column(spark, ["86 años", "x", None], numbers.entero) == [86, None, None]


def test_parse_number_strict(spark):
    assert column(spark, ["5.500", "350.000.000", "99,5", "21.5", "nada", None], numbers.parse_number_strict) == [5500, 350000000, 99.5, 215, None, None]
    assert column(spark, ["1 a 3", "1.200 pesos", None], numbers.extract_int) == [1, 1200, None]


def test_es_rango(spark):
    assert column(spark, ["21.5 m² a 239.48 m²", "85.4 - 239.48 m²", "1 a 3", "458 m²", "6", "86 años", None], numbers.es_rango) == [True] * 3 + [False] * 4


@pytest.mark.parametrize("value, unit, rate, want", [(100.0, "UF", 40000.0, (4000000.0, 100.0)), (400000.0, "CLP", 40000.0, (400000.0, 10.0)), (11900.0, "UF", None, (None, 11900.0)), (5.0, None, 1.0, (None, None))])
def test_prices(spark, value, unit, rate, want):
    df = spark.createDataFrame([(value, unit, rate)], "v double, u string, r double")
    assert tuple(df.select(*numbers.prices(F.col("v"), F.col("u"), F.col("r"))).first()) == want


def test_currency(spark):
    assert column(spark, ["CLF", "uf", "CLP", "USD", "", None], numbers.currency) == ["UF", "UF", "CLP", "CLP", None, None]


def test_nan_counts_as_missing(spark):
    assert column(spark, ["NaN", "Infinity", "1e3", "x"], numbers.as_double) == [None, None, 1000.0, None]


def test_communes(spark):
    assert column(spark, ["Ñuñoa", "nunoa", "La Florida", "San Miguel", "Macul", "Providencia", None], text.covered) == ["nunoa", "nunoa", "la-florida", "san-miguel", "macul", None, None]
    assert column(spark, ["Ñuñoa", " San_Miguel ", "", None], text.slug) == ["nunoa", "san-miguel", None, None]
    assert column(spark, ["  Calle  Uno\t2 "], text.norm_address) == ["calle uno 2"]
    assert column(spark, ["<b>a &amp; b</b> &ntilde;", None], text.clean_text) == ["a & b  ñ", None]


def test_urls(spark):
    cases = [
        ("https://casa.mercadolibre.cl/MLC-1234567890-casa-_JM#polycard_client=x", "ml", "1234567890", "https://casa.mercadolibre.cl/MLC-1234567890-casa-_JM", None),
        ("www.portalinmobiliario.com/MLC-3901245632-depto-_JM?a=1", "pi", "3901245632", "https://www.portalinmobiliario.com/MLC-3901245632-depto-_JM", None),
        ("https://www.portalinmobiliario.com/x?item_id=MLC3901245632", "pi", "3901245632", "https://www.portalinmobiliario.com/x", None),
        ("https://www.portalinmobiliario.com/propiedades/MLC-3901245632", None, None, None, "not_a_listing"),
        ("https://www.mercadolibre.cl/perfil/MLC-3901245632", None, None, None, "not_a_listing"),
        ("https://example.com/MLC-3901245632", None, None, None, "unknown_host"),
        ("https://www.mercadolibre.cl/casas", None, None, None, "no_id"),
        ("  ", None, None, None, "empty"), (None, None, None, None, "empty"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, url string")
    got = extract.canonical_url(df).orderBy("i").select("sitio", "id_aviso", "canonical", "url_error").collect()
    assert [tuple(r) for r in got] == [c[1:] for c in cases]
