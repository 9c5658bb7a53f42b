"""Names of places, addresses and marked-up text."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Spellings of the covered communes (fixed values).
COVERED = {"nunoa": "nunoa", "macul": "macul", "la florida": "la-florida", "la-florida": "la-florida", "san miguel": "san-miguel", "san-miguel": "san-miguel"}


def plain(c: Column) -> Column:
    """Lower case without accents."""
    return F.trim(F.translate(F.lower(c), "áéíóúñüàèìòùâêîôûäëïöç", "aeiounuaeiouaeiouaeioc"))


def slug(c: Column) -> Column:
    """Lower case, accent-free, spaces and underscores as hyphens; null for no text."""
    return F.nullif(F.translate(F.trim(F.lower(c)), "áéíóúñü _", "aeiounu--"), F.lit(""))


def covered(c: Column) -> Column:
    """The slug of a covered commune, else null."""
    table = F.create_map(*[F.lit(x) for pair in COVERED.items() for x in pair])
    return F.try_element_at(table, plain(c))


def norm_address(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(c)), r"\s+", " ")


@F.pandas_udf(StringType())
def html_unescape(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Character references by name and number; the full table of names exists only in Python."""
    for s in texts:
        yield s.map(html.unescape, na_action="ignore")


def clean_text(c: Column) -> Column:
    """Text between tags, with references resolved where there are any."""
    bare = F.regexp_replace(c, "<[^>]+>", " ")
    return F.trim(html_unescape(bare))
