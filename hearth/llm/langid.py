"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts the character pairs and triples of every labelled text in hashed buckets, one aggregation
over (language, bucket).  ``predict`` broadcasts the log-probability matrix (its size is bounded by
``MATRIX_CELLS`` whatever the input) and scores batches of texts in numpy, each text whole.

Defined results: a text that is null or has no letter gives language ``und`` and score 0.0; so does every
text if nothing was learnt (no labelled row).  Ties go to the language that sorts first.  Rows that repeat
are learnt as often as they occur and get equal predictions.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.textbatch import chunks, column, few_rows

ORDERS = (2, 3)
BITS = 16
#: So many languages in one matrix at most, which bounds what is broadcast; more are learnt and scored in blocks.
MOST_LANGUAGES = 256


class Model(NamedTuple):
    languages: list[str]
    log_prob: np.ndarray  # languages x buckets
    log_prior: np.ndarray
    bits: int
    others: tuple = ()  # models of further languages


@functools.cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of the texts end to end, each text within line ends, and the first of each."""
    framed = [f"\n{t.lower()}\n" for t in texts]
    offsets = np.zeros(len(framed) + 1, np.int64)
    np.cumsum([len(t) for t in framed], out=offsets[1:])
    return np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def grams(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each code point, as far as it fits."""
    n = max(0, len(points) - order + 1)
    h = np.full(n, order, np.uint32)
    for k in range(order):
        h = (h ^ points[k : k + n]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def text_runs(col: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of at most limit bytes, or one longer text, with the first row of each."""
    for c in chunks(col, limit):
        yield c.lo, [t or "" for t in col.slice(c.lo, c.hi - c.lo).to_pylist()]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BITS, most: int = MOST_LANGUAGES) -> Model:
    """Learns from every row whose language is not null. More than `most` languages are learnt in blocks of so many, a pass over the rows for each."""
    known = few_rows(docs).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull())
    priors = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    every, whole = sorted(priors), sum(priors.values())
    if len(every) <= most:
        return _fit(known, every, priors, whole, bits)
    parts = [every[lo : lo + most] for lo in range(0, len(every), most)]
    first, *others = (_fit(known.where(F.col("lang").between(p[0], p[-1])), p, priors, whole, bits) for p in parts)
    return first._replace(others=tuple(others))


def _fit(known: DataFrame, languages: list[str], priors: dict[str, int], whole: int, bits: int) -> Model:
    """Learns some languages; known holds rows of these alone, whole is the number of rows of all languages."""
    index = {x: i for i, x in enumerate(languages)}
    slots = max(1, len(languages))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((slots, 1 << bits), np.int64)
        for b in batches:
            which = column(b, "lang").to_pylist()
            for lo, texts in text_runs(column(b, "text")):
                points, offsets = code_points(texts)
                lang = np.repeat([index[x] for x in which[lo : lo + len(texts)]], np.diff(offsets))
                for order in ORDERS:
                    ends = np.repeat(offsets[1:], np.diff(offsets))
                    g = grams(points, order, bits)
                    inside = np.arange(len(g)) + order <= ends[: len(g)]
                    seen += np.bincount((lang[: len(g)] << bits)[inside] + g[inside], minlength=slots << bits).reshape(slots, -1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen.ravel()[at])], ["cell", "n"])

    counts = np.ones((slots, 1 << bits))
    if languages:
        got = known.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        counts.ravel()[got["cell"].to_numpy()] += got["n"].to_numpy()
    prior = np.array([priors[x] for x in languages] or [1], float)
    return Model(languages, np.log(counts / counts.sum(1, keepdims=True)), np.log(prior / max(whole, 1)), bits)


def totals(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The log-probability of each language and text, and whether each text has a letter."""
    points, offsets = code_points(texts)
    total = np.tile(model.log_prior[:, None], (1, len(texts)))
    start, end = offsets[:-1], offsets[1:]
    for order in ORDERS:
        g = grams(points, order, model.bits)
        some = np.flatnonzero(end - start >= order)
        if len(g) and len(some):
            edges = np.stack([start[some], np.minimum(end[some] - order + 1, len(g))], 1).ravel()
            g = np.append(g, 0)  # so that the last edge lies inside
            for k, row in enumerate(model.log_prob):
                total[k, some] += np.add.reduceat(row[g], edges)[::2]
    return total, np.logical_or.reduceat(letters()[points], start) if len(texts) else np.zeros(0, bool)


def score_texts(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The best language of each text (-1: undetermined) and its posterior probability."""
    total, has_letter = totals(texts, model)
    best = total.argmax(0)
    score = 1 / np.exp(total - total.max(0)).sum(0)
    sure = has_letter & bool(model.languages)
    return np.where(sure, best, -1), np.where(sure, score, 0.0)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns keep) with lang_pred and score at the end; older columns of these names go."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    if model.others:
        return _predict_blocks(docs, model, text_col, keep)
    docs = few_rows(docs).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*shared.value.languages, "und"]
        for b in batches:
            best, score = [], []
            for _, texts in text_runs(column(b, text_col)):
                i, s = score_texts(texts, shared.value)
                best += [names[k] for k in i]
                score.append(s)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in keep), pa.array(best, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64())], [*keep, "lang_pred", "score"])

    types = ", ".join(f"`{c}` {t}" for c, t in docs.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return docs.mapInArrow(run, f"{types}, lang_pred string, score double")


def _predict_blocks(docs: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    """predict() with languages in blocks: each block's best language, its log-probability and the sum of the block's join in the end; of equal ones the first by name."""
    blocks = [model._replace(others=()), *model.others]
    rows = few_rows(docs).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias("text"), F.array().cast("array<struct<name:string,top:double,sum:double>>").alias("found"), F.lit(False).alias("sure"))
    kind = pa.list_(pa.struct([("name", pa.string()), ("top", pa.float64()), ("sum", pa.float64())]))
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(block)  # at most MOST_LANGUAGES languages

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names = shared.value.languages
            for b in batches:
                found, sure = column(b, "found").to_pylist(), []
                for lo, texts in text_runs(column(b, "text")):
                    total, has_letter = totals(texts, shared.value)
                    best, top = total.argmax(0), total.max(0)
                    for i, (k, t, s) in enumerate(zip(best.tolist(), top.tolist(), np.exp(total - top).sum(0).tolist(), strict=True)):
                        found[lo + i] = [*found[lo + i], {"name": names[k], "top": t, "sum": s}]
                    sure += has_letter.tolist()
                new = {"found": pa.array(found, kind), "sure": pa.array(sure, pa.bool_())}
                yield pa.RecordBatch.from_arrays([new.get(n, column(b, n)) for n in b.schema.names], b.schema.names)

        rows = rows.mapInArrow(run, rows.schema)
    best = F.element_at(F.array_sort(F.transform("found", lambda f: F.struct((-f["top"]).alias("minus"), f["name"].alias("name")))), 1)
    rows = rows.withColumn("best", best)
    every = F.aggregate("found", F.lit(0.0), lambda s, f: s + f["sum"] * F.exp(f["top"] + F.col("best.minus")))
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.when(F.col("sure"), F.col("best.name")).otherwise("und").alias("lang_pred"), F.when(F.col("sure"), 1 / every).otherwise(0.0).alias("score"))
