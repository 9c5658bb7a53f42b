"""The training-data pipeline over documents: language, near copies, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.order import dense_index
from hearth.llm import langid, ngram_join, packing, secret_scan
from hearth.llm.scratch import having_keys, stored, tidy
from hearth.llm.textbatch import table

#: No text of fewer letters than a word, and none whose best language is less likely than all others together.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that can be told; those without a letter, or in doubt, go. Without any label nothing is learnt and all stay.

    Null and empty texts have no letter. Repeated rows and rows without an id are judged like the others; an empty table stays empty.
    """
    model = langid.fit(docs)
    if not model.languages:
        return docs
    scored = langid.predict(docs, model)
    return scored.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


@tidy
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near copies; rows without an id stay.

    Where ids repeat, rows are told apart by their place in the order of id and text; of an id's equal texts one stays.
    """
    known = docs.where("doc_id IS NOT NULL")
    if not known.groupBy("doc_id").count().where("count > 1").isEmpty():
        order = [F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")), *[F.col(c) for c in docs.columns if c != "doc_id"]]
        placed = stored(dense_index(known, order, "place"))
        first = placed.groupBy("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")).agg(F.min("place").alias("place"))
        placed = stored(having_keys(placed, stored(first.select("place")), "place"))
        classes = ngram_join.join(placed, id_col="place")
        heads = stored(classes.where("doc_id = component_id").select(F.col("doc_id").alias("place")))
        return having_keys(placed, heads, "place").select(docs.columns).union(docs.where("doc_id IS NULL"))
    classes = ngram_join.join(docs)
    heads = stored(classes.where("doc_id = component_id").select("doc_id").distinct())
    kept = having_keys(docs, heads, "doc_id")
    return kept.select(docs.columns).union(docs.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, repeated rows and rows without an id too; secrets in its text are masked and n_chars follows. A null text stays null."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens; each id of each document lies in exactly one. Null and empty texts are their end; repeated rows are packed as often as they occur; no documents give no pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "lang", "source"])


STAGES = [("language", language), ("near_copies", near_copies), ("secrets", secrets), ("packing", packed)]

#: A trained classifier and an external tokenizer lie outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


@tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one keeps is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs) if number < len(STAGES) else docs
    return docs
