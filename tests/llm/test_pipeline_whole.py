"""The whole pipeline against a brute-force version, on an empty table, and through the registered query."""

import random
import re
import struct
import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def by_hand(rows):
    """Texts by id that packing gets: documents with a language, the smallest id of each group of near copies, secrets masked."""
    told = {i: t for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    sets, group = {i: shingles(t) for i, t in told.items()}, {i: i for i in told}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in told:
        for j in told:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i: re.sub(r"token = \w{12,}", "[secret]", told[i]) for i in told if root(i) == i}


def test_whole_pipeline(spark, tmp_path):
    rng = random.Random(12)
    words = {"en": ["the", "house", "with", "garden", "near", "station", "sunny", "large"], "es": ["niño", "casa", "jardín", "grande", "señor", "mañana", "pequeño", "año"]}
    say = lambda k, n: " ".join(f"{rng.choice(words[k])} {rng.choice(words[k])}{rng.randint(0, 99)}" for _ in range(n))
    rows = [(i, say(k, rng.randint(20, 120)), k, "s", 1) for i, k in enumerate(["en", "es"] * 20)]
    rows += [(100 + i, t + " one more", k, "s", 1) for i, (_, t, k, *_) in enumerate(rows[:7])] + [(200, rows[3][1], "es", "s", 1), (300, None, "en", None, None), (301, "", None, None, 0), (302, "12 !! 3", "en", "s", 3)]
    rows += [(400, say("en", 30) + " token = " + "Q1w2E3r4T5y6U7 " + say("en", 5), "en", "s", 1), (500, say("en", 9000), "en", "s", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = __spark_entry__.queries()["pipeline"](spark, str(tmp_path)).collect()
    want = by_hand(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation(), tokenizer.no_padding()
    assert {p.doc_id for p in pieces} == set(want) and 400 in want and 500 in want and 200 not in want
    for i, text in want.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and {p.doc_tokens for p in own} == {len(ids)} == {sum(p.length for p in own)}
        for p in own:
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[p.start : p.start + p.length]))
    for s in {p.sequence_id for p in pieces}:
        own = sorted((p for p in pieces if p.sequence_id == s), key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and sum(p.length for p in own) <= 4096


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.isEmpty() and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(made.columns)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).withColumn("spans", F.lit("clash")).withColumn("score", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns and stage(spark, docs, str(tmp_path)).isEmpty()
