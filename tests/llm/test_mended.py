"""Cases that once went wrong: many languages, long words and texts, licences, long conversations, clashing columns."""

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hearth.llm import bpe, chat, hmm, langid, licenses, media, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_more_languages_than_one_matrix(spark):
    """Blocks of languages give what one matrix gives."""
    rng = random.Random(3)
    words = {f"l{k:02d}": ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(9)] for k in range(11)}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randint(0, 12))), k, "s", 0) for i, k in enumerate(list(words) * 8)] + [(999, None, None, None, None), (1000, "123", None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    one, many = langid.fit(df), langid.fit(df, most=4)
    assert len(many.others) == 2 and not one.others
    told = lambda model: {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.predict(df, model).collect()}
    assert told(one) == told(many) and len(told(one)) == 90
    assert langid.predict(df, many).columns == langid.predict(df, one).columns


def test_long_words_are_fast(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(320_000)), "a" * 100_000, "ab" * 3000 + " short words " + "é" * 3000]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation(), tokenizer.no_padding()
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.ids for r in bpe.encode(df, path, keep=["doc_id"]).collect()}
    assert [got[i] for i in range(3)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    made = bpe.encode(df.limit(1), path, keep=["doc_id"])
    began = time.perf_counter()
    made.collect()
    assert time.perf_counter() - began < 15  # 27 s when every byte was a step of its own


def test_blocks_of_symbols():
    col = pa.array([b"x" * n for n in (10, 0, hmm.HELD * 2, hmm.HELD * 6, 4, 4)] + [None], pa.binary())
    spans = list(hmm.blocks(col))
    assert spans[0][0] == 0 and spans[-1][1] == len(col) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    size = np.array([10, 0, hmm.HELD * 2, hmm.HELD * 6, 4, 4, 0]) // 2
    assert all(size[lo:hi].sum() <= hmm.HELD or hi - lo == 1 for lo, hi in spans)


def test_licences_once_wrong(spark):
    cases = [
        ("BSD-3-Clause", "// Copyright 2009 The Go Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n\npackage x"),
        ("CC-BY-SA-4.0", "This text is licensed under Creative Commons Attribution-ShareAlike 4.0."), ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
        ("Unlicense", "This is free and unencumbered software released into the public domain.\n"), ("EPL-2.0", "/* This program and the accompanying materials are made available under the terms\n * of the Eclipse Public License 2.0 which is available at\n * https://www.eclipse.org/legal/epl-2.0/ */"),
        ("Proprietary", "Copyright 2020 Acme. All rights reserved."), ("MIT", "Copyright 2020 Acme. All rights reserved.\nReleased under the MIT License."), ("GPL-3.0", "# SPDX-License-Identifier: GPL-3.0-or-later\nCopyright 2001. All rights reserved."), (None, "a plain text"),
    ]
    df = spark.createDataFrame([(i, f"d{i}/f.txt", t) for i, (_, t) in enumerate(cases)], "id long, path string, text string").withColumn("own_license", F.lit("clash")).withColumn("unit", F.lit(1))
    got = {r.id: r.own_license for r in licenses.scan(df, "id").collect()}
    assert got == {i: want for i, (want, _) in enumerate(cases)}
    every = spark.createDataFrame([(i, f"d{i}/f.txt", n) for i, (_, n) in enumerate([*licenses.TEMPLATES, *licenses.HEADERS])], "id long, path string, text string")
    assert [r.own_license for r in licenses.scan(every, "id").orderBy("id").collect()] == [name for name, _ in [*licenses.TEMPLATES, *licenses.HEADERS]]


def test_long_conversations(spark):
    """One conversation over many ranges keeps its order; long texts, nulls and clashing columns are no fault."""
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"text {i} <|im_end|>\\") for i in range(3000)] + [(None, 1, None, None), (8, None, "assistant", "x" * 500_000), (8, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        made = {r.tree: r.conversation for r in chat.format_branches(chat.chain(df.withColumn("node", F.lit("clash")).withColumn("tree", F.lit(0)))).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert chat.read_turns(made[7]) == [(r, t) for _, _, r, t in rows[:3000]]
    assert chat.read_turns(made[8]) == [("assistant", "x" * 500_000), ("user", "")] and chat.read_turns(made[None]) == [("", "")]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, f"some words {i % 3} here", None, None, None) for i in range(40)], DOCS).withColumns({c: F.lit("clash") for c in ("score", "n_tokens", "media", "symbols", "token")})
    scored = hmm.train_and_score(df, F.col("doc_id") % 7 != 2, keep=["doc_id"])
    assert scored.count() == 40 and len(set(scored.columns)) == len(scored.columns)
    assert media.probe(media.store(df, keep=["doc_id"]), keep=["doc_id", "n_bytes"], digests=True).count() == 40


def test_top_k_in_small_blocks(spark, monkeypatch):
    """Several parts of queries and groups of candidates give what brute force gives; no plan gathers a block of vectors in one JVM value."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    v = np.random.default_rng(6).integers(-90, 90, (200, 12))
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(v)] + [(3, [500.0] * 12)] * 100  # of an id's vectors the smallest counts
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0, scale=1)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    want = {}
    for q in range(0, 200, 5):
        s = v @ v[q]
        for rank, j in enumerate(sorted((j for j in range(200) if j != q), key=lambda j: (-s[j], j))[:5], 1):
            want[q, rank] = (j, int(s[j]))
    assert got == want
