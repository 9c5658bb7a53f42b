"""Benchmark decontamination by generalised suffix automata of the test items.

A word is a run of ASCII letters and digits, A-Z as a-z, and all other non-ASCII characters.  Every item gets a window
length: `length` words, or ``ceil(coverage * words)`` where that is less and at least 1.  A word of a document is hit if it lies
in an occurrence of any window (so many consecutive words of the item); hit spans are removed.

Items are dealt into blocks of at most BLOCK_WORDS words, or one longer item; tasks build an automaton of each
block, which recognises every stretch of words of its items.  Over a block's automaton the documents' words are
streamed: state and length of the longest match ending at each word; from the state, suffix links known beforehand
lead to the windows that end there.  Only stretches whose every PIECE consecutive words occur in the block's items, told
by their hashes, are streamed; no occurrence of a window lies outside them.

Documents are read once for each block, with one automaton broadcast at a time; a benchmark of up to BLOCK_WORDS words takes one
pass and no shuffle.  With more blocks hits meet by row number, those of hit documents alone.
Words are 64-bit hashes (see textbatch).

Defined results: null texts have no words, null items no windows.  Rows of items that share an id count as one item
with the windows of all of them; items without an id hit words, but are not counted or listed.  Documents without an
id, repeated rows and other columns are of no account: each row is taken by itself, and only the kept columns are
returned.  Ids of items are ordered as texts.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.order import dense_index
from hearth.llm.scratch import stored
from hearth.llm.textbatch import Chunk, Words, chunks, column, few_rows, mix, powers, row_of, words

BLOCK_WORDS = 1 << 16
LENGTH = 10
#: A match of this share of an item counts, where it is shorter than LENGTH words.
COVERAGE = 1.0
#: Most words whose hash tells which stretches are streamed.
PIECE = 4
#: Bytes that part words.
APART = np.ones(256, bool)
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
SPANS = "array<struct<start:long,end:long,first:long,last:long>>"


def window_of(n: int, length: int, coverage: float) -> int:
    """Words of a window of an item of n words."""
    return min(length, max(1, math.ceil(coverage * n - 1e-9)))


class Automaton:
    """Of some items' words: transitions, suffix links, and the windows that end in each state.

    goes: (state << 32 | word) to state; ends: for each width, the state whose words of this width end a match, by state; owners: (state,
    width) to the places of items.
    """

    def __init__(self, items: list[tuple[str | None, np.ndarray]], length: int, coverage: float):
        self.names = sorted({i for i, _ in items if i is not None})
        place = {name: k for k, name in enumerate(self.names)}
        self.vocabulary, numbers = np.unique(np.concatenate([np.zeros(0, np.uint64), *(w for _, w in items)]), return_inverse=True)
        self.goes: dict[int, int] = {}
        link, longest, after = [-1], [0], [[]]  # after: the words that lead on from each state
        at, texts = 0, []
        for name, own in items:
            texts.append((name, numbers[at : at + len(own)].tolist()))
            at += len(own)
        for _, text in texts:
            last = 0
            for word in text:
                last = self._extend(last, word, link, longest, after)
        self.least = min((window_of(len(t), length, coverage) for _, t in texts if t), default=length)
        self.link, self.longest = link, longest
        widths = sorted({window_of(len(t), length, coverage) for _, t in texts if t})
        order = np.argsort(longest, kind="stable").tolist()
        self.ends: dict[int, list[int]] = {}
        for width in widths:
            up = [-1] * len(link)
            for s in order:
                if longest[s] >= width:
                    up[s] = s if longest[link[s]] < width else up[link[s]]
            self.ends[width] = up
        owners: dict[tuple[int, int], set[int]] = {}
        for name, text in texts:
            width, state = window_of(len(text), length, coverage), 0
            for k, word in enumerate(text):
                state = self.goes[state << 32 | word]
                if k + 1 >= width:
                    owners.setdefault((self.ends[width][state], width), set()).add(-1 if name is None else place[name])
        self.owners = {k: sorted(v) for k, v in owners.items()}
        piece = min(PIECE, self.least)
        grams = [piece_hashes(w, np.array([0, len(w)]), piece) for _, w in items if len(w) >= piece]
        self.piece, self.grams = piece, np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]))

    def _extend(self, last: int, word: int, link: list[int], longest: list[int], after: list[list[int]]) -> int:
        """The state of the item so far and one more word."""
        goes, key = self.goes, last << 32 | word
        there = goes.get(key)
        if there is not None and longest[there] == longest[last] + 1:
            return there

        def copied(state: int, size: int) -> int:
            new = len(link)
            link.append(link[state])
            longest.append(size)
            after.append(list(after[state]))
            for w in after[state]:
                goes[new << 32 | w] = goes[state << 32 | w]
            link[state] = new
            return new

        def turned(state: int, old: int, new: int) -> None:
            while state != -1 and goes.get(state << 32 | word) == old:
                goes[state << 32 | word] = new
                state = link[state]

        if there is not None:
            new = copied(there, longest[last] + 1)
            turned(last, there, new)
            return new
        new = len(link)
        link.append(0)
        longest.append(longest[last] + 1)
        after.append([])
        state = last
        while state != -1 and (state << 32 | word) not in goes:
            goes[state << 32 | word] = new
            after[state].append(word)
            state = link[state]
        if state != -1:
            there = goes[state << 32 | word]
            if longest[there] == longest[state] + 1:
                link[new] = there
            else:
                split = copied(there, longest[state] + 1)
                turned(state, there, split)
                link[new] = split
        return new

    def stream(self, text: list[int]) -> Iterator[tuple[int, int, int]]:
        """(end, width, state) of every window that occurs; text: numbers of words, -1 for others."""
        goes, link, longest, state, size = self.goes, self.link, self.longest, 0, 0
        widths = [(w, up) for w, up in self.ends.items()]
        for k, word in enumerate(text):
            while state and (state << 32 | word) not in goes:
                state = link[state]
                size = longest[state]
            state = goes.get(state << 32 | word, 0) if word >= 0 else 0
            size = size + 1 if state else 0
            for width, up in widths:
                if size < width:
                    break
                if (up[state], width) in self.owners:
                    yield k + 1, width, up[state]


def piece_hashes(h: np.ndarray, first: np.ndarray, piece: int) -> np.ndarray:
    """Hashes of the first, second... `piece` consecutive words; those across rows too."""
    n = max(0, len(h) - piece + 1)
    power, _ = powers(piece + 1)
    return mix(sum((h[j : j + n] * power[j + 1] for j in range(piece)), np.zeros(n, np.uint64)))


def among(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each value is in ordered, where)."""
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return (ordered[at] == values if len(ordered) else np.zeros(len(values), bool)), at


def hits(chunk: Chunk, auto: Automaton) -> tuple[Words, list[tuple[np.ndarray, np.ndarray, list[int]] | None]]:
    """The chunk's words and, of each row that is hit, first and one past the last word of each hit span, and its items' places."""
    w = words(chunk, APART)
    out: list[tuple[np.ndarray, np.ndarray, list[int]] | None] = [None] * (chunk.hi - chunk.lo)
    n, piece = len(w.hash), auto.piece
    if n < piece or not len(auto.grams):
        return w, out
    row = row_of(w.first)
    starts = np.flatnonzero(among(piece_hashes(w.hash, w.first, piece), auto.grams)[0])
    starts = starts[row[starts] == row[starts + piece - 1]]
    if not len(starts):
        return w, out
    breaks = np.flatnonzero((np.diff(starts) != 1) | (row[starts[1:]] != row[starts[:-1]]))
    los, his = starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)] + piece
    long = his - los >= auto.least
    found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
    for lo, hi in zip(los[long].tolist(), his[long].tolist(), strict=True):
        known, at = among(w.hash[lo:hi], auto.vocabulary)
        for end, width, state in auto.stream(np.where(known, at, -1).tolist()):
            spans, items = found.setdefault(int(row[lo]), ([], set()))
            spans.append((lo + end - width, lo + end))
            items.update(auto.owners[state, width])
    for r, (spans, items) in found.items():
        a, b = merged(np.array([s for s, _ in spans]), np.array([e for _, e in spans]))
        out[r] = a - w.first[r], b - w.first[r], sorted(items)
    return w, out


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans [a, b), as spans in order."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.append(True, a[1:] > b[:-1])
    return a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]


def automata(items: DataFrame, id_col: str, text_col: str, length: int, coverage: float) -> list[DataFrame]:
    """A stored table of one automaton a row, built in tasks: items are dealt into blocks in the order of hashes."""
    spark = items.sparkSession

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(column(batch, "text")):
                w = words(chunk, APART)
                own = [w.hash[w.first[r] : w.first[r + 1]].tobytes() for r in range(chunk.hi - chunk.lo)]
                yield pa.RecordBatch.from_arrays([column(batch, "item").slice(chunk.lo, chunk.hi - chunk.lo), pa.array(np.diff(w.first)), pa.array(own, pa.binary())], ["item", "n", "words"])

    texts = few_rows(items).select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    coded = stored(texts.mapInArrow(tokens, "item string, n long, words binary").where("n > 0"))
    total = coded.agg(F.sum("n")).first()[0] or 0
    if total <= BLOCK_WORDS:
        dealt = coded.withColumn("block", F.lit(0).cast("long"))
    else:  # items in any fixed order; one that begins in a block's span of words belongs to it
        placed = dense_index(coded, [F.xxhash64("item", "words"), F.col("item"), F.col("words"), F.col("n")], "place")
        slice_ = F.floor(F.col("place") / 1024)
        sums = placed.groupBy(slice_.alias("slice")).agg(F.sum("n").alias("m"))
        before = sums.select("slice", F.coalesce(F.sum("m").over(W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        within = F.sum("n").over(W.partitionBy("slice").orderBy("place")) - F.col("n")
        dealt = placed.withColumn("slice", slice_).join(before, "slice").withColumn("block", F.floor((F.col("before") + within) / BLOCK_WORDS))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = [(i, np.frombuffer(w, np.uint64)) for i, w in zip(group["item"], group["words"], strict=True)]
        return pd.DataFrame({"block": [key[0]], "automaton": [pickle.dumps(Automaton(own, length, coverage))]})

    return stored(dealt.select("item", "words", "block").groupBy("block").applyInPandas(build, "block long, automaton binary"))


def scan(docs: DataFrame, items: DataFrame, keep: list[str], text_col: str = "text", id_col: str = "item_id", item_col: str = "text", length: int = LENGTH, coverage: float = COVERAGE) -> DataFrame:
    """docs' kept columns, n_words, spans and items: the ids, as texts in order, of the items with a window in the text.

    Spans are the stretches of hit words in order: start and end as bytes of the text in UTF-8, first and last as word numbers; ends are exclusive.
    """
    spark = docs.sparkSession
    built = automata(items, id_col, item_col, length, coverage)
    blocks = [r["block"] for r in built.select("block").orderBy("block").collect()]

    def over(frame: DataFrame, block: int | None, names: list[str]) -> DataFrame:
        rows = [] if block is None else built.where(F.col("block") == block).select("automaton").collect()
        # at most BLOCK_WORDS words of items, or one item
        shared = spark.sparkContext.broadcast(pickle.loads(rows[0][0]) if rows else Automaton([], length, coverage))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = shared.value
            for batch in batches:
                for chunk in chunks(column(batch, "text_")):
                    w, found = hits(chunk, auto)
                    part = batch.slice(chunk.lo, chunk.hi - chunk.lo)
                    spans = []
                    for r, own in enumerate(found):
                        a, b = (own[0], own[1]) if own else (np.zeros(0, int), np.zeros(0, int))
                        lo, base = w.first[r], chunk.offsets[r]
                        spans.append([{"start": int(w.start[lo + x] - base), "end": int(w.end[lo + y - 1] - base), "first": int(x), "last": int(y)} for x, y in zip(a, b, strict=True)])
                    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "end", "first", "last")]))
                    ids = [[auto.names[k] for k in own[2] if k >= 0] if own else [] for own in found]
                    yield pa.RecordBatch.from_arrays([*(column(part, c) for c in names), pa.array(np.diff(w.first), pa.int64()), pa.array(spans, kind), pa.array(ids, pa.list_(pa.string()))], [*names, "n_words", "spans", "items"])

        types = "".join(f"`{c}` {t}, " for c, t in frame.select(*[F.col(f"`{c}`") for c in names]).dtypes)
        return frame.mapInArrow(run, f"{types}n_words long, spans {SPANS}, items array<string>")

    chosen = few_rows(docs).select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("text_"))
    if len(blocks) < 2:
        return over(chosen, blocks[0] if blocks else None, keep)
    numbered = stored(chosen.withColumn("row_", F.monotonically_increasing_id()))
    counted = over(numbered, None, [*keep, "row_"]).drop("spans", "items")
    parts = [stored(over(numbered.select("row_", "text_"), b, ["row_"]).where(F.size("spans") > 0)) for b in blocks]
    hit = parts[0]
    for p in parts[1:]:
        hit = hit.union(p)
    whole = hit.groupBy("row_").agg(F.flatten(F.collect_list("spans")).alias("all"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def joined(so_far, s):
        last = F.element_at(so_far, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"))
        touches = (F.size(so_far) > 0) & (s["first"] <= F.get(so_far, F.size(so_far) - 1)["last"])
        return F.when(touches, F.concat(F.slice(so_far, 1, F.size(so_far) - 1), F.array(longer))).otherwise(F.concat(so_far, F.array(s)))

    empty = F.expr(f"CAST(array() AS {SPANS})")
    one = whole.select("row_", F.aggregate(F.array_sort("all"), empty, joined).alias("spans"), "items")
    none = F.expr("CAST(array() AS array<string>)")
    return counted.join(one, "row_", "left").select(*[F.col(f"`{c}`") for c in keep], "n_words", F.coalesce("spans", empty).alias("spans"), F.coalesce("items", none).alias("items"))


def cleaned(scanned: DataFrame, text_col: str = "text", most: float = 1.0) -> DataFrame:
    """scanned (which kept the text) with hit spans cut out of the text; documents of which more than `most` of the words are hit go.

    Cutting leaves the spaces on both sides of a span. A null text stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, spans in zip(column(batch, text_col).to_pylist(), column(batch, "spans").to_pylist(), strict=True):
                if text is not None and spans:
                    data, at = text.encode(), 0
                    parts = []
                    for s in spans:
                        parts.append(data[at : s["start"]])
                        at = s["end"]
                    text = b"".join([*parts, data[at:]]).decode()
                made.append(text)
            k = batch.schema.get_field_index(text_col)
            yield batch.set_column(k, batch.schema.field(k).name, pa.array(made, pa.string()))

    share = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    left = few_rows(scanned).where(share <= most * F.col("n_words"))
    return left.mapInArrow(run, left.schema)
