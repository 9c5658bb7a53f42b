"""Packing of tokenised documents into sequences of bounded length by column generation.

1. Every document's ids are cut into full sequences and one remainder.  The remainders' lengths, rounded
   up to a multiple of ``GRAIN``, form a histogram of at most ``length / GRAIN`` classes; only that comes to
   the driver.
2. A linear program over patterns (how many pieces of each class share a sequence) is solved by column
   generation: dual prices from the current basis, an unbounded-knapsack dynamic program to find the pattern
   of the best price, a simplex step to bring it in.
3. Pattern counts are rounded down and what is left is placed first-fit decreasing; that residue is bounded by
   the number of classes, whatever the input.
4. Within its class each piece gets a rank (counts of small groups, summed up, plus the place within the
   group) and so a place in one copy of one pattern.

Defined results: a null or empty text is its end id alone; repeated rows are packed as often as they occur, and
so are rows without an id; without documents there are no pieces; input columns named like one of the result's
are left out.  Ties within a class go by the kept columns and the piece's start.  A text's ids are held in memory
by one task, however long it is; its pieces spread.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from tokenizers import Tokenizer

from hearth.llm.scratch import stored, tidy
from hearth.llm.textbatch import Chunk, chunks, column, few_rows, ragged, row_of, words

LENGTH = 4096
GRAIN = 16
CACHE_WORDS = 500_000
NONE = np.uint32(0xFFFFFFFF)
OUT = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Words:
    """Ids of white-space separated words (ASCII in lower case), encoded by the tokenizers library when first met.

    Words are independent of each other for a tokenizer that drops white space and case.  They are known by
    64-bit hashes (see ``textbatch`` for collisions).  Texts that hold a control string of the tokenizer in any
    case are left to the library as wholes, since such strings match before case is dropped.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.control = [t.content.encode().lower() for t in added.values()]
        self.mark, self.between = next(((i, t.content) for i, t in added.items() if t.special and not t.normalized), (None, ""))
        self.clear()

    def clear(self) -> None:
        """names: sorted hashes; hits: chunks that held each; place: which of the encoded words each is; flat and at: their ids."""
        self.names, self.hits, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.flat, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keeps the half of the words that most chunks held; what is forgotten is encoded again when met."""
        keep = np.sort(np.argpartition(-self.hits, CACHE_WORDS // 2)[: CACHE_WORDS // 2])
        self.names, self.hits = self.names[keep], self.hits[keep] // 2
        self.flat, size = ragged(self.flat, self.at, self.place[keep])
        self.at, self.place = np.append(0, np.cumsum(size)), np.arange(len(keep))

    def learn(self, names: np.ndarray, words: list[str]) -> None:
        """Encodes new words (names ascending), many at once with a special token between them."""
        step = 500 if self.mark is not None else 1
        runs = [self.between.join(words[i : i + step]) for i in range(0, len(words), step)]
        ids = np.concatenate([np.array(x, np.uint32) for e in self.tokenizer.encode_batch(runs, add_special_tokens=False) for x in (e.ids, [NONE])])
        ends = np.flatnonzero((ids == NONE) | (ids == self.mark if self.mark is not None else False)) - np.arange(len(words))
        ids = ids[(ids != NONE) & (ids != self.mark if self.mark is not None else True)]
        to = np.searchsorted(self.names, names)
        self.names, self.hits = np.insert(self.names, to, names), np.insert(self.hits, to, 0)
        self.place = np.insert(self.place, to, len(self.at) - 1 + np.arange(len(words)))
        self.flat, self.at = np.concatenate([self.flat, ids]), np.concatenate([self.at, self.at[-1] + ends])

    def controlled(self, chunk: Chunk) -> np.ndarray:
        """Rows that hold a control string in any case."""
        raw = chunk.data.tobytes().lower()
        hits = [m.start() for c in self.control if c in raw for m in re.finditer(re.escape(c), raw)]
        return np.unique(np.searchsorted(chunk.offsets, np.array(hits, np.int64), side="right") - 1)

    def encode(self, chunk: Chunk, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, each with the end id, and the first of each (one more than rows)."""
        if len(self.names) > CACHE_WORDS:
            self.forget()
        w, whole = words(chunk), self.controlled(chunk)
        count = np.diff(w.first)
        name = w.hash
        if len(whole):
            count[whole] = 0
            name = name[~np.isin(row_of(w.first), whole)]
        order = np.argsort(name)
        fresh = np.flatnonzero(np.append(True, name[order[1:]] != name[order[:-1]])) if len(name) else order
        unique = name[order[fresh]]
        at = np.searchsorted(self.names, unique)
        new = self.names[np.minimum(at, len(self.names) - 1)] != unique if len(self.names) else np.ones(len(unique), bool)
        if new.any():
            start, stop = (x[~np.isin(row_of(w.first), whole)] if len(whole) else x for x in (w.start, w.end))
            shown = order[fresh[new]]
            self.learn(unique[new], [chunk.data[a:z].tobytes().lower().decode() for a, z in zip(start[shown].tolist(), stop[shown].tolist(), strict=True)])
            at = np.searchsorted(self.names, unique)
        self.hits[at] += 1
        rows = np.empty(len(name), np.int64)
        rows[order] = np.repeat(self.place[at], np.diff(np.append(fresh, len(name))))
        ids, size = ragged(self.flat, self.at, rows)
        cut = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(count))]
        if len(whole):
            parts = np.split(ids, cut[1:-1])
            for r in whole.tolist():
                parts[r] = np.array(self.tokenizer.encode(chunk.data[chunk.offsets[r] : chunk.offsets[r + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            ids, cut = np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts]))
        return np.insert(ids, cut[1:], end), cut + np.arange(len(cut))


@functools.lru_cache(2)
def vocabulary(path: str) -> Words:
    """One for each worker process and file; Spark's tasks are its threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(path)


def pieces(docs: DataFrame, path: str, end: int, length: int, text_col: str, keep: list[str]) -> DataFrame:
    """keep, start, length, ids_crc32, doc_tokens of each piece: full sequences and one remainder a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in batches:
            col = column(b, text_col)
            for c in chunks(col, 1 << 20):
                ids, first = v.encode(c, end)
                row, start, size, crc, total = [], [], [], [], []
                raw = ids.astype("<u4").tobytes()
                for r, (a, z) in enumerate(zip(first.tolist(), first[1:].tolist(), strict=False)):
                    for s in range(a, z, length):
                        e = min(s + length, z)
                        row.append(c.lo + r)
                        start.append(s - a)
                        size.append(e - s)
                        crc.append(zlib.crc32(raw[4 * s : 4 * e]))
                        total.append(z - a)
                taken = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([*(column(b, k).take(taken) for k in keep), *(pa.array(x, pa.int64()) for x in (start, size, crc, total))], [*keep, "start", "length", "ids_crc32", "doc_tokens"])

    types = "".join(f"`{c}` {t}, " for c, t in docs.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return docs.mapInArrow(run, f"{types}start long, length long, ids_crc32 long, doc_tokens long")


def best_pattern(price: np.ndarray, units: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of the highest price: an unbounded knapsack over room units."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    for u in range(1, room + 1):
        fits = np.flatnonzero(units <= u)
        if len(fits):
            worth = value[u - units[fits]] + price[fits]
            k = int(worth.argmax())
            value[u], last[u] = (worth[k], fits[k]) if worth[k] > value[u - 1] else (value[u - 1], -1)
    pattern, u = np.zeros(len(units), np.int64), room
    while u > 0:
        if last[u] < 0:
            u -= 1
        else:
            pattern[last[u]] += 1
            u -= int(units[last[u]])
    return float(value[room]), pattern


def solve(units: np.ndarray, demand: np.ndarray, room: int, most_steps: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and their fractional counts: least sequences that hold the demand of each class."""
    n = len(units)
    patterns = np.diag(room // units)  # the first basis: one class alone
    basis = patterns.T.astype(float)
    inverse = np.diag(1 / np.diag(basis))
    count = inverse @ demand
    least = units @ demand / room
    for step in range(most_steps):
        price = inverse.sum(0)
        worth, pattern = best_pattern(price, units, room)
        total = count.sum()
        if total - max(total / worth, least) < max(0.5, 1e-4 * total):  # both bound the optimum from below
            break
        way = inverse @ pattern
        up = way > 1e-9
        leave = int(np.where(up, count / np.where(up, way, 1), np.inf).argmin())
        much = count[leave] / way[leave]
        count = np.maximum(count - much * way, 0)
        count[leave] = much
        patterns[leave] = pattern
        row = inverse[leave] / way[leave]
        inverse -= np.outer(way, row)
        inverse[leave] = row
        if step % 256 == 255:  # against rounding
            inverse = np.linalg.inv(patterns.T.astype(float))
            count = np.maximum(inverse @ demand, 0)
    return patterns, count


def plan(units: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and whole counts that hold the demand exactly."""
    if not len(units):
        return np.zeros((0, 0), np.int64), np.zeros(0, np.int64)
    patterns, count = solve(units, demand.astype(float), room)
    whole = np.floor(count + 1e-9).astype(np.int64)
    got = patterns.T @ whole
    while (got > demand).any():  # rounding of the count itself
        k = int(np.flatnonzero((patterns[:, (got > demand)].sum(1) > 0) & (whole > 0))[0])
        whole[k] -= 1
        got = patterns.T @ whole
    left = demand - got
    bins: list[tuple[int, np.ndarray]] = []
    for k in np.argsort(-units, kind="stable"):
        for _ in range(int(left[k])):
            at = next((i for i, (free, _) in enumerate(bins) if free >= units[k]), None)
            if at is None:
                bins.append((room, np.zeros(len(units), np.int64)))
                at = len(bins) - 1
            bins[at][1][k] += 1
            bins[at] = (bins[at][0] - int(units[k]), bins[at][1])
    used = whole > 0
    every, number = np.unique(np.concatenate([patterns[used], *(p[None] for _, p in bins)]), axis=0, return_inverse=True) if used.any() or bins else (np.zeros((0, len(units)), np.int64), np.zeros(0, np.int64))
    return every, np.bincount(number.ravel(), np.append(whole[used], np.ones(len(bins))), len(every)).astype(np.int64)


def places(units: np.ndarray, patterns: np.ndarray, copies: np.ndarray) -> dict[int, tuple[np.ndarray, ...]]:
    """For each class: the first rank of each pattern that holds it, pieces in one copy, that pattern's first sequence, its order in the copy."""
    base = np.cumsum(copies) - copies
    out = {}
    for k, u in enumerate(units.tolist()):
        at = np.flatnonzero(patterns[:, k])
        each = patterns[at, k]
        ranks = np.cumsum(each * copies[at])
        out[u] = (np.append(0, ranks), each, base[at], np.full(len(at), k))
    return out


@tidy
def pack(docs: DataFrame, path: str, end: int = 2, length: int = LENGTH, text_col: str = "text", keep: list[str] | None = None, order: str | None = None) -> DataFrame:
    """keep (or all columns but the text), start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece.

    order: a column by which pieces of one class are ranked within their group.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text_col if keep is None else "", *OUT)]
    order = order or (keep[0] if keep else text_col)
    named = few_rows(docs).select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)], F.col(f"`{order}`").alias("rank_by"), F.col(f"`{text_col}`").alias("text"))
    own = [*(f"kept{i}" for i in range(len(keep))), "rank_by"]
    grain = max(1, min(GRAIN, length // 4))
    room = length // grain
    cut = pieces(named, path, end, length, "text", own).withColumn("units", F.ceil(F.col("length") / grain).cast("int")).withColumn("part", F.spark_partition_id())
    cut = stored(cut)
    groups = cut.groupBy("units", "part").agg(F.count("*").alias("n"))
    before = groups.withColumn("before", F.sum("n").over(W.partitionBy("units").orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("units", "part", F.coalesce("before", F.lit(0)).alias("before"))
    histogram = sorted((r["units"], r["n"]) for r in groups.groupBy("units").agg(F.sum("n").alias("n")).collect())
    units, demand = (np.array(x, np.int64) for x in zip(*histogram, strict=True)) if histogram else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    patterns, copies = plan(units, demand, max(room, int(units.max(initial=0))))
    shared = docs.sparkSession.sparkContext.broadcast(places(units, patterns, copies))

    ranked = cut.withColumn("place", F.row_number().over(W.partitionBy("units", "part").orderBy("rank_by", "start", *own)) - 1)
    ranked = ranked.join(before, ["units", "part"]).withColumn("rank", F.col("place") + F.col("before")).drop("place", "before", "part")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit, rank = (column(b, c).to_numpy(zero_copy_only=False) for c in ("units", "rank"))
            seq, seat = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
            for u in np.unique(unit).tolist():
                ranks, each, base, cls = shared.value[u]
                at = np.flatnonzero(unit == u)
                k = np.searchsorted(ranks, rank[at], side="right") - 1
                within = rank[at] - ranks[k]
                seq[at] = base[k] + within // each[k]
                seat[at] = cls[k] * (length + 1) + within % each[k]
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in names), pa.array(seq), pa.array(seat)], [*names, "sequence_id", "seat"])

    names = [*own[:-1], "start", "length", "ids_crc32", "doc_tokens"]
    types = ", ".join(f"`{c}` {t}" for c, t in ranked.select(names).dtypes)
    placed = ranked.mapInArrow(assign, f"{types}, sequence_id long, seat long")
    offset = F.sum("length").over(W.partitionBy("sequence_id").orderBy("seat").rowsBetween(W.unboundedPreceding, -1))
    return placed.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)], "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(offset, F.lit(0)).alias("offset"))
