"""Maximal periodic runs of words, by uniting suffix classes in order of falling common prefixes.

A run is a stretch of words with smallest period q, at least max(LEAST, 3 q) words long, that no neighbouring word
extends.  Where words s and s + q start a run, their suffixes share a prefix of L = length - q words.  Suffixes are
sorted, neighbours joined in order of falling common prefix L (Kruskal), and each class keeps its positions in
order.  When two classes unite at L, positions i < j that become neighbours in the united class at a distance
d <= L / 2 start a stretch of period d and d + L words; being neighbours, nothing in between repeats the words, so d
is its smallest period.  It is a run if the word before i differs from that before j.  Each run is found once, at its start.

Only stretches whose first 16 words recur in their document can seed a run (L >= 2 d and d + L >= 24 give L >= 16),
so documents without any 16 words twice are told by hashes of 16 words, and shorter common prefixes are not united.
Suffixes are sorted by doubling over all other documents of a chunk at once.  A task holds about 2**19 bytes of
text or one longer document, and some 8 * n * log2(longest repeat) bytes for the n words of its documents with
repeats.  Words are 64-bit hashes (see textbatch); case counts here.

Defined results: null and empty texts have no words and no run; the collapsed text is "" then.  Rows without an id,
repeated rows and other columns are of no account: each row is taken by itself, and only the kept columns are returned.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.textbatch import chunks, column, few_rows, mix, powers, ragged, words

LEAST = 24
#: Words that a seed's suffixes share at least.
SEED = 16


def recurring(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows in which some SEED consecutive words occur twice; h: the words' hashes, first: each row's first word and the end."""
    if len(h) <= SEED:
        return np.zeros(0, np.int64)
    power, inverse = powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[: len(h)], out=total[1:])
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(h) - SEED + 1)
    at = at[row[at] == row[at + SEED - 1]]
    gram = mix((total[at + SEED] - total[at]) * inverse[at]) ^ mix(row[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(gram)
    gram = gram[order]
    return np.unique(row[at[order[1:][gram[1:] == gram[:-1]]]])


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in order of their suffixes, common prefix of each with the next): positions that share SEED words with a neighbour at least.

    ids: word numbers in any order; no two suffixes may be equal to their end.
    """
    n = len(ids)
    rank = np.empty(n, np.int64)
    order = np.argsort(ids, kind="stable")
    new = np.append(True, ids[order][1:] != ids[order][:-1])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, open_ = [rank], order[~(new & np.append(new[1:], True))]
    deep = None
    width = 1
    while len(open_):
        if width == SEED:
            deep = open_
        rank = levels[-1]
        behind = np.minimum(open_ + width, n - 1)
        order = np.lexsort((rank[behind], rank[open_]))
        open_ = open_[order]
        group, key = rank[open_], rank[behind[order]]
        starts = np.append(True, group[1:] != group[:-1])
        new = starts | np.append(True, key[1:] != key[:-1])
        place = np.arange(len(open_))
        own = rank.copy()
        own[open_] = group + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(starts, place, 0))
        levels.append(own)
        open_ = open_[~(new & np.append(new[1:], True))]
        width *= 2
    if deep is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    deep = deep[np.argsort(levels[-1][deep])]
    left, right = deep[:-1].copy(), deep[1:].copy()
    common = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = (a < n) & (b < n)
        same = np.zeros(len(left), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        common[same] += 1 << k
    return deep, common


def unite(positions: np.ndarray, common: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run; common[k]: words that suffixes k and k + 1 share."""
    parent = list(range(len(positions)))
    ordered = [[p] for p in positions.tolist()]
    found = []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    edges = np.flatnonzero(common >= SEED)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    for k, shared in zip(edges.tolist(), common[edges].tolist(), strict=True):
        a, b = root(k), root(k + 1)
        if len(ordered[a]) < len(ordered[b]):
            a, b = b, a
        parent[b] = a
        large, small = ordered[a], ordered[b]
        ordered[b] = []
        if 16 * len(small) < len(large):
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        for p in small:
            at = bisect_left(large, p)
            for i, j in ((at - 1, at), (at, at + 1)):
                if i >= 0 and j < len(large):
                    i, j = large[i], large[j]
                    d = j - i
                    if 2 * d <= shared and d + shared >= LEAST and (i == 0 or ids[i - 1] != ids[j - 1]):
                        other = j if i == p else i
                        near = bisect_left(small, other)
                        if near == len(small) or small[near] != other:  # neighbours before are none that became so
                            found.append((i, d + shared, d))
    return found


def runs_of(hashes: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of each row that has any, by start and period; starts are word numbers within the row."""
    rows = recurring(hashes, first)
    if not len(rows):
        return {}
    sizes = first[rows + 1] - first[rows]
    begins = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(int((sizes + 1).sum()), bool)
    inside[begins + sizes] = False
    ids = np.empty(len(inside), np.int64)
    ids[inside] = np.unique(ragged(hashes, first, rows)[0], return_inverse=True)[1]
    ids[~inside] = len(hashes) + np.arange(len(rows))  # each row has an end of its own
    out: dict[int, list[tuple[int, int, int]]] = {}
    for start, length, period in sorted(unite(*suffixes(ids), ids)):
        k = int(np.searchsorted(begins, start, side="right")) - 1
        out.setdefault(int(rows[k]), []).append((start - int(begins[k]), length, period))
    return {r: sorted(found, key=lambda x: (x[0], x[2])) for r, found in out.items()}


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def find(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """docs' kept columns, n_words, runs (start, length, period; by start, then period) and collapsed: the words that stay, joined by one space."""
    chosen = few_rows(docs).select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("text_"))
    runs = "array<struct<start:long,length:long,period:long>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text_")
            for chunk in chunks(texts):
                w = words(chunk, fold=False)
                n = np.diff(w.first)
                found = runs_of(w.hash, w.first)
                collapsed = []
                for r in range(chunk.hi - chunk.lo):
                    own = chunk.data[chunk.offsets[r] : chunk.offsets[r + 1]].tobytes().split()
                    if r in found:
                        stays = kept(len(own), found[r])
                        own = [x for x, s in zip(own, stays.tolist(), strict=True) if s]
                    collapsed.append(b" ".join(own))
                each = [[{"start": s, "length": m, "period": q} for s, m, q in found.get(r, [])] for r in range(chunk.hi - chunk.lo)]
                part = batch.slice(chunk.lo, chunk.hi - chunk.lo)
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, c) for c in keep), pa.array(n, pa.int64()), pa.array(each, kind), pc.cast(pa.array(collapsed, pa.large_binary()), pa.large_string()).cast(pa.string())],
                    [*keep, "n_words", "runs", "collapsed"],
                )

    types = "".join(f"`{c}` {t}, " for c, t in chosen.dtypes[:-1])
    return chosen.mapInArrow(run, f"{types}n_words long, runs {runs}, collapsed string")
