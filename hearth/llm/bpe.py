"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match over a byte trie proposes tokens for many words at once.  A proposal is the BPE
encoding if each token encodes to itself and no merge crosses any boundary between neighbours; a vectorised
check walks the two tokens' sides along that boundary in the order of merges.  Only words that fail are
merged exactly.  Results are those of the tokenizers library for the same file (special tokens' strings
stand for their ids, as by default).

Words' encodings are kept while a task runs, up to ``CACHE_WORDS`` of them.  Null and empty texts give no
ids; ids outside the vocabulary decode to nothing; null ids decode to the empty text.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.textbatch import chunks, column, few_rows, ragged

CACHE_WORDS = 400_000
#: The pre-tokenizer of this kind of vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(PATTERN)
#: A space with white space on both sides may not be cut at: what follows it decides where the run ends.
_UNSAFE = re.compile(r"\s \s")
NEVER = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The visible letter that vocabulary files write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]

#: Bytes of a word beyond which nothing is proposed for it: it is merged exactly.
LONG = 2048


class Vocabulary:
    """Tables of one vocabulary file, all of them arrays indexed by token id or sorted for binary search."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        ids = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        raw = [b""] * self.size
        for word, i in ids.items():
            raw[i] = bytes(to_byte[c] for c in word)
        spoken = [*raw]
        for word, i in self.special.items():
            spoken[i] = word.encode()
        self.text, self.text_at = self._packed(spoken)
        self.byte_id = np.array([ids[c] for c in letters])
        self.merge: dict[int, tuple[int, int]] = {}
        self.rank = np.full(self.size, -1, np.int32)
        self.parts = np.tile(np.arange(self.size, dtype=np.int64)[:, None], (1, 2))
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, made = ids[a], ids[b], ids[a + b]
            self.merge.setdefault(x * self.size + y, (rank, made))
            if self.rank[made] < 0:
                self.rank[made], self.parts[made] = rank, (x, y)
        self.pair = np.array(sorted(self.merge), np.int64)
        self.pair_rank = np.array([self.merge[k][0] for k in self.pair.tolist()], np.int32)
        self.rank_of = {k: r for k, (r, _) in self.merge.items()}
        self.made_at = {r: made for r, made in self.merge.values()}
        self.byte_ids = self.byte_id.tolist()
        self.right, self.right_until = self._side(1)
        self.left, self.left_until = self._side(0)
        self._trie(raw)
        made = np.flatnonzero(self.rank >= 0)
        good = np.ones(self.size, bool)
        good[made] = ~self.crossed(self.parts[made, 0], self.parts[made, 1], inner=True)
        for i in made[np.argsort(self.rank[made])].tolist():
            good[i] &= good[self.parts[i, 0]] & good[self.parts[i, 1]]
        self.whole = good  # tokens that encode to themselves

    @staticmethod
    def _packed(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(items), np.uint8), np.append(0, np.cumsum([len(x) for x in items]))

    def _side(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """For each token the tokens that lie at one of its ends as it is built, first the byte, and the merge that ends each one's time."""
        rows = [np.arange(self.size)]
        while (self.rank[rows[-1]] >= 0).any():
            rows.append(self.parts[rows[-1], part])
        down = np.stack(rows, 1)  # from the token to its byte, which repeats
        depth = (self.rank[down] >= 0).sum(1)
        up = np.maximum(depth[:, None] - np.arange(down.shape[1]), 0)
        nodes = np.take_along_axis(down, up, 1)
        until = np.full(nodes.shape, NEVER, np.int32)
        until[:, :-1] = np.where(np.arange(1, nodes.shape[1]) <= depth[:, None], self.rank[nodes[:, 1:]], NEVER)
        return nodes, until

    def _trie(self, raw: list[bytes]) -> None:
        """Edges as sorted keys node * 256 + byte; nodes are numbered so that the root is 0."""
        nodes: dict[bytes, int] = {b"": 0}
        for word in raw:
            for k in range(1, len(word) + 1):
                nodes.setdefault(word[:k], len(nodes))
        edges = sorted((nodes[p[:-1]] * 256 + p[-1], n) for p, n in nodes.items() if p)
        self.edge = np.array([e for e, _ in edges], np.int64)
        self.edge_to = np.array([n for _, n in edges], np.int64)
        self.accept = np.full(len(nodes), -1, np.int64)
        for i, word in enumerate(raw):
            if word:
                self.accept[nodes[word]] = i

    def merges(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank at which neighbours merge, NEVER if they don't."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], NEVER)

    def crossed(self, a: np.ndarray, b: np.ndarray, inner: bool = False) -> np.ndarray:
        """Whether some merge joins parts of neighbours a and b before both are complete; unless inner, also after.

        The ends that face each other change only when a merge inside a or b ends one's time.  Merges of equal
        rank run from left to right, so one inside a goes before one across, and that before one inside b.
        """
        n = len(a)
        out = np.zeros(n, bool)
        i, j, live = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
        while len(live):
            x, y = a[live], b[live]
            until_a, until_b = self.right_until[x, i[live]], self.left_until[y, j[live]]
            rank = self.merges(self.right[x, i[live]], self.left[y, j[live]])
            last = (until_a == NEVER) & (until_b == NEVER)
            hit = (rank < until_a) & (rank <= until_b) & (rank < NEVER) & ~(last & inner)
            out[live[hit]] = True
            on = ~hit & ~last
            first = until_a[on] <= until_b[on]
            live = live[on]
            i[live[first]] += 1
            j[live[~first]] += 1
        return out

    def propose(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match over many words: ids end to end and each word's first (one more than words)."""
        word = np.arange(len(start))
        at, node = start.copy(), np.zeros(len(start), np.int64)
        best, best_end = np.zeros(len(start), np.int64), start.copy()
        got: list[tuple[np.ndarray, np.ndarray]] = []
        live = word[end > start]
        while len(live):
            key = node[live] * 256 + data[np.minimum(at[live], end[live] - 1)]
            k = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            on = (at[live] < end[live]) & (self.edge[k] == key)
            up = live[on]
            node[up] = self.edge_to[k[on]]
            at[up] += 1
            found = self.accept[node[up]]
            hit = up[found >= 0]
            best[hit], best_end[hit] = found[found >= 0], at[hit]
            stop = live[~on]
            got.append((stop, best[stop]))
            at[stop], node[stop] = best_end[stop], 0
            live = live[on | (best_end[live] < end[live])]
        if not got:
            return np.zeros(0, np.int64), np.zeros(len(start) + 1, np.int64)
        owner = np.concatenate([w for w, _ in got])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([t for _, t in got])[order], np.searchsorted(owner[order], np.arange(len(start) + 1))

    def exact(self, word: bytes) -> list[int]:
        """Merging in order of rank, leftmost first; long words over a linked list and a heap."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) <= 64:
            rank_of, n = self.rank_of.get, self.size
            ranks = [rank_of(x * n + y, NEVER) for x, y in zip(ids, ids[1:], strict=False)]
            while ranks and (best := min(ranks)) < NEVER:
                i = ranks.index(best)
                made = ids[i] = self.made_at[best]
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = rank_of(ids[i - 1] * n + made, NEVER)
                if i < len(ranks):
                    ranks[i] = rank_of(made * n + ids[i + 1], NEVER)
            return ids
        nxt, prev = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(m[0], i, m[1], x, y) for i, (x, y) in enumerate(zip(ids, ids[1:], strict=False)) if (m := self.merge.get(x * self.size + y))]
        heapq.heapify(heap)
        while heap:
            _, i, made, x, y = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = made, -1
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            for p, q in ((prev[i], i), (i, nxt[i])):
                if p >= 0 and q >= 0 and (m := self.merge.get(ids[p] * self.size + ids[q])):
                    heapq.heappush(heap, (m[0], p, m[1], ids[p], ids[q]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The BPE ids of each word, end to end, and each word's first (one more than words)."""
        size = np.array([len(w) for w in words])
        bad = size > LONG  # steps are as many as the longest word has bytes, so these are merged right away
        data = np.frombuffer(b"".join(w for w, b in zip(words, bad.tolist(), strict=True) if not b), np.uint8)
        size[bad] = 0
        ends = np.cumsum(size)
        ids, first = self.propose(data, ends - size, ends)
        owner = np.repeat(np.arange(len(words)), np.diff(first))
        bad[owner[~self.whole[ids]]] = True
        near = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[near] * self.size + ids[near + 1], return_inverse=True)
        bad[owner[near[self.crossed(pairs // self.size, pairs % self.size)[back]]]] = True
        if not bad.any():
            return ids, first
        redone = [self.exact(words[w]) for w in np.flatnonzero(bad).tolist()]
        sizes = np.array([len(r) for r in redone])
        start, size = first[:-1].copy(), np.diff(first)
        start[bad], size[bad] = len(ids) + np.cumsum(sizes) - sizes, sizes
        ends = np.cumsum(size)
        every = np.concatenate([ids, np.array([i for r in redone for i in r], np.int64)])
        return every[np.repeat(start - (ends - size), size) + np.arange(ends[-1])], np.append(0, ends)


class _Rows(dict):
    """Numbers keys as they are first asked for."""

    def __init__(self, base: list):
        self.new = base

    def __missing__(self, key):
        n = self[key] = len(self.new)
        self.new.append(key)
        return n


class Encoder:
    """Encodes texts by a vocabulary; keeps the encodings of up to CACHE_WORDS pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.special = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.clear()

    def clear(self) -> None:
        self.keys: list[str] = []  # pieces in order; _Rows share the numbering
        self.bare, self.spaced = _Rows(self.keys), _Rows(self.keys)
        self.is_spaced: list[bool] = []
        self.flat, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def pieces(self, text: str) -> list[int]:
        if _UNSAFE.search(text):
            return [self.bare[w] for w in _SPLIT.findall(text)]
        first, *rest = text.split(" ")
        return [*([self.bare[first]] if first else []), *map(self.spaced.__getitem__, rest)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the first of each (one more than texts)."""
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        rows: list[int] = []
        counts = []
        for text in texts:
            before = len(rows)
            if self.cut and self.cut.search(text):
                at = 0
                for m in self.cut.finditer(text):
                    rows += [*self.pieces(text[at : m.start()]), -1 - self.vocabulary.special[m[0]]]
                    at = m.end()
                text = text[at:]
            if text:
                rows += self.pieces(text)
            counts.append(len(rows) - before)
        self._learn()
        row = np.array(rows, np.int64)
        marks = np.flatnonzero(row < 0)
        if len(marks):  # special tokens stand beside the pieces
            flat = np.concatenate([self.flat, -1 - row[marks]])
            at = np.append(self.at, self.at[-1] + np.arange(1, len(marks) + 1))
            row[marks] = len(self.at) - 1 + np.arange(len(marks))
        else:
            flat, at = self.flat, self.at
        ids, size = ragged(flat, at, row)
        ends = np.append(0, np.cumsum(size))
        return ids, ends[np.append(0, np.cumsum(counts, dtype=np.int64))]

    def _learn(self) -> None:
        known = len(self.at) - 1
        new = self.keys[known:]
        if not new:
            return
        spaced = self.spaced
        words = _Rows([])
        rows, counts = [], []
        for n, piece in enumerate(new, known):
            found = _SPLIT.findall(f" {piece}" if spaced.get(piece) == n else piece)
            rows += [words[w] for w in found]
            counts.append(len(found))
        ids, first = self.vocabulary.encode_words([w.encode() for w in words.new])
        got, size = ragged(ids, first, np.array(rows, np.int64))
        ends = np.append(0, np.cumsum(size))[np.cumsum(counts)]
        self.flat, self.at = np.concatenate([self.flat, got]), np.concatenate([self.at, self.at[-1] + ends])


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    return Encoder(Vocabulary(path))


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns keep) with ids, an array of int; an older column of this name goes."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "ids"]
    docs = few_rows(docs).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            col, flat, size = column(b, text_col), [], []
            for c in chunks(col, 1 << 19):
                ids, first = e.encode([t or "" for t in col.slice(c.lo, c.hi - c.lo).to_pylist()])
                flat.append(ids.astype(np.int32))
                size.append(np.diff(first))
            at = np.append(0, np.cumsum(np.concatenate(size))) if size else np.zeros(1, np.int64)
            made = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(flat) if flat else [], pa.int32()))
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in keep), made], [*keep, "ids"])

    types = "".join(f"`{c}` {t}, " for c, t in docs.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return docs.mapInArrow(run, f"{types}ids array<int>")


def decode(coded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """coded (or its columns keep) with the text that its ids stand for."""
    keep = [c for c in (coded.columns if keep is None else keep) if c != out]
    coded = few_rows(coded).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, ids_col])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = encoder(path).vocabulary
        for b in batches:
            texts = []
            col = column(b, ids_col)
            for lo in range(0, len(col), 64):
                part = col.slice(lo, 64)
                ids = np.asarray(pc.fill_null(part.flatten(), -1), np.int64)
                size = np.asarray(pc.fill_null(pc.list_value_length(part), 0), np.int64)
                known = (ids >= 0) & (ids < v.size)
                width = np.zeros(len(ids), np.int64)
                data, width[known] = ragged(v.text, v.text_at, ids[known])
                cut = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(size))]
                raw = data.tobytes()
                texts += [raw[s:e].decode("utf-8", "replace") for s, e in zip(cut.tolist(), cut[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in keep), pa.array(texts, pa.string())], [*keep, out])

    types = "".join(f"`{c}` {t}, " for c, t in coded.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return coded.mapInArrow(run, f"{types}`{out}` string")
