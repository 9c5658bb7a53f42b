"""Hidden Markov language model over words.

1. Words of the training texts are counted (one aggregation over the corpus; 64-bit hashes, see ``textbatch``).
   The most frequent ones, at most ``TOP``, become symbols of their own while the states are found; all others
   are known to the states by the class of their last byte, times their smoothed share of that class.
2. States start from a mixture of word distributions, fitted by EM over all training texts as wholes until a
   round gains less than ``GAIN`` a token (at most ``MIXTURE_ROUNDS``).  Then Baum-Welch runs over every
   training text.  Each task adds up expected counts, which are summed across tasks; long texts train in runs
   of ``RUN`` tokens, neighbours sharing one, so that every transition counts.
3. A last pass gathers each other word's expected count in each state (a table that grows with the corpus).  A word
   of count n that was in state s m times is emitted by s with its share of the class times (m + p) / ((n + 1) p),
   p the class's share of s: one pseudo-occurrence a word, and over a class these emissions add up to the class's own.
4. ``score`` computes the exact likelihood of each whole text by the scaled forward recursion.  Counts and states of
   the ``KNOWN`` most frequent words are broadcast; those of any other word join by the word.

A text's tokens are its words and one end.  Null and empty texts are one end; unseen words and texts have
finite scores; without training texts every symbol is equally likely.  Repeated rows are scored alike.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.scratch import dropped, stored
from hearth.llm.textbatch import Chunk, chunks, column, few_rows, row_of, words

STATES = 8
TOP = 65_000
KNOWN = 1 << 19
CLASSES = 256
ITERATIONS = 2
RUN = 1024
MIXTURE_ROUNDS = 25
#: Natural log-likelihood a token.
GAIN = 1e-3
#: Tokens of texts that the mixture handles at once (or one longer text).
BLOCK = 1 << 18
#: Symbols whose posteriors a task holds at once: some 150 MB with eight states.
HELD = 1 << 20
#: Weight, in tokens, of the corpus distribution in each state's emissions.
SMOOTHING = 20.0
SLICES = 64
#: The end's token; a constant beside the words' hashes.
END = np.uint64(0x0123456789ABCDEF)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Lexicon(NamedTuple):
    """Counts of the corpus. Symbols: the top words by index, then the classes, then the end."""

    token: np.ndarray  # known words' hashes, ascending
    count: np.ndarray
    symbol: np.ndarray  # -1: only its class
    n_top: int
    total: int  # tokens
    distinct: int
    end_count: int
    class_total: np.ndarray  # of the words that are no symbol
    class_distinct: np.ndarray
    symbol_total: np.ndarray


class Model(NamedTuple):
    lexicon: Lexicon
    start: np.ndarray  # states
    step: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states
    inside: np.ndarray  # classes x states: the share of each state in a class
    factor: np.ndarray  # known words x states: what a state makes of a word's share; 1 for symbols
    words: DataFrame  # token, cls, n, m0, m1, ...: words that are no symbols


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, cls, n) of all texts; cls is the last byte of the word, 256 for the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def merged() -> tuple[np.ndarray, ...]:
            t, c, n = (np.concatenate(x) for x in zip(*held, strict=True))
            u, at, back = np.unique(t, return_index=True, return_inverse=True)
            return u, c[at], np.bincount(back, n, len(u)).astype(np.int64)

        for b in batches:
            ends += b.num_rows
            for c in chunks(column(b, "text")):
                w = words(c)
                u, at, n = np.unique(w.hash, return_index=True, return_counts=True)
                held.append((u, _LOWER[c.data[w.end[at] - 1]] if len(u) else np.zeros(0, np.uint8), n))
                size += len(u)
            if size > 3_000_000:
                held[:] = [merged()]
                size = 0
        held.append((np.array([END]), np.array([CLASSES]), np.array([ends])))
        u, c, n = merged()
        for lo in range(0, len(u) if ends else 0, 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(u[part].view(np.int64)), pa.array(c[part], pa.int32()), pa.array(n[part])], ["token", "cls", "n"])

    made = texts.mapInArrow(run, "token long, cls int, n long")
    return made.groupBy("token").agg(F.min("cls").alias("cls"), F.sum("n").alias("n"))


def least_count(sizes: list[tuple[int, int]], most: int) -> int:
    """The smallest count so that at most so many words have it or more. sizes: (count, words)."""
    held, least = 0, 1 + max((n for n, _ in sizes), default=0)
    for n, k in sorted(sizes, reverse=True):
        held += k
        if held > most:
            break
        least = n
    return least


def lexicon(counts: DataFrame) -> Lexicon:
    """Sizes of the corpus and its most frequent words; what comes to the driver is bounded by KNOWN."""
    end = int(END.view(np.int64))
    plain = counts.where(F.col("token") != end)
    sizes = [(r["n"], r["k"]) for r in plain.groupBy("n").agg(F.count("*").alias("k")).collect()]
    ends = sum(r["n"] for r in counts.where(F.col("token") == end).collect())
    top, known = least_count(sizes, TOP), least_count(sizes, KNOWN)
    got = plain.where(F.col("n") >= known).select("token", "n").toArrow()
    token, count = got["token"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(token)
    token, count = token[order], count[order]
    symbol = np.where(count >= top, np.cumsum(count >= top) - 1, -1)
    total, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in plain.where(F.col("n") < top).groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        total[r["cls"]], distinct[r["cls"]] = r["n"], r["k"]
    n_all, v_all = sum(n * k for n, k in sizes) + ends, sum(k for _, k in sizes) + (ends > 0)
    return Lexicon(token, count, symbol, int((symbol >= 0).sum()), n_all, v_all, ends, total, distinct, np.concatenate([count[symbol >= 0], total, [ends]]))


class Coded(NamedTuple):
    symbols: np.ndarray  # of all texts, each with its end
    first: np.ndarray  # each text's first symbol (one more than texts)
    known: np.ndarray  # per text: tokens with a known count
    base: np.ndarray  # sum of log10(count + 1) over those
    share: np.ndarray  # sum of log10 of the shares of classes over those
    tail: np.ndarray  # for each word that is no symbol its place among the known words, -1 if not known
    tail_first: np.ndarray
    far: np.ndarray  # words without a known count
    far_class: np.ndarray
    far_first: np.ndarray


def encode(chunk: Chunk, lex: Lexicon) -> Coded:
    w = words(chunk)
    rows = chunk.hi - chunk.lo
    last = _LOWER[chunk.data[w.end - 1]].astype(np.int64) if len(w.hash) else np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(lex.token, w.hash), max(0, len(lex.token) - 1))
    hit = lex.token[at] == w.hash if len(lex.token) else np.zeros(len(w.hash), bool)
    count = np.where(hit, lex.count[at], 0) if len(lex.token) else np.zeros(len(w.hash), np.int64)
    symbol = np.where(hit, lex.symbol[at], -1) if len(lex.token) else np.full(len(w.hash), -1)
    owner = np.repeat(np.arange(rows), np.diff(w.first))
    middle = hit & (symbol < 0)
    sums = lambda which, x: np.bincount(owner[which], x[which], rows)
    base = sums(hit, np.log10(count + 1.0)) + np.log10(lex.end_count + 1.0)
    share = sums(middle, np.log10((count + 1.0) / (lex.class_total + lex.class_distinct + 1.0)[last]))
    known = np.bincount(owner[hit], minlength=rows) + (lex.end_count > 0)
    symbols = np.insert(np.where(symbol >= 0, symbol, lex.n_top + last), w.first[1:], lex.n_top + CLASSES)
    other = symbol < 0
    begins = lambda which: np.searchsorted(owner[which], np.arange(rows + 1))
    return Coded(symbols, w.first + np.arange(rows + 1), known, base, share, np.where(hit, at, -1)[other].astype(np.int32), begins(other), w.hash[~hit], last[~hit], begins(~hit))


def code(docs: DataFrame, lex: Lexicon, text_col: str, keep: list[str]) -> DataFrame:
    """keep, a row number, and what encode() tells of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    names = ["symbols", "n_tokens", "n_near", "base_near", "share_near", "tail", "far"]
    blobs = lambda flat, first: pa.array([p.tobytes() for p in np.split(flat, first[1:-1])], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(column(b, text_col)):
                x = encode(c, shared.value)
                rates = np.log10(shared.value.class_total + shared.value.class_distinct + 1.0)
                far_share = np.bincount(row_of(x.far_first), -rates[x.far_class], c.hi - c.lo)  # of words not known; score() adds the counts
                far = pa.ListArray.from_arrays(pa.array(x.far_first, pa.int32()), pa.array(x.far.view(np.int64), pa.int64()))
                made = [blobs(x.symbols.astype(np.uint16), x.first), pa.array(np.diff(x.first)), pa.array(x.known, pa.int64()), pa.array(x.base, pa.float64()), pa.array(x.share + far_share, pa.float64()), blobs(x.tail, x.tail_first), far]
                yield pa.RecordBatch.from_arrays([*(column(b, k).slice(c.lo, c.hi - c.lo) for k in keep), *made], [*keep, *names])

    types = "".join(f"`{c}` {t}, " for c, t in docs.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return docs.mapInArrow(run, f"{types}symbols binary, n_tokens long, n_near long, base_near double, share_near double, tail binary, far array<long>")


def lockstep(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All symbols step by step, the longest sequences first: symbols, each step's first, order, lengths in that order."""
    size = np.array([len(s) for s in sequences])
    order = np.argsort(-size, kind="stable")
    size = size[order]
    width = np.searchsorted(-size, -np.arange(size[0]), side="left")  # sequences longer than t
    at = np.append(0, np.cumsum(width))
    flat = np.concatenate([sequences[i] for i in order]).astype(np.int64)
    step = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = np.empty(len(flat), np.int64)
    out[at[step] + np.repeat(np.arange(len(size)), size)] = flat
    return out, at, order, size


def placed(flat: np.ndarray, sequences: list[np.ndarray], at: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Where lockstep() puts the symbols at these places of all sequences end to end."""
    first = np.append(0, np.cumsum([len(s) for s in sequences]))
    owner = np.searchsorted(first, flat, "right") - 1
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return at[flat - first[owner]] + rank[owner]


def forward(sequences: list[np.ndarray], start: np.ndarray, step: np.ndarray, emit: np.ndarray, special: np.ndarray | None = None, factor: np.ndarray | None = None) -> np.ndarray:
    """The natural log-likelihood of each sequence; emissions at the special places (of all sequences end to end) times factor."""
    symbols, at, order, size = lockstep(sequences)
    if special is not None:
        where = placed(special, sequences, at, order)
        by = np.argsort(where)
        where, factor = where[by], factor[by]
        cut = np.searchsorted(where, at)
    total = np.zeros(len(size))
    alpha = np.broadcast_to(start, (len(size), len(start)))
    for t in range(len(at) - 1):
        n = at[t + 1] - at[t]
        alpha = (alpha if t == 0 else alpha[:n] @ step) * emit[symbols[at[t] : at[t + 1]]]
        if special is not None and cut[t] < cut[t + 1]:
            alpha[where[cut[t] : cut[t + 1]] - at[t]] *= factor[cut[t] : cut[t + 1]]
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(size))
    out[order] = total
    return out


def posteriors(sequences: list[np.ndarray], heads: np.ndarray, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In lockstep: symbols, each step's first, order, the posterior of each state; and the expected steps."""
    symbols, at, order, size = lockstep(sequences)
    k = len(start)
    seen = emit[symbols]
    alpha = np.empty_like(seen)
    scale = np.empty(len(symbols), emit.dtype)
    idle = np.full(k, 1 / k, emit.dtype)
    before = np.where(heads[order][:, None], start, idle).astype(emit.dtype)
    for t in range(len(at) - 1):
        lo, hi = at[t], at[t + 1]
        a = (before if t == 0 else before[: hi - lo] @ step) * seen[lo:hi]
        s = a.sum(1)
        before = alpha[lo:hi] = a / s[:, None]
        scale[lo:hi] = s
    steps = np.zeros((k, k))
    beta = np.ones((0, k), emit.dtype)
    for t in range(len(at) - 2, -1, -1):
        lo, hi = at[t], at[t + 1]
        now = np.ones((hi - lo, k), emit.dtype)
        if len(beta):
            m = len(beta)
            after = beta * seen[hi : hi + m] / scale[hi : hi + m, None]
            steps += alpha[lo : lo + m].T @ after
            now[:m] = after @ step.T
        beta = now
        alpha[lo:hi] *= now  # the posterior of each state
    return symbols, at, order, alpha, steps * step


def expected(sequences: list[np.ndarray], heads: np.ndarray, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts: starts (of heads only, true beginnings), steps, emissions (but for the first symbol of other runs, the last of the run before)."""
    symbols, at, order, alpha, steps = posteriors(sequences, heads, start, step, emit)
    alpha[: at[1]][~heads[order]] = 0
    emissions = np.stack([np.bincount(symbols, alpha[:, s], len(emit)) for s in range(len(start))], 1)
    return alpha[: at[1]].sum(0, dtype=float), steps, emissions


def belonging(raw: list[bytes], share: np.ndarray, emit: np.ndarray) -> Iterator[list[np.ndarray]]:
    """The mixture's expected counts of some texts: texts and symbols of each state, log-likelihood."""
    size = np.array([len(r) // 2 for r in raw])
    cut = np.append(np.flatnonzero(np.diff(np.cumsum(size) // BLOCK, prepend=0)), len(raw))
    log_emit = np.log(emit)
    for lo, hi in itertools.pairwise(np.unique(np.append(0, cut))):
        flat = np.frombuffer(b"".join(raw[lo:hi]), np.uint16).astype(np.int64)
        fit = np.log(share) + np.add.reduceat(log_emit[flat], np.cumsum(size[lo:hi]) - size[lo:hi], axis=0, dtype=float)
        top = fit.max(1, keepdims=True)
        post = np.exp(fit - top)
        total = post.sum(1, keepdims=True)
        post /= total
        owner = np.repeat(np.arange(hi - lo), size[lo:hi])
        yield [post.sum(0), np.stack([np.bincount(flat, post[owner, s], len(emit)) for s in range(len(share))], 1), (top + np.log(total)).sum(keepdims=True).ravel()]


def mixture(coded: DataFrame, lex: Lexicon, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares and symbol distributions of a mixture fitted to all coded texts. Symbols, not texts, make the first states differ, so that more texts don't level them."""
    corpus = lex.symbol_total + 0.5
    corpus = corpus / corpus.sum()
    share, emit = np.full(states, 1 / states), corpus[:, None] * np.random.default_rng(7).exponential(size=(len(corpus), states))
    emit /= emit.sum(0)
    before = -np.inf
    for _ in range(MIXTURE_ROUNDS):
        shared = coded.sparkSession.sparkContext.broadcast((share, emit))
        n, emissions, fit = summed(coded, [(states,), emit.shape, (1,)], lambda raw: belonging(raw, *shared.value))  # noqa: B023
        if not n.sum():
            return share, np.tile(corpus[:, None], (1, states))
        share = (n + 1) / (n.sum() + states)
        emit = emissions + SMOOTHING * corpus[:, None]
        emit /= emit.sum(0)
        now = fit[0] / emissions.sum()
        if now - before < GAIN:
            break
        before = now
    return share, emit


def runs(raw: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Texts' symbols in runs of at most RUN, each after the last symbol of the one before, and which runs begin a text."""
    out, heads = [], []
    for r in raw:
        s = np.frombuffer(r, np.uint16)
        out += [s[max(0, i - 1) : i + RUN] for i in range(0, len(s), RUN)]
        heads += [i == 0 for i in range(0, len(s), RUN)]
    return out, np.array(heads, bool)


def blocks(col: pa.Array, bytes_each: int = 2) -> Iterator[tuple[int, int]]:
    """Runs of rows (lo, hi) with at most HELD symbols together, or one longer text."""
    size = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False) // bytes_each
    ends = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + HELD, side="right")))
        yield lo, hi
        lo = hi


def summed(coded: DataFrame, shapes: list[tuple[int, ...]], counts: Callable[[list[bytes]], Iterator[list[np.ndarray]]]) -> list[np.ndarray]:
    """Tables of these shapes, added up over all coded texts. Each task sends tables of fixed size, summed slice by slice."""
    at = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])
    cells = int(at[-1])
    width = -(-cells // SLICES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(s) for s in shapes]
        for b in batches:
            col = column(b, "symbols")
            for lo, hi in blocks(col):
                for made in counts(col.slice(lo, hi - lo).to_pylist()):
                    for t, x in zip(total, made, strict=True):
                        t += x
        flat = np.zeros(width * SLICES)
        flat[:cells] = np.concatenate([t.ravel() for t in total])
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in np.split(flat, SLICES)], pa.binary())], ["slice", "sums"])

    def add(kind: type):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, total = None, np.zeros(width)
            for b in batches:
                for number, x in zip(column(b, "slice").to_pylist(), column(b, "sums"), strict=True):
                    total += np.frombuffer(x.as_buffer(), kind)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "sums"])

        return run

    parts = coded.select("symbols").mapInArrow(run, "slice int, sums binary").withColumn("some", F.spark_partition_id() % 32)
    parts = parts.groupBy("slice", "some").applyInArrow(add(np.float32), "slice int, sums binary")
    whole = parts.groupBy("slice").applyInArrow(add(np.float64), "slice int, sums binary").toArrow()
    flat = np.zeros((SLICES, width))
    for s, x in zip(whole["slice"].to_pylist(), whole["sums"].to_pylist(), strict=True):
        flat[s] = np.frombuffer(x)
    flat = flat.ravel()
    return [flat[lo:hi].reshape(s) for s, (lo, hi) in zip(shapes, itertools.pairwise(at), strict=True)]


def reestimate(coded: DataFrame, lex: Lexicon, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round of Baum-Welch over all coded texts."""
    shared = coded.sparkSession.sparkContext.broadcast((start.astype(np.float32), step.astype(np.float32), emit.astype(np.float32)))

    def counts(raw: list[bytes]) -> Iterator[list[np.ndarray]]:
        part, heads = runs(raw)
        if part:
            yield list(expected(part, heads, *shared.value))

    begins, steps, emissions = summed(coded, [start.shape, step.shape, emit.shape], counts)
    corpus = lex.symbol_total + 0.5
    begins, steps, emissions = begins + 1, steps + 1, emissions + SMOOTHING * (corpus / corpus.sum())[:, None]
    return begins / begins.sum(), steps / steps.sum(1, keepdims=True), emissions / emissions.sum(0)


def by_state(coded: DataFrame, lex: Lexicon, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> DataFrame:
    """(token, cls, n, m0, m1, ...): how often each word that is no symbol occurs, and how often in each state."""
    shared = coded.sparkSession.sparkContext.broadcast((lex.token, start.astype(np.float32), step.astype(np.float32), emit.astype(np.float32)))
    n_top, sums = lex.n_top, [f"m{s}" for s in range(len(start))]

    def merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        token, cls, post = (np.concatenate(x) for x in zip(*held, strict=True))
        token, first, back = np.unique(token, return_index=True, return_inverse=True)
        total = [np.bincount(back, x, len(token)).astype(np.float32) for x in post.T]
        columns = [pa.array(token.view(np.int64)), pa.array(cls[first], pa.int32()), pa.array(np.bincount(back, minlength=len(token)), pa.int64()), *map(pa.array, total)]
        whole = pa.RecordBatch.from_arrays(columns, ["token", "cls", "n", *sums])
        yield from (whole.slice(lo, 100_000) for lo in range(0, len(token), 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, *model = shared.value
        held, size = [], 0
        for b in (whole.slice(lo, hi - lo) for whole in batches for lo, hi in blocks(column(whole, "symbols"))):
            tail = np.frombuffer(b"".join(column(b, "tail").to_pylist()), np.int32)
            if not len(tail):
                continue
            hashes = np.empty(len(tail), np.uint64)
            hashes[tail >= 0] = token[tail[tail >= 0]]
            hashes[tail < 0] = column(b, "far").flatten().to_numpy().view(np.uint64)
            part, heads = runs(column(b, "symbols").to_pylist())
            _, at, order, alpha, _ = posteriors(part, heads, *model)
            flat = np.concatenate(part).astype(np.int64)
            first = np.cumsum([0, *(len(x) for x in part[:-1])])
            other = (flat >= n_top) & (flat < n_top + CLASSES)
            other[first[~heads]] = False
            held.append((hashes, (flat[other] - n_top).astype(np.int32), alpha[placed(np.flatnonzero(other), part, at, order)]))
            size += len(hashes)
            if size > 1_000_000:
                yield from merged(held)
                held, size = [], 0
        if held:
            yield from merged(held)

    made = coded.select("symbols", "tail", "far").mapInArrow(run, f"token long, cls int, n long, {', '.join(f'{m} float' for m in sums)}")
    return made.groupBy("token").agg(F.min("cls").alias("cls"), F.sum("n").alias("n"), *[F.sum(m).cast("float").alias(m) for m in sums])


def factors(cls: np.ndarray, n: np.ndarray, m: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """What each state makes of these words' shares of their classes."""
    p = inside[cls]
    return ((m + p) / ((n[:, None] + 1.0) * p)).astype(np.float32)


def fit(coded: DataFrame, lex: Lexicon, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Trains on all coded texts (a table made by code())."""
    start, emit = mixture(coded, lex, states)
    step = np.full((states, states), 0.05 / states) + 0.95 * np.eye(states)
    for _ in range(iterations):
        start, step, emit = reestimate(coded, lex, start, step, emit)
    table, sums = stored(by_state(coded, lex, start, step, emit)), [f"m{s}" for s in range(states)]
    inside = np.full((CLASSES, states), 1 / states)
    for r in table.groupBy("cls").agg(*[F.sum(m).alias(m) for m in sums]).collect():
        total = np.array(r[1:], float)
        inside[r["cls"]] = np.maximum(total / total.sum(), 1e-9)
    factor = np.ones((len(lex.token), states), np.float32)
    known = table.where(F.col("n") >= int(lex.count.min())).toArrow() if len(lex.token) else None
    if known is not None and known.num_rows:
        at = np.searchsorted(lex.token, known["token"].to_numpy().view(np.uint64))
        factor[at] = factors(known["cls"].to_numpy(), known["n"].to_numpy(), np.stack([known[m].to_numpy() for m in sums], 1), inside)
    return Model(lex, start, step, emit, inside, factor, table)


def score(coded: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep, n_tokens, n_known, train_tokens, base_score and score of each coded text."""
    lex, sums = model.lexicon, [f"m{s}" for s in range(len(model.start))]
    shared = coded.sparkSession.sparkContext.broadcast((model.start, model.step, model.emit, model.inside, model.factor))
    n_top = lex.n_top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, step, emit, inside, near = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            seqs = [np.frombuffer(x, np.uint16) for x in column(b, "symbols").to_pylist()]
            first = np.append(0, np.cumsum([len(s) for s in seqs]))
            flat = np.concatenate(seqs).astype(np.int64)
            special = np.flatnonzero((flat >= n_top) & (flat < n_top + CLASSES))
            tail = np.frombuffer(b"".join(column(b, "tail").to_pylist()), np.int32)
            factor = np.ones((len(tail), len(start)), np.float32)
            factor[tail >= 0] = near[tail[tail >= 0]]
            far = np.flatnonzero(tail < 0)
            far_first = np.searchsorted(special[far], first)
            met = column(b, "met")
            owner = np.repeat(np.arange(len(seqs)), pc.fill_null(pc.list_value_length(met), 0).to_numpy())
            each = met.flatten()
            get = lambda c: pc.struct_field(each, c).to_numpy()  # noqa: B023, E731
            n, at = get("n"), far[far_first[owner] + get("nth")]
            factor[at] = factors(flat[special[at]] - n_top, n, np.stack([get(m) for m in sums], 1), inside)
            gain = np.bincount(owner, np.log10(n + 1.0), len(seqs))
            fit = forward(seqs, start, step, emit, special, factor) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in plain), pa.array(fit, pa.float64()), pa.array(gain, pa.float64()), pa.array(np.bincount(owner, minlength=len(seqs)))], [*plain, "path", "gain_far", "n_far"])

    plain = [*keep, "n_tokens", "n_near", "base_near", "share_near"]
    words_ = coded.select("row", F.posexplode("far").alias("nth", "token")).join(model.words, "token")
    met = words_.groupBy("row").agg(F.collect_list(F.struct("nth", "n", *sums)).alias("met"))
    slim = coded.select(*[F.col(f"`{c}`") for c in plain], "row", "symbols", "tail").join(met, "row", "left").drop("row")
    types = ", ".join(f"`{c}` {t}" for c, t in slim.select(*[F.col(f"`{c}`") for c in plain]).dtypes)
    out = slim.mapInArrow(run, f"{types}, path double, gain_far double, n_far long")
    return out.select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens", (F.col("n_near") + F.col("n_far")).alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base_near") + F.col("gain_far") - F.col("n_tokens") * F.lit(float(np.log10(lex.total + lex.distinct + 1)))).alias("base_score"),
        (F.col("path") + F.col("share_near") + F.col("gain_far")).alias("score"),
    )


def train_and_score(docs: DataFrame, trains: Column, text_col: str = "text", keep: list[str] | None = None, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Learns from the rows where trains holds and scores all rows of docs."""
    keep = docs.columns if keep is None else keep
    docs = few_rows(docs).select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)], F.coalesce(trains, F.lit(False)).alias("trains"), F.col(f"`{text_col}`").alias("text"))
    own = [*(f"kept{i}" for i in range(len(keep))), "trains"]
    counts = stored(count_tokens(docs.where("trains").select("text")))
    lex = lexicon(counts)
    coded = stored(code(docs, lex, "text", own).withColumn("row", F.monotonically_increasing_id()))
    model = fit(coded.where("trains"), lex, states, iterations)
    out = stored(score(coded, model, own[:-1]))
    dropped(coded, counts, model.words)
    return out.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", "n_known", "train_tokens", "base_score", "score")
