"""Secret scan: keyword prefilter, anchored expressions near hits, checksum validation.

One pass of an Aho-Corasick automaton over a chunk of texts finds the keywords; only there an expression
is tried, anchored at the hit.  Runs of hexadecimal digits are found by a vectorised run search.  Tokens
that embed a CRC-32 (six base-62 digits after thirty characters) count only if it is right.

Kinds, in this order: ``assign`` (a keyword, an assignment sign and a value of 12 or more characters),
``access`` (AKIA..., 18 or more), ``hex`` (16 or more), ``github`` and ``npm`` (checksummed tokens).
Matches of one kind are leftmost and don't overlap; too short ones are dropped after that.  Spans are
counted in code points, end exclusive.  Null and empty texts have no spans; texts are scanned whole.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.textbatch import Chunk, chunks, column, few_rows

KINDS = ("assign", "access", "hex", "github", "npm")
SPAN_TYPE = "array<struct<kind: string, start: int, end: int>>"
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_SUMMED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True
#: Keyword (lower case) to the kind that is tried there.
KEYWORDS = {"password": 0, "passwd": 0, "secret": 0, "token": 0, "apikey": 0, "api_key": 0, "akia": 1, "ghp_": 3, "gho_": 3, "ghu_": 3, "ghs_": 3, "ghr_": 3, "npm_": 4}


@functools.cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def base62(n: int) -> bytes:
    out = b""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _DIGITS[d : d + 1] + out
    return out


def hex_runs(chunk: Chunk, least: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of lower-case hexadecimal digits within a row, of at least so many bytes."""
    hit = _HEX[chunk.data]
    edge = np.zeros(len(hit) + 1, bool)
    edge[1:-1] = hit[1:] != hit[:-1]
    edge[chunk.offsets] = True
    at = np.flatnonzero(edge)
    long = np.flatnonzero(np.diff(at) >= least)
    long = long[hit[at[long]]] if len(hit) else long
    return at[long], at[long + 1]


def spans_of(chunk: Chunk) -> list[list[tuple[int, int, int]]]:
    """For each row its (start, kind number, end) in code points, in order."""
    rows: list[list[tuple[int, int, int]]] = [[] for _ in range(chunk.hi - chunk.lo)]
    raw = chunk.data.tobytes()
    low = raw.lower()
    found = [(s, 2, e) for s, e in zip(*(x.tolist() for x in hex_runs(chunk)), strict=True)]
    hits = sorted((last + 1 - size, kind) for last, (size, kind) in automaton().iter(low.decode("latin-1")))
    ends = chunk.offsets[1:]
    done = [0] * len(KINDS)
    for start, kind in hits:
        if start < done[kind]:
            continue
        stop = int(ends[np.searchsorted(ends, start, side="right")])
        if kind == 0:
            m = _ASSIGN.match(low, start, stop)
            good = m and m.end(2) - m.start(2) >= 12
        elif kind == 1:
            m = _ACCESS.match(raw, start, stop)
            good = m and m.end() - start >= 18
        else:
            m = _SUMMED.match(raw, start, stop)
            good = m and base62(zlib.crc32(m[1])) == m[2]
        if m:
            done[kind] = m.end()
        if good:
            found.append((start, kind, m.end()))
    by_row: dict[int, list[tuple[int, int, int]]] = {}
    for s, kind, e in found:
        by_row.setdefault(int(np.searchsorted(ends, s, side="right")), []).append((s, kind, e))
    for r, got in by_row.items():
        lo, hi = int(chunk.offsets[r]), int(chunk.offsets[r + 1])
        points = np.append(0, np.cumsum((chunk.data[lo:hi] & 0xC0) != 0x80))
        rows[r] = sorted((int(points[s - lo]), kind, int(points[e - lo])) for s, kind, e in got)
    return rows


def _mapped(docs: DataFrame, text_col: str, keep: list[str], name: str, kind: str, make) -> DataFrame:
    wanted = few_rows(docs).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = column(b, text_col)
            made = [x for c in chunks(col) for x in make(c, col)]
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in keep), pa.array(made, _ARROW[kind])], [*keep, name])

    types = "".join(f"`{c}` {t}, " for c, t in wanted.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return wanted.mapInArrow(run, f"{types}`{name}` {kind}")


_ARROW = {SPAN_TYPE: pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])), "string": pa.string()}


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns keep) with a column spans; an older column of this name goes."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    return _mapped(docs, text_col, keep, "spans", SPAN_TYPE, lambda c, _: [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row] for row in spans_of(c)])


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """docs with every span in its text replaced by mask; overlapping spans count as one. Null stays null."""

    def clean(chunk: Chunk, col: pa.Array) -> Iterator[str | None]:
        for i, row in enumerate(spans_of(chunk)):
            text = col[chunk.lo + i].as_py()
            out, at = [], 0
            for s, _, e in row:
                if s >= at:
                    out += [text[at:s], mask]
                at = max(at, e)
            yield "".join([*out, text[at:]]) if row else text

    order = docs.columns
    return _mapped(docs, text_col, [c for c in order if c != text_col], text_col, "string", clean).select(*[F.col(f"`{c}`") for c in order])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
