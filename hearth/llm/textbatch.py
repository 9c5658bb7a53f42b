"""Arrow text batches as byte arrays: bounded chunks, word spans and 64-bit word hashes.

Everything here works on one Arrow batch inside a Spark task.  A word is a maximal run of bytes other
than 0x20 and 0x09-0x0D, unless told otherwise; its hash ignores the case of A-Z, unless told otherwise.  Two different words share a hash with a
probability of about 2**-64 a pair, so V distinct words hold about V*V/2**65 colliding pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(20240601).integers(1, 1 << 64, 256, dtype=np.uint64)
_CASED = _VALUES.copy()
_VALUES[65:91] = _VALUES[97:123]
_powers: list[np.ndarray] = []


class Chunk(NamedTuple):
    """Rows lo..hi of a batch: their UTF-8 bytes end to end, and where each row's begin (one more than rows)."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Word spans in a chunk's bytes, their hashes, and each row's first word (one more than rows)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def chunks(column: pa.Array, limit: int = 1 << 19) -> Iterator[Chunk]:
    """Runs of rows with at most limit bytes together, or one longer row. Null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b))]) for b in (_BASE, _INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def words(chunk: Chunk, space: np.ndarray = SPACE, fold: bool = True) -> Words:
    """The words of each row; none crosses a row's end. space: which bytes part words; fold: whether A-Z counts as a-z."""
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    ink = ~space[data]
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    at = offsets[1:-1]
    at = at[(at > 0) & (at < n)]
    begins[at] = ink[at]
    ends[at - 1] = ink[at - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_VALUES if fold else _CASED)[data] * power[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start])
    return Words(start, end, h, np.searchsorted(start, offsets))


def row_of(first: np.ndarray) -> np.ndarray:
    """For each item, the row it belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ragged(flat: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[offsets[i]:offsets[i+1]] for each i in ids, end to end; and the length of each."""
    size = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(offsets[ids] - (ends - size), size) + np.arange(total)], size


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def few_rows(df: DataFrame) -> DataFrame:
    """df; texts may be long, so Arrow batches of this session hold few rows from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
