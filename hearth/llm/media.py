"""Media columns: texts stored in an ISO media container, and containers probed without decoding payloads.

``store`` writes each text's bytes, padded with 255 to a positive multiple of 576, as raw 8-bit samples of
one track.  ``probe`` walks the nested boxes of any such container, decodes the sample tables of its first
track and keeps codec, duration and key-frame byte ranges; ``payload`` reads the samples back by those tables.

Defined results: a null text counts as empty; media that are null or no readable container give null
columns.  Equal texts give equal bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.textbatch import chunks, column, few_rows

UNIT = 576
TIMESCALE = 48_000
KEY_EVERY = 16
#: Bytes that a task holds as objects at once (or one larger text).
BLOCK_BYTES = 4 << 20
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
_MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


class Track(NamedTuple):
    codec: str
    timescale: int
    duration: int  # by the header, or where that has none the sum of the samples'
    offset: np.ndarray  # of each sample
    size: np.ndarray
    time: np.ndarray  # when it is decoded
    shift: np.ndarray  # from there to when it is shown
    key: np.ndarray  # numbers of the key samples, from 0


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", flags), *parts)


def build(payload: bytes) -> bytes:
    """A container whose samples are the payload's units; every KEY_EVERY-th is a key sample."""
    n = len(payload) // UNIT
    duration = n * UNIT
    keys = np.arange(1, n + 1, KEY_EVERY, dtype=">u4")

    def moov(at: int) -> bytes:
        table = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), box(b"raw ", bytes(6), struct.pack(">HHHIHHHHI", 1, 0, 0, 0, 1, 8, 0, 0, TIMESCALE << 16))),
            full(b"stts", struct.pack(">III", 1, n, UNIT)),
            full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            full(b"stsc", struct.pack(">IIII", 1, 1, n, 1)),
            full(b"stsz", struct.pack(">II", UNIT, n)),
            full(b"stco", struct.pack(">II", 1, at)),
        )
        info = box(b"minf", full(b"smhd", bytes(4)), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), table)
        media = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, duration, 0x55C4, 0)), full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0"), info)
        track = box(b"trak", full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, duration), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), _MATRIX, bytes(8), flags=7), media)
        head = full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, duration, 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", head, track)

    kind = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom")
    return kind + moov(len(kind) + len(moov(0)) + 8) + box(b"mdat", payload)


def walk(data: memoryview, start: int = 0, end: int | None = None, path: bytes = b"") -> Iterator[tuple[bytes, int, int]]:
    """(path, body start, body end) of each box, in order, containers before what they hold."""
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        size = size or end - start
        if size < head or start + size > end:
            raise ValueError("box beyond its container")
        yield path + kind, start + head, start + size
        if kind in CONTAINERS:
            yield from walk(data, start + head, start + size, path + kind + b"/")
        start += size


def counted(view: memoryview, lo: int, width: int, kind: str = ">u4") -> np.ndarray:
    """The rows of a table that begins with their number, width values each."""
    n, step = struct.unpack_from(">I", view, lo)[0], np.dtype(kind).itemsize
    if lo + 4 + n * width * step > len(view):
        raise ValueError("table beyond the data")
    return np.frombuffer(view, kind, n * width, lo + 4).astype(np.int64).reshape(-1, width)


def sizes(view: memoryview, at: dict[bytes, int]) -> np.ndarray:
    """Bytes of each sample, by the plain or the compact table."""
    if b"stsz" in at:
        fixed, n = struct.unpack_from(">II", view, lo := at[b"stsz"] + 4)
        return np.full(n, fixed, np.int64) if fixed else counted(view, lo + 4, 1)[:, 0]
    bits, n = struct.unpack_from(">II", view, lo := at[b"stz2"] + 4)
    if bits in (8, 16):
        return np.frombuffer(view, f">u{bits // 8}", n, lo + 8).astype(np.int64)
    pairs = np.frombuffer(view, np.uint8, -(-n // 2), lo + 8)
    return np.stack([pairs >> 4, pairs & 15], 1).ravel()[:n].astype(np.int64)


def samples(view: memoryview, at: dict[bytes, int]) -> list[np.ndarray]:
    """Offset, size, time, shift and key mark of the samples in a track's tables."""
    size = sizes(view, at)
    n = len(size)
    chunk = counted(view, at[b"stco"] + 4, 1)[:, 0] if b"stco" in at else counted(view, at[b"co64"] + 4, 1, ">u8")[:, 0]
    runs = counted(view, at[b"stsc"] + 4, 3)
    each = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunk) + 1))) if len(runs) else np.zeros(0, np.int64)  # samples in each chunk
    first, before = np.cumsum(each) - each, np.cumsum(size) - size
    offset = np.repeat(chunk[: len(each)] - before[np.minimum(first, max(n - 1, 0))], each)[:n] + before if n else before
    spread = lambda rows: np.pad(np.repeat(rows[:, 1], rows[:, 0])[:n], (0, max(0, n - int(rows[:, 0].sum()))))
    steps = spread(counted(view, at[b"stts"] + 4, 2))
    shift = np.zeros(n, np.int64)
    if b"ctts" in at:
        rows = counted(view, at[b"ctts"] + 4, 2)
        if view[at[b"ctts"]] == 1:
            rows[:, 1] = rows[:, 1].astype(np.uint32).view(np.int32)
        shift = spread(rows)
    key = np.ones(n, bool)
    if b"stss" in at:
        key[:] = False
        key[counted(view, at[b"stss"] + 4, 1)[:, 0] - 1] = True
    return [offset, size, np.cumsum(steps) - steps, shift, key, steps]


def fragment(view: memoryview, lo: int, head: dict[str, int], start: int, time: int) -> tuple[list[np.ndarray], int]:
    """The samples of one run of a fragment, and where its data end. start: where its data begin unless it says so."""
    flags, n = int.from_bytes(view[lo + 1 : lo + 4], "big"), struct.unpack_from(">I", view, lo + 4)[0]
    at, first = lo + 8, None
    if flags & 1:
        start = head["base"] + struct.unpack_from(">i", view, at)[0]
        at += 4
    if flags & 4:
        first = struct.unpack_from(">I", view, at)[0]
        at += 4
    fields = [f for f in (0x100, 0x200, 0x400, 0x800) if flags & f]
    if at + 4 * n * len(fields) > len(view):
        raise ValueError("run beyond the data")
    rows = np.frombuffer(view, ">u4", n * len(fields), at).astype(np.int64).reshape(n, -1)
    of = lambda f, default: rows[:, fields.index(f)].copy() if f in fields else np.full(n, default, np.int64)
    steps, size, marks, shift = of(0x100, head["steps"]), of(0x200, head["size"]), of(0x400, head["flags"]), of(0x800, 0)
    if first is not None and n:
        marks[0] = first
    shift = shift.astype(np.uint32).view(np.int32).astype(np.int64) if view[lo] == 1 else shift
    before = np.cumsum(size) - size
    return [start + before, size, time + np.cumsum(steps) - steps, shift, marks & 0x10000 == 0, steps], start + int(size.sum())


def read_tracks(data: bytes) -> list[Track]:
    """All tracks with the samples of their tables and fragments; those whose tables are broken or point beyond the data are left out."""
    view = memoryview(data)
    try:
        boxes = list(walk(view))
    except (ValueError, struct.error):
        return []
    traks: list[dict[bytes, int]] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    parts: dict[int, list[list[np.ndarray]]] = {}
    broken: set[int] = set()
    moof, head, end, time = 0, {}, 0, 0
    for path, lo, _ in boxes:
        name = path[-4:]
        try:
            if path == b"moov/trak":
                traks.append({})
            elif path.startswith(b"moov/trak/"):
                traks[-1].setdefault(name, lo)
            elif path == b"moov/mvex/trex":
                number, _, *rest = struct.unpack_from(">5I", view, lo + 4)
                defaults[number] = tuple(rest)
            elif path == b"moof":
                moof = end = lo - (16 if bytes(view[lo - 16 : lo - 8]) == b"\0\0\0\1moof" else 8)
            elif path == b"moof/traf/tfhd":
                flags, number = int.from_bytes(view[lo + 1 : lo + 4], "big"), struct.unpack_from(">I", view, lo + 4)[0]
                head, at = dict(zip(("steps", "size", "flags"), defaults.get(number, (0, 0, 0)), strict=True)) | {"base": moof, "number": number}, lo + 8
                for bit, width, field in ((1, 8, "base"), (2, 4, ""), (8, 4, "steps"), (16, 4, "size"), (32, 4, "flags")):
                    if flags & bit:
                        head[field] = int.from_bytes(view[at : at + width], "big")
                        at += width
                end, time = head["base"], sum(int(p[5].sum()) for p in parts.get(number, []))
            elif path == b"moof/traf/tfdt":
                time = int.from_bytes(view[lo + 4 : lo + (12 if view[lo] == 1 else 8)], "big")
            elif path == b"moof/traf/trun":
                made, end = fragment(view, lo, head, end, time)
                time += int(made[5].sum())
                parts.setdefault(head["number"], []).append(made)
        except (KeyError, ValueError, IndexError, struct.error):
            broken.add(head.get("number", -1))
    out = []
    for at in traks:
        try:
            number = struct.unpack_from(">I", view, at[b"tkhd"] + (20 if view[at[b"tkhd"]] == 1 else 12))[0]
            if number in broken:
                continue
            lo = at[b"mdhd"]
            timescale, duration = struct.unpack_from(">QIQ", view, lo + 12)[1:] if view[lo] == 1 else struct.unpack_from(">II", view, lo + 12)
            codec = bytes(view[(lo := at[b"stsd"]) + 12 : lo + 16]).decode("latin-1")
            offset, size, time_, shift, key, steps = (np.concatenate(x) for x in zip(samples(view, at), *parts.get(number, []), strict=True))
            if len(size) and (int((offset + size).max()) > len(data) or int(offset.min()) < 0):
                continue
            out.append(Track(codec, timescale, duration or int(steps.sum()), offset, size, time_, shift, np.flatnonzero(key)))
        except (KeyError, ValueError, IndexError, struct.error):
            continue
    return out


def payload(data: bytes, track: Track) -> bytes:
    """All samples, in order."""
    gap = np.flatnonzero(np.diff(track.offset) != track.size[:-1]) + 1
    edges = [0, *gap.tolist(), len(track.size)]
    return b"".join(data[track.offset[a] : track.offset[b - 1] + track.size[b - 1]] for a, b in zip(edges, edges[1:], strict=False) if b > a)


def store(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns keep) with n_bytes and media; older columns of these names go."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_bytes", "media")]
    docs = few_rows(docs).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(column(b, text_col), BLOCK_BYTES):
                length = np.diff(c.offsets)
                media = [build(c.data[lo:hi].tobytes().ljust(max(1, -(-(hi - lo) // UNIT)) * UNIT, b"\xff")) for lo, hi in zip(c.offsets.tolist(), c.offsets[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*(column(b, k).slice(c.lo, c.hi - c.lo) for k in keep), pa.array(length, pa.int64()), pa.array(media, pa.binary())], [*keep, "n_bytes", "media"])

    types = "".join(f"`{c}` {t}, " for c, t in docs.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return docs.mapInArrow(run, f"{types}n_bytes long, media binary")


PROBED = {
    "codec": pa.string(), "timescale": pa.int64(), "duration": pa.int64(), "n_samples": pa.int64(), "n_tracks": pa.int64(),
    "keyframes": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("shown", pa.int64())])),
    "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(),
}


def probe(media: DataFrame, media_col: str = "media", keep: list[str] | None = None, digests: bool = False) -> DataFrame:
    """media (or its columns keep) with codec, timescale, duration, n_samples and key-frame byte ranges (and when
    each is shown) of the first whole track, and the number of those; nulls where there is none.

    With digests also the payload's size, hash and the CRC-32 of its last 32 bytes, read back by the sample
    tables, and the container's size and hash.
    """
    names = list(PROBED)[: None if digests else 6]
    keep = [c for c in (media.columns if keep is None else keep) if c not in names]
    media = few_rows(media).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, media_col])])

    def look(data: bytes | None) -> list:
        tracks = read_tracks(data) if data is not None else []
        if not tracks:
            return [None] * len(names)
        track = tracks[0]
        start, stop, shown = (x[track.key].tolist() for x in (track.offset, track.offset + track.size, track.time + track.shift))
        found = [track.codec, track.timescale, track.duration, len(track.size), len(tracks), [{"start": a, "end": z, "shown": t} for a, z, t in zip(start, stop, shown, strict=True)]]
        if digests:
            body = payload(data, track)
            found += [len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]), len(data), hashlib.sha256(data).hexdigest()]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, lo = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column(b, media_col)), 0).to_numpy())), 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(held, held[lo] + BLOCK_BYTES, side="right")) - 1)
                rows = [look(x.as_py()) for x in column(b, media_col).slice(lo, hi - lo)]
                yield pa.RecordBatch.from_arrays([*(column(b, c).slice(lo, hi - lo) for c in keep), *(pa.array([r[i] for r in rows], PROBED[k]) for i, k in enumerate(names))], [*keep, *names])
                lo = hi

    sql = ["string", "long", "long", "long", "long", "array<struct<start: long, end: long, shown: long>>", "long", "string", "long", "long", "string"]
    types = "".join(f"`{c}` {t}, " for c, t in media.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return media.mapInArrow(run, types + ", ".join(f"{k} {t}" for k, t in zip(names, sql, strict=False)))
