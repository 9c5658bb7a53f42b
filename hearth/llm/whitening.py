"""Embedding whitening from an exact characteristic polynomial.

Each component c becomes the integer x = floor(scale * c) + offset.  One pass gathers the number of vectors, the
sums S and the products of all pairs of dimensions as exact integers, which give the scatter
``M = n * sum(x x') - S S'``, n * n times the covariance.  Then:

1. The characteristic polynomial of M is found modulo as many primes below 2**31 as its coefficients may need (their
   bound follows from the trace): reduction to Hessenberg form, then its recurrence.  Primes are spread over tasks.
2. The residues are joined by Chinese remaindering to integer coefficients.
3. All roots are real, so the sign changes of the coefficients shifted by a count the roots beyond a exactly, with
   their multiplicity.  Bisection by that count isolates the wanted roots, equal ones as one.
4. Each isolated root is refined by sign changes to 2**-PRECISION of the trace, and its null space found by
   elimination with full pivoting and inverse iteration, in fixed point of PRECISION bits.  Roots are spread over tasks.

Only sums of the size of the dimension squared, and roots and vectors, pass through the driver; steps 1 and 4 take
time in proportion to the dimension to the power of four, so that some hundred dimensions are the practical limit.

Defined results: vectors that are null, empty or hold null or non-finite entries take no part; those of different
lengths are fitted and whitened apart, each with its own n.  Repeated rows and rows without an id count like all
others.  scale * c counts as the nearest integer of at most 62 bits.  Equal eigenvalues get an orthonormal basis of their space.  A
component without variance has explained 0 and a null whitened value, and takes no part in identity_error; without
any variance explained is null too.  A deviation beyond 64 bits is null in ``deviation`` and stands as text in
``deviation_exact``, which is null otherwise.  Other columns of the input are ignored; no vectors give no rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.textbatch import column

PRECISION = 320
#: Scale at which isolation starts: the trace has about so many bits.
COARSE = 64
LIMIT = 1 << 62
#: Integers are multiplied in limbs of so many bits, BLOCK rows at a time: every sum stays exact in floating point.
LIMB, BLOCK = 20, 4096


class Model(NamedTuple):
    """Of the vectors of one length: their number, the sums of x - offset, and each component's vector, eigenvalue's root and share."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    roots: np.ndarray
    explained: list[float | None]
    identity_error: float | None


# ---- the exact scatter


def matrices(batch: pa.RecordBatch, name: str, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, row numbers, integers) of the vectors that take part, by length, at most BLOCK rows at a time."""
    lists = column(batch, name)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    for size in np.unique(sizes[sizes > 0]).tolist():
        each = np.flatnonzero(sizes == size)
        step = max(1, min(BLOCK, (1 << 21) // size))
        for lo in range(0, len(each), step):
            rows = each[lo : lo + step]
            c = flat[starts[rows][:, None] + np.arange(size)]
            whole = np.isfinite(c).all(1)
            with np.errstate(over="ignore"):
                y = np.clip(np.floor(c[whole] * scale), -float(LIMIT), float(LIMIT)).astype(np.int64)
            yield size, rows[whole], y


def gram(y: np.ndarray) -> np.ndarray:
    """y' y as exact integers, of at most BLOCK rows."""
    most = int(np.abs(y).max(initial=0))
    parts, rest = [], y
    while most > 0:
        low = rest & ((1 << LIMB) - 1) if most >= 1 << LIMB else rest
        parts.append(low.astype(float))
        rest, most = (rest - low) >> LIMB, most >> LIMB
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a, left in enumerate(parts):
        for b, right in enumerate(parts):
            total += (left.T @ right).astype(np.int64).astype(object) * (1 << LIMB * (a + b))
    return total


def limbs(cell: int, value: int) -> Iterator[tuple[int, int, int]]:
    """(cell, place, limb): value in base 2**32; sums of limbs are limbs of the sum."""
    place = 0
    while -(1 << 31) > value or value >= 1 << 31:
        yield cell, place, value & 0xFFFFFFFF
        value >>= 32
        place += 1
    yield cell, place, value


def scatters(vectors: DataFrame, vec_col: str, scale: int) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """For each length: n, the sums of y = x - offset and the products of all pairs, exact at any number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for size, _, y in matrices(batch, "v", scale):
                own = held.setdefault(size, [0, np.zeros(size, object), np.zeros((size, size), object)])
                own[0] += len(y)
                own[1] += y.astype(object).sum(0) if len(y) else 0
                own[2] += gram(y)
        for size, (n, sums, square) in held.items():
            upper = np.triu_indices(size)
            rows = [r for cell, v in enumerate([n, *sums.tolist(), *square[upper].tolist()]) for r in limbs(cell, int(v))]
            cells, places, values = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), size)), pa.array(cells), pa.array(places), pa.array(values)], ["size", "cell", "place", "limb"])

    partial = vectors.select(F.col(f"`{vec_col}`").alias("v")).mapInArrow(run, "size long, cell long, place long, limb long")
    out: dict[int, tuple[int, list[int], np.ndarray]] = {}
    totals: dict[int, dict[int, int]] = {}
    for r in partial.groupBy("size", "cell", "place").agg(F.sum("limb").alias("limb")).toLocalIterator():
        own = totals.setdefault(r["size"], {})
        own[r["cell"]] = own.get(r["cell"], 0) + (r["limb"] << 32 * r["place"])
    for size, cells in sorted(totals.items()):
        if not cells.get(0):
            continue
        square = np.zeros((size, size), object)
        upper = np.triu_indices(size)
        square[upper] = [cells.get(size + 1 + k, 0) for k in range(len(upper[0]))]
        square = np.where(np.tri(size, k=-1, dtype=bool), square.T, square)
        out[size] = cells[0], [cells.get(1 + k, 0) for k in range(size)], square
    return out


# ---- the characteristic polynomial


def is_prime(p: int) -> bool:
    """Exact for p below 3.2e9 (these four witnesses)."""
    d, s = p - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, p)
        if x in (1, p - 1):
            continue
        for _ in range(s - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds 2**bits."""
    out, p, have = [], (1 << 31) - 1, 0.0
    while have <= bits + 1:
        if is_prime(p):
            out.append(p)
            have += math.log2(p)
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t - m) modulo p, the lowest first."""
    h = np.array(m % p, np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        i = k + 1 + int(below[0])
        h[[i, k + 1]] = h[[k + 1, i]]
        h[:, [i, k + 1]] = h[:, [k + 1, i]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        chain, weight = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):  # polys[i] counts with h[i, k-1] times the subdiagonal entries between
            weight[i] = h[i, k - 1] * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else 0
        polys[k] = (polys[k] - (polys[:k] * weight[:, None] % p).sum(0)) % p
    return polys[d]


def joined(residues: dict[int, list[int]]) -> list[int]:
    """The integers of least size with these residues, by Chinese remaindering."""
    product = math.prod(residues)
    out = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        rest = product // p
        unit = rest * pow(rest, -1, p)
        out = [(o + unit * int(v)) % product for o, v in zip(out, values, strict=True)]
    return [o - product if 2 * o > product else o for o in out]


def characteristic(spark, m: np.ndarray) -> list[int]:
    """Coefficients of det(t - m), the lowest first, of a symmetric matrix without negative eigenvalues."""
    d, trace = len(m), sum(int(m[i, i]) for i in range(len(m)))
    bits = max((math.comb(d, k) * trace**k // d**k + 1).bit_length() for k in range(d + 1)) + 1
    primes = primes_for(bits)
    packed = pickle.dumps(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(packed)
        for b in batches:
            ps = column(b, "p").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array([polynomial_mod(own, p).tolist() for p in ps], pa.list_(pa.int64()))], ["p", "c"])

    tasks = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    found = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(run, "p long, c array<long>").collect()
    return joined({r["p"]: r["c"] for r in found})


# ---- its roots


def scaled(c: list[int], s: int) -> list[int]:
    """The polynomial whose roots are 2**s times those of c, rounded down coefficients where s is negative never arise: s >= 0."""
    top = len(c) - 1
    return [v << s * (top - i) for i, v in enumerate(c)]


def roots_beyond(c: list[int], a: int) -> int:
    """How many roots exceed a, with their multiplicity; all roots of c are real."""
    c = list(c)
    top = len(c) - 1
    for i in range(top):
        for j in range(top - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def isolate(c: list[int], lo: int, hi: int, above_lo: int, above_hi: int, wanted: int) -> list[tuple[int, int, int, int]]:
    """(lo, hi, roots beyond hi, count): intervals (lo, hi] of one root each, or of width 1, which hold the `wanted` largest roots."""
    if above_lo == above_hi or above_hi >= wanted:
        return []
    if above_lo - above_hi == 1 or hi - lo == 1:
        return [(lo, hi, above_hi, above_lo - above_hi)]
    mid = (lo + hi) // 2
    above = roots_beyond(c, mid)
    return isolate(c, mid, hi, above, above_hi, wanted) + isolate(c, lo, mid, above_lo, above, wanted)


def value(c: list[int], a: int) -> int:
    out = 0
    for v in reversed(c):
        out = out * a + v
    return out


def refined(c: list[int], lo: int, hi: int) -> int:
    """The least integer not below the only root in (lo, hi]: the interval is cut into as many cells as the last guess by a straight line deserved."""
    left, right = value(c, lo), value(c, hi)
    cells = 4
    while hi - lo > 1 and right:
        width = hi - lo
        cells = min(cells, width)
        at = min(max(left * cells // (left - right), 0), cells - 1)
        a, b = lo + at * width // cells, lo + (at + 1) * width // cells
        va, vb = (left if a == lo else value(c, a)), (right if b == hi else value(c, b))
        if va == 0:
            return a
        if (va > 0) != (left > 0):
            hi, right, cells = a, va, max(4, math.isqrt(cells))
        elif vb and (vb > 0) == (left > 0):
            lo, left, cells = b, vb, max(4, math.isqrt(cells))
        else:
            lo, left, hi, right, cells = a, va, b, vb, cells * cells
    return hi


# ---- their null spaces


def null_space(m: np.ndarray, root: int, s: int, count: int) -> np.ndarray:
    """Orthonormal rows that span the eigenvectors of m at root / 2**s, of multiplicity count."""
    d, bits = len(m), PRECISION
    a = m * (1 << s) - np.diag(np.array([root] * d, object))
    full, rows, cols = a.copy(), np.arange(d), np.arange(d)
    factor = np.zeros((d, d), object)
    for k in range(d - count):
        i, j = divmod(int(np.abs(a[k:, k:]).argmax()), d - k)
        for own in (a, factor):
            own[[k, k + i]] = own[[k + i, k]]
        a[:, [k, k + j]] = a[:, [k + j, k]]
        rows[[k, k + i]], cols[[k, k + j]] = rows[[k + i, k]], cols[[k + j, k]]
        if not a[k, k]:
            break
        f = (a[k + 1 :, k] << bits) // a[k, k]
        factor[k + 1 :, k] = f
        a[k + 1 :, k:] -= (f[:, None] * a[k, k:]) >> bits
    free = d - count

    def back(y: np.ndarray) -> np.ndarray:
        x = y.copy()  # the last pivots, zero but for rounding, count as one unit
        for k in range(free - 1, -1, -1):
            x[k] = (y[k] - (a[k, k + 1 :] * x[k + 1 :]).sum()) // a[k, k] if a[k, k] else 0
        out = np.zeros(d, object)
        out[cols] = x
        return out

    def forward(b: np.ndarray) -> np.ndarray:
        y = b[rows]
        for k in range(free):
            y[k + 1 :] -= (factor[k + 1 :, k] * y[k]) >> bits
        return y

    def orthonormal(basis: list[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for x in basis:
            for _ in range(2):
                x = (x << bits) // max(1, math.isqrt(int((x * x).sum())))
                for u in out:
                    x = x - ((u * (int((u * x).sum()) >> bits)) >> bits)
            out.append((x << bits) // max(1, math.isqrt(int((x * x).sum()))))
        return out

    basis = orthonormal([back(np.array([(1 << bits) if k == free + j else 0 for k in range(d)], object)) for j in range(count)])
    for _ in range(3):
        basis = orthonormal([back(forward(x)) for x in basis])
        worst = max(int(np.abs((full * x).sum(1)).max()) for x in basis)
        if worst <= (1 << bits) * (1 << max(0, full_bits(full) - 100)):
            break
    return np.array([[int(v) / (1 << bits) for v in x] for x in basis])


def full_bits(a: np.ndarray) -> int:
    return int(np.abs(a).max()).bit_length()


def components(spark, m: np.ndarray, wanted: int) -> tuple[np.ndarray, list[int], int]:
    """(vectors as rows, roots times 2**s, s) of the `wanted` largest eigenvalues of m, by falling eigenvalue; zeros last."""
    d = len(m)
    wanted = min(wanted, d)
    c = characteristic(spark, m)
    zeros = next(i for i, v in enumerate(c) if v)
    trace = sum(int(m[i, i]) for i in range(d))
    coarse = max(0, COARSE - trace.bit_length())
    fine = max(coarse, PRECISION - trace.bit_length())
    poly = c[zeros:]
    found = []
    if zeros < d:
        rough = scaled(poly, coarse)
        for lo, hi, beyond, count in isolate(rough, 0, (trace << coarse) + 1, d - zeros, 0, wanted):
            low, high = lo << fine - coarse, hi << fine - coarse
            if count == 1:
                found.append((low, high, beyond, 1))
            else:
                found += isolate(scaled(poly, fine), low, high, beyond + count, beyond, wanted)
    if d - zeros < wanted:
        found.append((-1, 0, d - zeros, zeros))
    packed = pickle.dumps((m, scaled(poly, fine)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sharp = pickle.loads(packed)
        for b in batches:
            for r in b.to_pylist():
                lo, hi = int(r["lo"]), int(r["hi"])
                root = refined(sharp, lo, hi) if r["count"] == 1 and hi else hi
                for k, v in enumerate(null_space(own, root, fine, r["count"])):
                    v = v * (1 if v[np.abs(v).argmax()] > 0 else -1)
                    yield pa.RecordBatch.from_arrays([pa.array([r["beyond"] + k], pa.int64()), pa.array([str(root)]), pa.array([v.tolist()], pa.list_(pa.float64()))], ["place", "root", "v"])

    rows = [(str(lo), str(hi), beyond, count) for lo, hi, beyond, count in found]
    tasks = max(1, min(len(rows), spark.sparkContext.defaultParallelism))
    frame = spark.createDataFrame(rows, "lo string, hi string, beyond long, count long").repartition(tasks)
    made = sorted(frame.mapInArrow(run, "place long, root string, v array<double>").collect(), key=lambda r: r["place"])[:wanted]
    return np.array([r["v"] for r in made]), [int(r["root"]) for r in made], fine


# ---- fitting and whitening


def centred(y: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S as exact integers: 64-bit ones where all fit with the sum of their squares, else Python's."""
    most = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, model.sums))
    if most * most * y.shape[1] < 1 << 62:
        return y * model.n - np.array(model.sums, np.int64)
    return y.astype(object) * model.n - np.array(model.sums, object)


def whitened(z: np.ndarray, model: Model) -> np.ndarray:
    """Each row's components; NaN where a component has no variance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(model.roots > 0, ((z / model.n).astype(float) @ model.vectors.T) / model.roots, np.nan)


def fit(vectors: DataFrame, vec_col: str = "embedding", components_: int = 32, scale: int = 64) -> dict[int, Model]:
    """A model for each length of vector; identity_error is measured over the whitened rows in a second pass."""
    spark = vectors.sparkSession
    models: dict[int, Model] = {}
    for size, (n, sums, square) in scatters(vectors, vec_col, scale).items():
        s = np.array(sums, object)
        m = square * n - s[:, None] * s[None, :]
        trace = sum(int(m[i, i]) for i in range(size))
        basis, roots, shift = components(spark, m, components_)
        share = [r / (trace << shift) if trace else None for r in roots]
        deviation = np.array([math.sqrt(r / (n * n << shift)) for r in roots])
        models[size] = Model(n, sums, basis, deviation, share, None)
    shared = spark.sparkContext.broadcast(models)  # by length, at most components_ vectors of it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, y in matrices(batch, "v", scale):
                model = shared.value[size]
                w = whitened(centred(y, model), model)
                w = np.column_stack([np.ones(len(w)), np.nan_to_num(w)])
                held[size] = held.get(size, 0) + w.T @ w
        for size, square in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(square.size, size)), pa.array(np.arange(square.size)), pa.array(square.ravel())], ["size", "cell", "v"])

    partial = vectors.select(F.col(f"`{vec_col}`").alias("v")).mapInArrow(run, "size long, cell long, v double")
    sums: dict[int, dict[int, float]] = {}
    for r in partial.groupBy("size", "cell").agg(F.sum("v").alias("v")).toLocalIterator():
        sums.setdefault(r["size"], {})[r["cell"]] = r["v"]
    for size, model in models.items():
        k = len(model.roots) + 1
        square = np.array([sums[size][i] for i in range(k * k)]).reshape(k, k) / model.n
        error = np.abs(square[1:, 1:] - np.outer(square[0, 1:], square[0, 1:]) - np.eye(k - 1))
        live = model.roots > 0
        models[size] = model._replace(identity_error=float(error[live][:, live].max()) if live.any() else None)
    shared.destroy()
    return models


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components_: int = 32, scale: int = 64) -> DataFrame:
    """(id, component, n, deviation, deviation_exact, whitened, explained, identity_error): a row for each vector and component."""
    shared = vectors.sparkSession.sparkContext.broadcast(fit(vectors, vec_col, components_, scale))
    kind = vectors.schema[id_col].dataType.simpleString()
    names = ["component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "id")
            for size, rows, y in matrices(batch, "v", scale):
                model = shared.value[size]
                k = len(model.roots)
                z = centred(y, model)
                w = whitened(z, model)
                total = (z * z).sum(1)
                fits = np.array([int(t) < 1 << 63 for t in total], bool)
                deviation = pa.array([int(t) if f else None for t, f in zip(total, fits, strict=True)], pa.int64())
                exact = pa.array([None if f else str(t) for t, f in zip(total, fits, strict=True)], pa.string())
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                flat = w.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(flat), model.n, np.int64)), deviation.take(each), exact.take(each),
                        pa.array(flat, mask=np.isnan(flat)), pa.array(model.explained * len(rows), pa.float64()), pa.array([model.identity_error] * len(flat), pa.float64()),
                    ],
                    ["id", *names],
                )

    out = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v"))
    made = out.mapInArrow(run, f"id {kind}, component int, n long, deviation long, deviation_exact string, whitened double, explained double, identity_error double")
    return made.withColumnRenamed("id", id_col)
