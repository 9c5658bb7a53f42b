"""Exact top-k search by inner product over quantised vectors, with multi-resolution segment statistics.

Each component x becomes floor(scale * x).  All vectors are turned by one orthonormal basis, which leaves inner
products as they are and gathers what varies most in the leading components.  A turned vector is cut into
segments, short in front and long behind; of each the mean and the deviation are kept, at several resolutions,
coarse to fine.  For vectors q and x and segments of width w,
``|q - x|^2 >= sum w * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2)``; with the exact norms this lower bound on the
distance is an upper bound ``sum w * (mean_q * mean_x + dev_q * dev_x)`` on the inner product.  A candidate
that cannot beat the k-th best score found so far is dropped at the first resolution that shows it; finer
statistics and the exact integer products are computed for survivors only.

The basis is fitted to BASIS_ROWS rows at most, those of the smallest hashes; it only decides how much is
pruned.  Vectors that spread alike in all directions can hardly be pruned by any such bound.

Vectors travel as rows.  Every part of the queries meets every group of candidates once (the stated query set
against all rows), in one grouped Arrow task of CANDIDATE_BLOCK rows of each side; a meeting returns k rows a
query, and those merge by one window.  A row is sent once for each part of the queries, a query once for each
group of candidates, and no block of vectors is ever one JVM value.

Defined results: vectors that are null, empty or hold null or non-finite components take no part; queries
meet candidates of their own length only; ties go to the smaller id; fewer candidates than k give all.  Rows
without an id take no part; of rows of one id the smallest vector counts.  Components beyond 64 bits count as
the nearest 64-bit integer; scores order as exact integers of any size and are returned as the nearest one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.llm.scratch import stored, tidy

#: Components that stand alone at each resolution; the rest lie in segments that double in width.
RESOLUTIONS = (8, 16, 32, 48)
BASIS_ROWS = 4096
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8192
#: Below it sums of integer products are exact in floating point, and in 64-bit integers.
EXACT_FLOAT, EXACT_LONG = 2.0**53, 2.0**63


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, size, v): integer components of the vectors that take part."""
    v = F.col(f"`{vec_col}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.size(v).alias("size"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def basis_of(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the principal directions of a bounded sample, by falling spread."""
    n = rows.count()
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, BASIS_ROWS / max(1, n)))
    sample = rows.where(share).select("size", F.transform("v", lambda x: x.cast("double")).alias("v")).limit(2 * BASIS_ROWS).collect()
    out = {}
    for size in {r["size"] for r in sample}:
        x = np.array([r["v"] for r in sample if r["size"] == size])
        x /= max(1.0, np.abs(x).max())
        out[size] = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    return out


def segments(size: int, alone: int) -> np.ndarray:
    """Where segments begin and end: alone of one component each, then widths that double."""
    ends = [*range(min(alone, size) + 1)]
    width = max(1, alone // 2)
    while ends[-1] < size:
        ends.append(min(size, ends[-1] + width))
        width *= 2
    return np.array(ends)


def statistics(turned: np.ndarray, alone: int) -> np.ndarray:
    """The statistics of each row, weighted so that a plain product of two rows bounds the score."""
    ends = segments(turned.shape[1], alone)
    first, width = ends[:-1], np.diff(ends)
    mean = np.add.reduceat(turned, first, axis=1) / width
    square = np.add.reduceat(turned * turned, first, axis=1) / width
    wide = width > 1
    dev = np.sqrt(np.maximum(square[:, wide] - mean[:, wide] ** 2, 0))
    return np.concatenate([mean * np.sqrt(width), dev * np.sqrt(width[wide])], 1)


def products(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Exact inner products of the integer rows q[row] and x[col]."""
    most = np.sqrt((q.astype(float) ** 2).sum(1)).max(initial=0) * np.sqrt((x.astype(float) ** 2).sum(1)).max(initial=0)
    if most < EXACT_FLOAT and 2 * len(row) > len(q) * len(x):
        return (q.astype(float) @ x.astype(float).T)[row, col].astype(np.int64)
    kind = float if most < EXACT_FLOAT else np.int64 if most < EXACT_LONG else object
    q, x = q.astype(kind), x.astype(kind)
    parts = [np.zeros(0, kind), *((q[row[s : s + (1 << 16)]] * x[col[s : s + (1 << 16)]]).sum(1) for s in range(0, len(row), 1 << 16))]
    out = np.concatenate(parts)
    return out if kind is object else out.astype(np.int64)


def best_of(query_id: np.ndarray, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, basis: np.ndarray | None = None, tally: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate id, score) of each query's k best candidates other than itself, block by block; ids ascend.

    tally receives the number of pairs and of those that reached the exact products.
    """
    size = query.shape[1]
    basis = np.eye(size) if basis is None else basis
    turned = query.astype(float) @ basis
    q_stats = [statistics(turned, a) for a in RESOLUTIONS if a < size]
    slack = 1e-9 * np.sqrt((turned**2).sum(1))
    best: list[list[tuple[int, int]]] = [[] for _ in query_id]
    for lo in range(0, len(ids), 1024):
        x, x_id = vectors[lo : lo + 1024], ids[lo : lo + 1024]
        row, col = np.nonzero(x_id[None, :] != query_id[:, None])
        pairs = len(row)
        if all(len(b) == k for b in best):
            floor = np.array([float(b[-1][0]) for b in best])
            x_turned = x.astype(float) @ basis
            margin = slack[:, None] * np.sqrt((x_turned**2).sum(1))[None, :] + 1e-3
            for level, (a, stats) in enumerate(zip([a for a in RESOLUTIONS if a < size], q_stats, strict=True)):
                if not len(row):
                    break
                seen = np.unique(col)
                if level == 0:
                    bound = (stats @ statistics(x_turned, a).T)[row, col]
                else:
                    own = np.empty((len(x), stats.shape[1]))
                    own[seen] = statistics(x_turned[seen], a)
                    bound = (stats @ own[seen].T)[row, np.searchsorted(seen, col)] if 4 * len(row) > len(query) * len(seen) else np.einsum("ij,ij->i", stats[row], own[col])
                alive = bound + margin[row, col] > floor[row]
                row, col = row[alive], col[alive]
        score = products(query, x, row, col)
        if tally is not None:
            tally += [pairs, len(row)]
        starts = np.searchsorted(row, np.arange(len(query_id) + 1))
        for i, (a, z) in enumerate(zip(starts.tolist(), starts[1:].tolist(), strict=False)):
            if a < z:
                own = score[a:z]
                if z - a > k and own.dtype != object:
                    top = np.flatnonzero(own >= np.partition(own, z - a - k)[z - a - k])
                    found = zip(own[top].tolist(), x_id[col[a:z][top]].tolist(), strict=True)
                else:
                    found = zip(own.tolist(), x_id[col[a:z]].tolist(), strict=True)
                best[i] = sorted([*best[i], *found], key=lambda t: (-t[0], t[1]))[:k]
    row = np.repeat(np.arange(len(best)), [len(b) for b in best])
    return row, np.array([j for b in best for _, j in b], np.int64), np.array([s for b in best for s, _ in b], object)


def one_each(rows: DataFrame) -> DataFrame:
    """(id, size, v), stored: the smallest vector of each id and length; a hash of an id then fills no block with copies of one id."""
    return stored(rows.groupBy("id", "size").agg(F.min("v").alias("v")))


@tidy
def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, id, score): each query's k best of all other rows."""
    flagged = vectors.withColumn("asks", F.coalesce(is_query, F.lit(False)))
    rows = one_each(quantised(flagged, id_col, vec_col, scale))
    asks = one_each(quantised(flagged.where("asks"), id_col, vec_col, scale))
    groups, parts = (max(1, -(-df.count() // CANDIDATE_BLOCK)) for df in (rows, asks))
    shared = vectors.sparkSession.sparkContext.broadcast(basis_of(rows))
    block = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    met = asks.select("size", every(groups).alias("with"), block(parts).alias("part"), F.lit(True).alias("asks"), "id", "v")
    met = met.union(rows.select("size", block(groups).alias("with"), every(parts).alias("part"), F.lit(False), "id", "v"))

    def run(rows: pa.Table) -> pa.Table:
        size = rows.column("size")[0].as_py()
        asking, ids = rows.column("asks").to_numpy(), rows.column("id").to_numpy()
        v = rows.column("v").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, size)
        sides = []
        for own in (asking, ~asking):
            at = np.flatnonzero(own)
            sides += [ids[at := at[np.argsort(ids[at])]], v[at]]
        qid, query, x_id, x = sides
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo in range(0, len(qid), QUERY_BLOCK):
            row, found, score = best_of(qid[lo : lo + QUERY_BLOCK], query[lo : lo + QUERY_BLOCK], x_id, x, k, shared.value.get(size))
            out.append((qid[lo : lo + QUERY_BLOCK][row], found, score))
        asked, found, score = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))
        clipped = [max(-(1 << 63), min((1 << 63) - 1, int(x))) for x in score]
        exact = pa.array([str(int(x)) for x in score], pa.string())
        return pa.Table.from_arrays([pa.array(asked, pa.int64()), pa.array(found, pa.int64()), pa.array(clipped, pa.int64()), exact], ["query_id", "id", "score", "exact"])

    each = met.groupBy("size", "with", "part").applyInArrow(run, "query_id long, id long, score long, exact string")
    # beyond 64 bits: longer numbers are larger, those of one length order as texts, and the other way round below zero
    order = [F.desc("score"), F.desc(F.when(F.col("score") > 0, F.lpad("exact", 45, "0"))), F.when(F.col("score") < 0, F.lpad(F.substring("exact", 2, 44), 45, "0")), "id"]
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
