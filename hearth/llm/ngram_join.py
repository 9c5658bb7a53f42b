"""Near duplicates by an exact set-similarity join on word shingles.

A document's set holds its distinct shingles of ``n`` words (the whole sequence as one if it has fewer;
none without words).  Documents link when the Jaccard similarity is at least ``percent`` / 100.

1. One pass over the texts sends every shingle, with the place of its document, to a bucket of the hash
   space; tasks combine what they hold: equal sets once, frequent shingles as one entry and a count.
2. Each bucket counts in how many documents its shingles occur and returns those of two or more.  So each
   document learns the exact frequency of its shared shingles.  A set with fewer than ``percent`` % of shared
   ones links with nothing and is done.
3. Rare-first order: frequency, then hash.  Shingles of one document come first and match nothing; what is
   left of the prefix (the shingles of which similar sets must share one) joins the sets.
4. Within a shingle every member pairs with the one edited least, then those outside the shingle's largest
   component with a few such members of it, then all that still lie in different components, by neighbouring
   size classes.
   Length, positional and suffix filters prune pairs inside the joins; each pair is verified once, on the
   shared shingles of both sets.  Links merge into components by joins, so none between components is lost.

The suffix filter cuts the order of hashes at fixed places into ranges and holds the ranges that only one set
occupies against the overlap that the sets need.

Shingles are 64-bit hashes (see ``textbatch`` for their collisions); order and comparison use their upper 48 bits.  Two sets
of s shingles agree in one more than they should with probability s*s/2**48; two of N different sets share a
64-bit name with probability N*N/2**65.  Frequencies above 65,535 count as equal in the order.

Defined results: null and empty texts have empty sets and link with nothing (component: their own id); rows of
one id are compared as they are, each gets the component of its text; a row without an id is compared like the
others, but names no component: alone, its component is null.  Columns beside the two named ones are ignored.
A text of any length is read whole; its words are held in memory by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.scratch import dropped, having_keys, stored, tidy
from hearth.llm.textbatch import Chunk, chunks, column, few_rows, mix, row_of, words

#: Bytes of text that a task combines before it sends, and rows (a document's place has 16 bits; the last one marks counts).
BATCH_BYTES = 4 << 20
BATCH_ROWS = (1 << 16) - 1
#: A shingle of more documents of one batch travels as one entry with a count.
OFTEN = 8
#: Bytes of text for each bucket, and the powers of two between which their number lies.
BUCKET_BYTES = 4 << 20
BUCKETS = (6, 17)
HUBS = 8
#: Ranges of the suffix filter, in words of 64.
BITS = 1024
WORDS = BITS // 64
PLACE = np.uint64(0xFFFF)
SENT = "bucket int, batch long, kind int, keys binary, counts binary, ids array<long>, sizes array<int>, nodes array<long>"
ROWS = "doc_id long, n_shingles long, node long, seat long, shared int, prefix array<long>, members binary, bits array<long>"


def shingles(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes in ascending order, end to end, and each row's first (one more than rows)."""
    w = words(chunk)
    count = np.diff(w.first)
    h = np.zeros(max(0, len(w.hash) - n + 1), np.uint64)
    for k in range(n):
        h = mix(h + w.hash[k : k + len(h)])
    owner = row_of(w.first)[: len(h)]
    inside = np.arange(len(h)) + n <= w.first[owner + 1]
    h, owner = h[inside], owner[inside]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = np.array([reduce(lambda a, x: mix(a + x), w.hash[w.first[r] : w.first[r + 1]], np.uint64([n + 1000])) for r in short], np.uint64).ravel()
        h, owner = np.append(h, whole), np.append(owner, short)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(count) + 1))


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compresses sorted numbers."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def numbers(blobs: pa.Array, kind: type = np.uint64) -> list[np.ndarray]:
    """The inverse of planes for each blob."""
    return [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel() for x in blobs]


def joined(parts: list[np.ndarray], kind: type = np.uint64) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(0, kind)]).astype(kind, copy=False)


def sent(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """For each batch of a task: keys (shingle and place) by bucket, places of frequent shingles, and the documents."""

    def flush(batch: int, ids: list, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        size = np.concatenate([np.diff(first) for _, first in parts])
        h, place = joined([h for h, _ in parts]), row_of(np.append(0, np.cumsum(size)))
        total = np.zeros((2, len(h) + 1), np.uint64)
        np.cumsum(mix(h + np.uint64(1)), out=total[0, 1:])
        np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1, 1:])
        first = np.append(0, np.cumsum(size))
        sums = total[:, first[1:]] - total[:, first[:-1]]
        node = mix(mix(sums[0] + size.astype(np.uint64)) + sums[1])
        chosen = np.zeros(len(size), bool)
        chosen[np.unique(node, return_index=True)[1]] = True  # one of equal sets
        own = chosen[place]
        key = np.unique((h[own] & ~PLACE) | place[own].astype(np.uint64))
        start = np.flatnonzero(np.append(True, key[1:] >> np.uint64(16) != key[:-1] >> np.uint64(16))) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(start, len(key)))
        often = np.repeat(count > OFTEN, count)
        marked = key[start[count > OFTEN]] | PLACE
        entries = np.sort(np.concatenate([key[~often], marked]))
        cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        by = lambda x, y: np.split(y, np.searchsorted(x, cuts))
        rows = [(k, 0, planes(x), planes(c)) for k, (x, c) in enumerate(zip(by(entries, entries), by(marked, count[count > OFTEN].astype(np.uint32)), strict=True)) if len(x)]
        spread = batch % (1 << bits)
        rows += [(spread, 1, planes(key[often]), None), (spread, 2, None, None)]
        only_last = lambda x: pa.array([None] * (len(rows) - 1), pa.list_(x.type)) if len(rows) > 1 else None
        lists = [pa.concat_arrays(ids), pa.array(size.astype(np.int32)), pa.array(node.view(np.int64))]
        lists = [pa.concat_arrays([only_last(x), pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)]) for x in lists]
        bucket, kind, keys, counts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), pa.array([batch] * len(rows), pa.int64()), pa.array(kind, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary()), *lists],
            ["bucket", "batch", "kind", "keys", "counts", "ids", "sizes", "nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        ids, parts, held, bytes_held = [], [], 0, 0
        for b in batches:
            for c in chunks(column(b, "text")):
                for lo in range(c.lo, c.hi, BATCH_ROWS):
                    hi = min(c.hi, lo + BATCH_ROWS)
                    part = c if hi - lo == c.hi - c.lo else Chunk(lo, hi, c.data[c.offsets[lo - c.lo] : c.offsets[hi - c.lo]], c.offsets[lo - c.lo : hi - c.lo + 1] - c.offsets[lo - c.lo])
                    if parts and (held + hi - lo > BATCH_ROWS or bytes_held + len(part.data) > BATCH_BYTES):
                        yield flush(batch, ids, parts)
                        batch, ids, parts, held, bytes_held = batch + 1, [], [], 0, 0
                    ids.append(column(b, "doc_id").slice(lo, hi - lo))
                    parts.append(shingles(part, n))
                    held, bytes_held = held + hi - lo, bytes_held + len(part.data)
        if parts:
            yield flush(batch, ids, parts)

    return docs.mapInArrow(run, SENT)


def counted(found: DataFrame) -> DataFrame:
    """Of each bucket's keys those of shingles in two or more documents, with the frequency (counts); other rows as they are."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        of_keys = pc.equal(rows["kind"], 0)
        entries, rest = rows.filter(of_keys), rows.filter(pc.invert(of_keys))
        each = numbers(entries["keys"])
        key = joined(each)
        weight = np.ones(len(key), np.uint32)
        weight[key & PLACE == PLACE] = joined(numbers(entries["counts"], np.uint32), np.uint32)
        key >>= np.uint64(16)
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        total = np.minimum(np.add.reduceat(weight[order], start, dtype=np.int64), 0xFFFF).astype(np.uint16) if len(key) else np.zeros(0, np.uint16)
        frequency = np.empty(len(key), np.uint16)
        frequency[order] = np.repeat(total, np.diff(np.append(start, len(key))))
        del key, weight, order, start
        ends = np.cumsum([len(x) for x in each])[:-1]
        shared = [(planes(x[f > 1]), planes(f[f > 1])) for x, f in zip(each, np.split(frequency, ends), strict=True)] if each else []
        made = [pa.array([x for x, _ in shared], pa.binary()), pa.array([f for _, f in shared], pa.binary())]
        for name, x in zip(("keys", "counts"), made, strict=True):
            entries = entries.set_column(entries.schema.get_field_index(name), name, pa.chunked_array([x]))
        return pa.concat_tables([entries, rest]).drop(["bucket"])

    return found.groupBy("bucket").applyInArrow(run, SENT.removeprefix("bucket int, "))


def assembled(replies: DataFrame, percent: int) -> DataFrame:
    """One row for each document; prefix, members and bits (all of shared shingles) where enough of them are shared."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        kind = rows["kind"].to_numpy()
        of = lambda k, name: rows[name].filter(pa.array(kind == k)).combine_chunks()
        table = {x: pa.array(of(2, x)).flatten() for x in ("ids", "sizes", "nodes")}
        size = table["sizes"].to_numpy().astype(np.int64)
        key, frequency = joined(numbers(of(0, "keys"))), joined(numbers(of(0, "counts"), np.uint16), np.uint16)
        often, frequent = joined(numbers(of(1, "keys"))), key & PLACE == PLACE
        if len(often):
            names, f = key[frequent], frequency[frequent]
            order = np.argsort(names)
            f = f[order][np.searchsorted(names[order] >> np.uint64(16), often >> np.uint64(16))]
            key, frequency = np.append(key[~frequent], often), np.append(frequency[~frequent], f)
        place, token = (key & PLACE).astype(np.int64), (key >> np.uint64(16)).astype(np.int64)
        shared = np.bincount(place, minlength=len(size))
        need = (size * percent + 99) // 100
        passing = (size > 0) & (shared >= need)
        mine = passing[place]
        place, token, frequency = place[mine], token[mine], frequency[mine]
        by_hash, by_rank = np.lexsort((token, place)), np.lexsort((token, frequency, place))
        first = np.searchsorted(place[by_hash], np.arange(len(size) + 1))
        within = np.arange(len(token)) - first[place[by_rank]]
        ranked = token[by_rank][within <= (shared - need)[place[by_rank]]]
        blank = ~passing
        lists = lambda flat, each: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.where(passing, each, 0))), pa.int32()), pa.array(flat), mask=pa.array(blank))
        held = np.zeros((int(passing.sum()), BITS), bool)
        held[(np.cumsum(passing) - 1)[place], token & (BITS - 1)] = True
        signs = np.packbits(held, axis=1, bitorder="little").view(np.int64).ravel()
        hashes = token[by_hash]
        members = [hashes[a:z].tobytes() if p else None for a, z, p in zip(first.tolist(), first[1:].tolist(), passing.tolist(), strict=False)]
        seat = (rows["batch"][0].as_py() << 16) + np.arange(len(size))
        return pa.Table.from_arrays(
            [table["ids"], pa.array(size), table["nodes"], pa.array(seat), pa.array(shared.astype(np.int32)), lists(ranked, shared - need + 1), pa.array(members, pa.binary()), lists(signs, WORDS)],
            ["doc_id", "n_shingles", "node", "seat", "shared", "prefix", "members", "bits"])

    return replies.groupBy("batch").applyInArrow(run, ROWS)


def needed(size_a: Column, size_b: Column, percent: int) -> Column:
    """The smallest intersection at which sets of these sizes link."""
    return F.ceil((size_a + size_b).cast("long") * percent / (100 + percent))


def passes(a: str, b: str, percent: int) -> Column:
    """Length and positional filter on two rows of one shingle (columns size_x and pos_x), met if it is the first that two linked sets share."""
    sa, sb, pa_, pb = (F.col(f"{k}_{x}") for k in ("size", "pos") for x in (a, b))
    length = F.least(sa, sb).cast("long") * 100 >= F.greatest(sa, sb).cast("long") * percent
    return length & (F.least(sa - pa_, sb - pb) >= needed(sa, sb, percent))


def suffix(a: str, b: str, percent: int) -> Column:
    """Suffix filter on two rows (columns size_x, shared_x and bits_x): a range that only one set occupies costs that set a member."""
    x, y = F.col(f"bits_{a}"), F.col(f"bits_{b}")
    alone = lambda p, q: reduce(lambda s, t: s + t, [F.bit_count(p[i].bitwiseAND(F.bitwise_not(q[i]))) for i in range(WORDS)])
    most = F.least(F.col(f"shared_{a}") - alone(x, y), F.col(f"shared_{b}") - alone(y, x))
    return most >= needed(F.col(f"size_{a}"), F.col(f"size_{b}"), percent)


def named(df: DataFrame, end: str, *names: str) -> DataFrame:
    return df.select("token", *[F.col(c).alias(f"{c}_{end}") for c in names])


class Sets:
    """The sets that may link (node, size, shared, bits), their members in rows, and the pairs verified so far."""

    def __init__(self, reps: DataFrame, rows: DataFrame, percent: int):
        self.reps, self.rows, self.percent, self.tested, self.links = reps, rows, percent, [], []

    def verify(self, pairs: DataFrame) -> bool:
        """Verifies those pairs (a, b) that pass the suffix filter and were not verified before; whether any links."""
        of = lambda x: self.reps.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("seat", "size", "shared", "bits")])
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for old in self.tested:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        near = stored(pairs.join(of("a"), "a").join(of("b"), "b").where(suffix("a", "b", self.percent)).select("a", "b", "seat_a", "seat_b", "size_a", "size_b"))
        wanted = stored(near.select(F.explode(F.array("seat_a", "seat_b")).alias("seat")).distinct())
        members = having_keys(self.rows.select("seat", "members"), wanted, "seat")
        both = near.join(members.select(F.col("seat").alias("seat_b"), F.col("members").alias("members_b")), "seat_b")
        both = both.join(members.select(F.col("seat").alias("seat_a"), F.col("members").alias("members_a")), "seat_a")
        percent = self.percent

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                total = column(batch, "size_a").to_numpy() + column(batch, "size_b").to_numpy()
                for x, y, s in zip(column(batch, "members_a"), column(batch, "members_b"), total.tolist(), strict=True):
                    x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                    at = np.searchsorted(y, x)
                    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    keep.append(100 * common >= percent * (s - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        found = stored(both.select("a", "b", "size_a", "size_b", "members_a", "members_b").mapInArrow(compare, "a long, b long"))
        dropped(wanted)
        self.tested.append(near.select("a", "b"))
        self.links.append(found)
        return not found.isEmpty()

    def merged(self) -> DataFrame:
        """(node, component) of every set that links."""
        return components(reduce(DataFrame.union, self.links)).withColumnRenamed("id", "node")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of an edge reaches, by alternating star contractions."""
    edges, old = edges.where(F.col("a") != F.col("b")), None
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    while True:
        low = both(edges).groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # every larger neighbour moves to the smallest one around
        large = both(edges).where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
        # every smaller neighbour, and the vertex itself, moves to the smallest
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(least.select("a", F.col("m").alias("b"))).distinct()
        small = stored(small)
        if old is not None:
            dropped(old)
        # done when every vertex has one edge, and that to a root
        heads = small.groupBy("a").agg(F.count("*").alias("n"))
        open_ = small.select(F.col("b").alias("a")).distinct().join(heads, "a", "left_semi").limit(1).count() or heads.where("n > 1").limit(1).count()
        if not open_:
            return small.select(F.col("a").alias("id"), F.col("b").alias("component")).union(small.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        edges = old = small


def star(tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): within each token, every member with the one of fewest shingles of its own, which in a group of near copies is edited least."""
    sides = tokens.select(*[F.col(c).alias(f"{c}_x") for c in ("node", "size", "pos")], *[F.col(f"first.{c}").alias(f"{c}_y") for c in ("node", "size", "pos")])
    return sides.where((F.col("node_x") != F.col("node_y")) & passes("x", "y", percent)).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


def between(tokens: DataFrame, merged: DataFrame) -> DataFrame:
    """The rows of tokens whose members lie in several components, with these and each token's largest."""
    known = tokens.select("token", "node", "size", "pos", "single").join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = known.groupBy("token", "component").agg(F.count("*").alias("k")).groupBy("token")
    mixed = sizes.agg(F.count("*").alias("parts"), F.max(F.struct("k", "component"))["component"].alias("largest")).where("parts > 1").drop("parts")
    return stored(known.join(mixed, "token"))


def hubs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): within each token, every member outside its largest component with HUBS members of that one, again those edited least."""
    least = lambda k: F.min(F.when(F.pmod(F.xxhash64("node"), F.lit(HUBS)) == k, F.struct("single", "node", "size", "pos")))
    inside = rest.where("component = largest").groupBy("token").agg(F.array(*[least(k) for k in range(HUBS)]).alias("hub"))
    inside = inside.select("token", F.explode("hub").alias("hub")).where("hub IS NOT NULL").select("token", "hub.node", "hub.size", "hub.pos")
    pairs = named(inside, "x", "node", "size", "pos").join(named(rest.where("component <> largest"), "y", "node", "size", "pos"), "token")
    return pairs.where(passes("x", "y", percent)).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


def crossed(rest: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of rows of one token in different components that pass all filters; sets that link are in one or two neighbouring size classes."""
    names = ["node", "size", "pos", "component", "shared", "bits"]
    wide = rest.join(reps.select("node", "shared", "bits"), "node")
    size_class = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent * 1.0001))).cast("int")
    early = F.col("size") - F.col("pos") >= needed(F.col("size"), F.col("size"), percent)  # no partner of a smaller set needs less
    smaller = named(wide.where(early), "x", *names).withColumn("class", F.explode(F.array(*[F.floor(F.log(F.col("size_x").cast("double")) / F.log(F.lit(100.0 / percent * 1.0001))).cast("int") + k for k in (0, 1)])))
    larger = named(wide.withColumn("class", size_class), "y", *names, "class").withColumnRenamed("class_y", "class")
    once = (F.col("size_x") < F.col("size_y")) | ((F.col("size_x") == F.col("size_y")) & (F.col("node_x") < F.col("node_y")))
    pairs = smaller.join(larger, ["token", "class"]).where(once & (F.col("component_x") != F.col("component_y")) & passes("x", "y", percent) & suffix("x", "y", percent))
    return pairs.select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


@tidy
def join(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each document."""
    texts = few_rows(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // BUCKET_BYTES).bit_length(), BUCKETS[0]), BUCKETS[1])
    rows = stored(assembled(counted(sent(texts, n, bits)), percent))
    filled = rows.where(F.col("members").isNotNull())
    seats = stored(filled.groupBy("node").agg(F.min("seat").alias("seat")).select("seat"))
    reps = stored(having_keys(filled.select("node", "seat", F.col("n_shingles").cast("int").alias("size"), "shared", "prefix", "bits"), seats, "seat"))

    tokens = reps.select("node", "size", (F.col("size") - F.col("shared")).alias("single"), F.posexplode("prefix").alias("nth", "token")).withColumn("pos", F.col("single") + F.col("nth")).drop("nth")
    several = tokens.groupBy("token").agg(F.count("*").alias("count"), F.min(F.struct("single", "node", "size", "pos")).alias("first")).where("count > 1").drop("count")
    tokens = stored(tokens.join(several, "token"))
    sets = Sets(reps.drop("prefix"), rows, percent)
    sets.verify(star(tokens, percent))
    rest = between(tokens, merged := sets.merged())
    if sets.verify(hubs(rest, percent)):
        rest = between(rest, merged := sets.merged())
    if sets.verify(crossed(rest, reps, percent)):
        merged = sets.merged()

    lows = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("low")).join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    named_ = lows.join(least, "component").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(named_, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
