"""Distributed order statistics and deterministic random numbers."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def random_order(key: Column, seed: int) -> Column:
    """A text whose order is random to the key; the same in any engine that has md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of random_order."""
    return F.conv(F.substring(random_order(key, seed), 1, 8), 16, 10).cast("double") / 4294967296.0


def deals(n: int, count: int, seed: int) -> list[tuple[int, int]]:
    """Pairs (a, b) with a prime to n: i -> (a i + b) mod n deals n positions anew without a sort, in 64 bits."""
    draw, most, out = random.Random(seed), max(1, min(n, 2**62 // max(n, 1))), []
    for _ in range(count):
        a = draw.randint(1, most)
        while math.gcd(a, n) > 1:
            a = draw.randint(1, most)
        out.append((a, draw.randrange(max(n, 1))))
    return out


def dense_index(df: DataFrame, order: list[Column], name: str = "index") -> DataFrame:
    """df with positions 0, 1, 2... by order, without a window over all rows.

    Rows are sorted in ranges; only the number of rows of each range is gathered.  order must be total, and
    the ranged frame is kept while it is read twice.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = ranged.withColumn("part_", F.spark_partition_id()).withColumn("at_", F.monotonically_increasing_id()).persist()
    counts = local.groupBy("part_").agg(F.count("*").alias("n"), F.min("at_").alias("first_"))
    before = counts.withColumn("before_", F.coalesce(F.sum("n").over(W.orderBy("part_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("part_", "first_", "before_")
    return local.join(F.broadcast(before), "part_").withColumn(name, F.col("at_") - F.col("first_") + F.col("before_")).drop("part_", "at_", "first_", "before_")


def grouped_quantiles(df: DataFrame, by: list[str], values: dict[str, Column], fractions: list[float], extra: tuple[Column, ...] = (), accuracy: int = 10_000, plain: int = 100_000) -> DataFrame:
    """One row for each group (by may be empty; null is a group): by, the aggregates extra, n_<name> and <name>, an array of the
    interpolated quantiles of each value, exactly, nulls and NaN aside. A place within a millionth of a whole one is that one; without values the array holds nulls.

    Ranks are selected for all groups at once. A sketch bounds each wanted rank of each group within about n / accuracy places. A second
    pass over df, which should be a stored table, counts what lies below those bounds and the values between them, so no task holds or sorts more than a
    few n / accuracy values of a group. Up to `plain` values of a group the bounds are left open; the result is the same.
    """
    at = F.array(*[F.lit(float(f)) for f in fractions])
    edges = F.array(*[F.lit(min(1.0, max(0.0, f + s / accuracy))) for f in fractions for s in (-3, 3)])
    number = {name: f"v_{i}" for i, name in enumerate(values)}
    known = lambda c: F.when(~F.isnan(c.cast("double")), c.cast("double"))
    rows = df.select(*[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)], *[known(c).alias(number[n]) for n, c in values.items()])
    keys = [f"by_{i}" for i in range(len(by))]
    sketched = df.select("*", *[known(c).alias(number[n]) for n, c in values.items()]).groupBy(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)])
    sketch = sketched.agg(*extra, *[F.struct(F.count(v).alias("n"), F.approx_percentile(v, edges, accuracy).alias("e")).alias(f"s_{v}") for v in number.values()])
    told = sketch.select(*[F.col(k).alias(f"of_{k}") for k in keys], *[f"s_{v}" for v in number.values()])

    def beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
        return left.join(right, same, how) if keys else left.join(F.broadcast(right), how=how) if how == "left" else left.crossJoin(F.broadcast(right))

    one = lambda i, j, v: F.struct(F.lit(i * len(fractions) + j).alias("j"), F.col(v).alias("v"), F.col(f"s_{v}.n").alias("n"), F.get(F.col(f"s_{v}.e"), F.lit(2 * j)).alias("lo"), F.get(F.col(f"s_{v}.e"), F.lit(2 * j + 1)).alias("hi"))
    each = F.array(*[one(i, j, v) for i, v in enumerate(number.values()) for j in range(len(fractions))])
    near = beside(rows, told, "inner").select(*keys, F.explode(each).alias("r")).select(*keys, "r.*").where(F.col("v").isNotNull() & ((F.col("n") <= plain) | (F.col("v") <= F.col("hi"))))
    least = F.when((F.col("n") > plain) & (F.col("v") < F.col("lo")), F.lit(float("-inf"))).otherwise(F.col("v"))
    counts = near.groupBy(*keys, "j", least.alias("v")).agg(F.count("*").alias("c"), F.first("n").alias("n"))
    up_to = counts.withColumn("upto", F.sum("c").over(W.partitionBy(*keys, "j").orderBy("v")))
    exact = F.get(at, (F.col("j") % len(fractions)).cast("int")) * (F.col("n") - 1)
    place = F.when(F.abs(exact - F.round(exact)) < 1e-6, F.round(exact)).otherwise(exact)
    first = lambda k: F.min(F.when(F.col("upto") > k, F.col("v")))
    picked = up_to.groupBy(*keys, "j", "n").agg(first(F.floor(place)).alias("a"), first(F.ceil(place)).alias("b"))
    share = place - F.floor(place)
    q = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((1 - share) * F.col("a") + share * F.col("b"))
    found = picked.groupBy(*[F.col(k).alias(f"of_{k}") for k in keys]).agg(F.map_from_entries(F.collect_list(F.struct("j", q.alias("q")))).alias("m"))
    out = beside(sketch, found, "left")
    got = lambda i: F.array(*[F.try_element_at("m", F.lit(i * len(fractions) + j)) for j in range(len(fractions))])
    kept = [c for c in sketch.columns if c not in keys and not c.startswith("s_v_")]
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], *kept, *[x for i, (n, v) in enumerate(number.items()) for x in (F.col(f"s_{v}.n").alias(f"n_{n}"), got(i).alias(n))])


def grouped_medians(df: DataFrame, by: list[str], values: dict[str, Column], extra: tuple[Column, ...] = ()) -> DataFrame:
    """One row for each group: by, the aggregates extra and the exact median of each value by its name."""
    made = grouped_quantiles(df, by, values, [0.5], extra)
    return made.select(*[c for c in made.columns if c not in values and c not in {f"n_{n}" for n in values}], *[F.col(n)[0].alias(n) for n in values])


def exact_quantiles(df: DataFrame, value: Column, fractions: list[float], accuracy: int = 10_000, plain: int = 100_000) -> DataFrame:
    """One row (n, q): the interpolated quantiles of value as grouped_quantiles() finds them, q an array in order of fractions."""
    return grouped_quantiles(df, [], {"q": value}, fractions, (), accuracy, plain).select(F.col("n_q").alias("n"), "q")
