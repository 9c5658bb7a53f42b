"""As-of joins: for every row the last row of another table at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.sources.scratch import stored


def asof_join(left: DataFrame, right: DataFrame, time: str, right_time: str, values: list[str], by: list[str] | None = None) -> DataFrame:
    """left with values of right's last row at or before its time, and that row's time as right_time; nulls where there is none.

    by: columns of both that must be equal, null to null. Of right's rows of one time the largest values count; rows of right without a time
    never do, and rows of left without one find nothing.

    Only distinct times travel. They are dealt into ranges of (by, time), so a group of any size spreads over tasks; each range is filled
    forward on its own, and what a range begins with comes from the last known row of the ranges before it: one row for each range and group.
    """
    by = by or []
    keys = [f"by_{i}" for i in range(len(by))]
    named = lambda df, t: df.where(F.col(t).isNotNull()).select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(t).alias("t_"), *([] if df is left else values))
    asked = named(left, time).distinct().withColumn("value_", F.lit(None))
    known = named(right, right_time).groupBy(*keys, "t_").agg(F.max(F.struct(F.col("t_").alias(right_time), *values)).alias("value_"))
    every = known.select(*keys, "t_", "value_", F.lit(False).alias("asks")).union(asked.select(*keys, "t_", F.lit(None).cast(known.schema["value_"].dataType), F.lit(True)))
    ranged = stored(every.repartitionByRange(*keys, "t_").withColumn("part_", F.spark_partition_id()))
    w = W.partitionBy("part_", *keys).orderBy("t_", "asks").rowsBetween(W.unboundedPreceding, 0)  # a known row comes before one that asks at its time
    filled = ranged.withColumn("found_", F.last("value_", ignorenulls=True).over(w)).where("asks")
    edges = ranged.groupBy("part_", *keys).agg(F.max_by("value_", F.when(F.col("value_").isNotNull(), F.col("t_"))).alias("edge_"))
    carried = edges.select("part_", *keys, F.last("edge_", ignorenulls=True).over(W.partitionBy(*keys).orderBy("part_").rowsBetween(W.unboundedPreceding, -1)).alias("carried_"))
    same = [F.col("part_") == F.col("p_"), *[F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]]
    both = filled.join(carried.withColumnsRenamed({"part_": "p_"} | {k: f"of_{k}" for k in keys}), same)
    out = both.select(*[F.col(k) for k in keys], "t_", F.coalesce("found_", "carried_").alias("found_"))
    match = [F.col(time) == F.col("t_"), *[F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys, strict=True)]]
    return left.join(out, match, "left").select(*[F.col(f"`{c}`") for c in left.columns], *[F.col("found_")[c].alias(c) for c in [right_time, *values]])
