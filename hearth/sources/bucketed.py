"""Tables dealt into buckets by their keys, so that merges shuffle the batch and never the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """df under path, one sorted file a bucket of its keys; read again as such a table."""
    name = f"hearth_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, keys: list[str], buckets: int) -> DataFrame:
    """What write_bucketed() left under path, in this or an earlier session; keys and buckets must be those of the writing."""
    name, by = f"hearth_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(path).dtypes)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
