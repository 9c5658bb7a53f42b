"""Restartable ingest: files of raw listings merged into a keyed table by micro-batches.

The table is dealt into buckets by a hash of its keys.  A batch reads and writes the buckets that its keys fall into and no
others, under a folder of its own (v<batch>/bucket_=<n>); a small manifest (m<batch>) then says for every bucket which
batch wrote it last.  Readers take the last complete manifest.  A batch that runs again starts from the manifest
before it and writes the same; folders that none of the last `keep` manifests names are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hearth.operators.ingest import merge_partial, unique_latest
from hearth.schema import KEY

MANIFEST = "bucket int, version long"
LAST = 10**9 - 1


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def stream_merge(spark: SparkSession, source: str, schema: StructType, table: str, checkpoint: str, fields: list[str], order: str, keys: list[str] = KEY, buckets: int = 64, keep: int = 3) -> StreamingQuery:
    """Merges every new file under source into the table; one that is merged twice changes nothing more.

    Within a batch the last row of a key by order counts. The number of buckets must stay as it was when the table began.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(spark, batch, number, schema, table, fields, order, keys, buckets, keep)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_batch(spark: SparkSession, batch: DataFrame, number: int, schema: StructType, table: str, fields: list[str], order: str, keys: list[str] = KEY, buckets: int = 64, keep: int = 3) -> None:
    """One batch into the table, as version `number`; keep is at least 2, so that it can run again."""
    new = unique_latest(batch, keys, [F.desc(order)]).select(*keys, *fields).withColumn("bucket_", bucket_of(keys, buckets)).persist()
    touched = sorted(r[0] for r in new.select("bucket_").distinct().collect())  # no more than buckets
    held = manifest_before(spark, table, number)
    if touched:
        base = read_buckets(spark, table, {b: held[b] for b in touched if b in held}, schema).withColumn("bucket_", bucket_of(keys, buckets))
        # both sides are dealt by bucket, so that the join and the write need no other shuffle
        merged = merge_partial(base.repartition(len(touched), "bucket_"), new.repartition(len(touched), "bucket_"), fields, ["bucket_", *keys])
        merged.write.mode("overwrite").partitionBy("bucket_").parquet(f"{table}/v{number:09d}")
    new.unpersist()
    now = held | dict.fromkeys(touched, number)
    spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{table}/m{number:09d}")
    expire(spark, table, keep)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, table: str, kind: str) -> list[int]:
    """Batches that left a complete manifest (kind m) or a folder of buckets (kind v), oldest first."""
    at, fs = _files(spark, table)
    if not fs.exists(at):
        return []
    made = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith(kind)]
    return sorted(int(p.getName()[1:]) for p in made if kind == "v" or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def manifest_before(spark: SparkSession, table: str, number: int = LAST) -> dict[int, int]:
    """For each bucket the batch that wrote it last, as of the last complete batch before number."""
    older = [n for n in numbers(spark, table, "m") if n < number]
    return {r["bucket"]: r["version"] for r in spark.read.schema(MANIFEST).parquet(f"{table}/m{older[-1]:09d}").collect()} if older else {}


def read_buckets(spark: SparkSession, table: str, held: dict[int, int], schema: StructType) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table}/v{v:09d}/bucket_={b}" for b, v in sorted(held.items())])


def current(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The table as the last complete batch left it."""
    return read_buckets(spark, table, manifest_before(spark, table), schema)


def expire(spark: SparkSession, table: str, keep: int) -> None:
    """Deletes older manifests than the last `keep`, and the buckets that no kept manifest names."""
    made = numbers(spark, table, "m")
    kept = made[-max(2, keep) :]
    needed = {(v, b) for n in kept for b, v in manifest_before(spark, table, n + 1).items()}
    for n in made[: -len(kept)] if kept else []:
        at, fs = _files(spark, f"{table}/m{n:09d}")
        fs.delete(at, True)
    for v in (v for v in numbers(spark, table, "v") if kept and v < kept[0]):
        at, fs = _files(spark, f"{table}/v{v:09d}")
        found = [s.getPath() for s in fs.listStatus(at) if "=" in s.getPath().getName()]
        gone = [p for p in found if (v, int(p.getName().split("=")[1])) not in needed]
        for p in gone:
            fs.delete(p, True)
        if len(gone) == len(found):
            fs.delete(at, True)
