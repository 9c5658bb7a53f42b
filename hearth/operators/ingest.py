"""Merging batches of listings into a keyed table, and the queue of pending work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.text import norm_address
from hearth.schema import KEY


def search_space(spark: SparkSession, communes: list[str], markets: list[str], kinds: list[str]) -> DataFrame:
    """All searches: every commune, market and kind of home."""
    one = lambda name, values: spark.createDataFrame([(v,) for v in values], f"{name} string")
    return one("comuna", communes).crossJoin(one("operacion", markets)).crossJoin(one("tipo", kinds))


def searches_of(listings: DataFrame) -> DataFrame:
    """All searches over the communes, markets and kinds that listings name; three small tables crossed."""
    one = lambda c: listings.select(c).where(F.col(c).isNotNull()).distinct()
    return one("comuna").crossJoin(one("operacion")).crossJoin(one("tipo"))


def frontier(space: DataFrame, n_pages: int, page_size: int = 48, base: str = "https://www.portalinmobiliario.com") -> DataFrame:
    """One URL for each search and page of results."""
    pages = space.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))))
    offset = F.col("page") * page_size
    suffix = F.when(offset > 0, F.concat(F.lit("_Desde_"), (offset + 1).cast("string"))).otherwise("")
    return pages.withColumn("url", F.concat(F.lit(f"{base}/"), "operacion", F.lit("/"), "tipo", F.lit("/"), "comuna", F.lit("-metropolitana/"), suffix))


def merge_partial(base: DataFrame, batch: DataFrame, fields: list[str], keys: list[str] = KEY, null_policy: str = "keep", insert: bool = True) -> DataFrame:
    """base with fields refreshed from batch (unique keys); other columns stay as they are.

    null_policy: "keep" never replaces a value by null, "overwrite" takes what the batch says.  With insert,
    rows of new keys are added.
    """
    new = batch.select(*keys, *[F.col(f).alias(f"new_{f}") for f in fields], F.lit(True).alias("in_batch"))
    joined = base.withColumn("in_base", F.lit(True)).join(new, keys, "full_outer" if insert else "left")
    pick = lambda f: F.coalesce(f"new_{f}", f) if null_policy == "keep" else F.when(F.col("in_batch"), F.col(f"new_{f}")).otherwise(F.col(f))
    return joined.select(*[pick(c).alias(c) if c in fields else F.col(c) for c in base.columns])


def update_detail(base: DataFrame, detail: DataFrame, fields: list[str], keys: list[str] = KEY) -> DataFrame:
    """base with what details (unique keys) give, never a null, and detalle_ok = 1 where there is one; unknown keys add nothing."""
    return merge_partial(base, detail.withColumn("detalle_ok", F.lit(1)), [*fields, "detalle_ok"], keys, insert=False)


def upsert_latest(base: DataFrame, batch: DataFrame, order: list[str], keys: list[str] = KEY) -> DataFrame:
    """All rows of both, one for each key: the one that is last by order."""
    every = base.unionByName(batch, allowMissingColumns=True)
    latest = F.max_by(F.struct(*every.columns), F.struct(*order)).alias("r")
    return every.groupBy(*[F.col(k).alias(f"key_{k}") for k in keys]).agg(latest).select("r.*")


def upsert_keyed(base: DataFrame, batch: DataFrame, order: list[str], keys: list[str] = KEY) -> DataFrame:
    """upsert_latest() where base has unique keys, which need a value: a join on the keys, so that a base in buckets of its keys stays where it is.

    Of equal order the batch's row counts; a missing order is older than any.
    """
    cols = base.columns
    latest = F.max_by(F.struct(*cols), F.struct(*order)).alias("new")
    new = batch.groupBy(*keys).agg(latest)
    both = base.withColumn("old", F.struct(*cols)).select(*keys, "old").join(new, keys, "full_outer")
    at = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    wins = F.col("old").isNull() | (F.col("new").isNotNull() & (at("new") >= at("old")))
    return both.select(F.when(wins, F.col("new")).otherwise(F.col("old")).alias("r")).select("r.*")


def pending(todo: DataFrame, done: DataFrame, keys: list[str] = KEY, limit: int | None = None) -> DataFrame:
    """Rows of todo whose key isn't done; limit takes the first by key."""
    left = todo.join(done.select(*keys), keys, "left_anti")
    return left if limit is None else left.orderBy(*keys).limit(limit)


def drop_artefacts(df: DataFrame) -> DataFrame:
    """Cards without a listing id are advertisements."""
    return df.where(F.col("id_aviso").isNotNull() & (F.col("id_aviso") != ""))


def cross_listed(df: DataFrame, price: str = "precio_uf") -> DataFrame:
    """Groups of listings with one address, area and price under several ids."""
    known = df.where(F.col("direccion").isNotNull() & F.col("m2_util").isNotNull() & F.col(price).isNotNull())
    groups = known.groupBy(norm_address(F.col("direccion")).alias("address"), "m2_util", F.col(price).alias("price"))
    return groups.agg(F.count_distinct("id_aviso").alias("n_ids"), F.min("id_aviso").alias("first_id")).where("n_ids > 1")


def write_back(df: DataFrame, computed: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """df with a column filled from computed where it has the key; what it holds stays otherwise."""
    new = computed.select(*keys, F.col(column).alias("written"))
    old = F.col(column) if column in df.columns else F.lit(None)
    return df.join(new, keys, "left").withColumn(column, F.coalesce("written", old)).drop("written")


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces the partitions that df has rows for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def unique_latest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by order."""
    return df.withColumn("nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("nth = 1").drop("nth")
