"""Reading and writing tables, exports, pages, metrics cards and model packages."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.schema import RAW_COLUMNS, SENTINEL, conform


def read_table(spark: SparkSession, path: str, where: Column | None = None, cols: list[str] | None = None) -> DataFrame:
    """A Parquet table; the filter and the choice of columns reach the scan."""
    df = spark.read.parquet(path)
    df = df if where is None else df.where(where)
    return df if cols is None else df.select(*cols)


def table_columns(df: DataFrame) -> DataFrame:
    """(column, type) of a table, for introspection."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def write_csv(df: DataFrame, path: str, cols: list[str] = RAW_COLUMNS) -> None:
    """All columns in schema order, with a header line in each file."""
    df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with every column as text; empty stays empty, nothing is taken for null."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in schema.fieldNames())).option("header", True).option("escape", '"').csv(path).na.fill("")


def create_table(spark: SparkSession, schema: StructType, path: str) -> None:
    """An empty table of declared types."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def write_pages(pages: DataFrame, path: str, key: str, html: str = "html") -> None:
    """Each page as a gzip file of its own, in a folder that names its key (key=<value>); keys are unique, null texts are left out.

    A file takes far longer than its bytes, so rows of fewer tasks than cores are dealt out first. Tasks move their own files into place (the committer's second algorithm): by the first, the driver would move them one after the other when all have ended.
    """
    rows = pages.where(F.col(html).isNotNull()).select(F.col(key), F.col(html).alias("value"))
    cores = pages.sparkSession.sparkContext.defaultParallelism
    rows = rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)
    rows.write.mode("overwrite").partitionBy(key).option("compression", "gzip").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html, and the keys that folders name) of saved pages, one file each; gzip is transparent. Small files share tasks by their size; the line end that ends a file is no part of its page."""
    files = spark.read.text(path, wholetext=True)
    keys = [c for c in files.columns if c != "value"]
    return files.select(F.input_file_name().alias("url"), F.regexp_replace("value", r"\n\z", "").alias("html"), *keys)


def fresh(df: DataFrame, ts_col: str, as_of: Column, ttl_hours: int = 24) -> DataFrame:
    """Rows no older than the time to live."""
    return df.where(F.col(ts_col) >= as_of - F.make_dt_interval(hours=F.lit(ttl_hours)))


def restore_sentinel(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing text as the sentinel, for exports."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(SENTINEL)) for c in cols})


def migrate(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the columns that a newer schema adds."""
    return conform(df, schema)


def write_card(metrics: DataFrame, path: str) -> None:
    """The metrics card: (model, segment, metric, value) rows as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def save_package(models: dict[str, PipelineModel], params: DataFrame, path: str) -> None:
    """Fitted pipelines by name and a table of parameters."""
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/{name}")
    params.write.mode("overwrite").parquet(f"{path}/params")


def load_package(spark: SparkSession, path: str, names: list[str]) -> tuple[dict[str, PipelineModel], DataFrame]:
    return {n: PipelineModel.load(f"{path}/{n}") for n in names}, spark.read.parquet(f"{path}/params")
