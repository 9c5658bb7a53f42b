"""Tables written between steps, in the folder that the session shares (spark.checkpoint.dir)."""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a key table up to which it is broadcast; beyond it the join shuffles.
BROADCAST_KEYS = 1 << 18
_open = threading.local()


def folder(spark: SparkSession) -> str:
    """The shared folder; where none is set, a temporary one if all of Spark runs in this one process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="hearth-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def place(spark: SparkSession) -> str:
    """A new folder in the shared one; tidy() deletes it as if stored() had written it."""
    path = f"{folder(spark)}/hearth-{uuid.uuid4().hex}"
    for made in getattr(_open, "made", [])[-1:]:
        made.append((spark, path))
    return path


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet and read again: its lineage is cut and survives the loss of executors."""
    path = place(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def dropped(*tables: DataFrame) -> None:
    """Deletes what stored() wrote; nothing may read these tables any more."""
    for df in tables:
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, parent)


def _read_paths(df: DataFrame) -> str:
    """The files that df reads, and the folders also beneath persisted tables, which read them when first used or when blocks are lost; inputFiles() names none of those."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = [leaf.relation() for leaf in map(leaves.apply, range(leaves.size())) if leaf.nodeName() == "LogicalRelation"]
    return " ".join(df.inputFiles() + [r.location().rootPaths().mkString(" ") for r in found if r.getClass().getSimpleName() == "HadoopFsRelation"])


def tidy(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Deletes what run stored when it ends, but for the tables that its result reads, persisted or not; when it fails, all of them."""

    @functools.wraps(run)
    def wrapped(*args, **kwargs) -> DataFrame:
        _open.made = [*getattr(_open, "made", []), []]
        reads = ""
        try:
            out = run(*args, **kwargs)
            reads = _read_paths(out)
            return out
        finally:
            made = _open.made.pop()
            for spark, path in made:
                if path.rsplit("/", 1)[1] not in reads:
                    _delete(spark, path)
                else:
                    for outer in _open.made[-1:]:
                        outer.append((spark, path))

    return wrapped


def having_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key is in keys, a stored table: a broadcast if it is small, else a hash join without a sort of df."""
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if small else keys.hint("shuffle_hash"), key, "left_semi")
