"""Shared pieces of the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and Python syntax for one word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Bounds an Arrow batch by rows and by bytes, so that long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it's unset, one of our own will do in local mode
    only: on a cluster no folder of this machine is shared."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and goes on from there: computed once, safe against lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def forget_at_exit(spark: SparkSession, path: str) -> str:
    """Has the driver delete path, in any store that Spark writes to, when it ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def saved(df: DataFrame, free: bool = False) -> DataFrame:
    """Like cut(), but as a table: compressed, by columns, in files of the session's advisory size rather than one for
    each task. With free, the driver then looks for garbage, so that shuffle files which only led up to df are deleted
    now, not at some later collection."""
    spark, schema = df.sparkSession, df.schema
    path = forget_at_exit(spark, f"{shared_dir(spark)}/saved-{uuid.uuid4().hex}")
    df.hint("rebalance").write.option("compression", "zstd").parquet(path)
    del df
    for _ in range(2 * free):  # plans are held by frames of Python, by events that aren't handled yet, and by what the first round finalizes
        gc.collect()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
    return spark.read.schema(schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def maybe_broadcast(df: DataFrame, rows: int, limit: int = 50_000) -> DataFrame:
    """A broadcast hint for a side whose rows have been counted and are few; else Spark's own choice of join."""
    return F.broadcast(df) if rows <= limit else df
