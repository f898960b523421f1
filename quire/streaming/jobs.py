"""Page jobs as a stream: latest state per job, and work that isn't done yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_state(events: DataFrame, key: str = "user_id") -> DataFrame:
    """The last event of each key by (ts, event_id); works on tables and, in complete or update mode, on streams."""
    last = F.max(F.struct("ts", "event_id", "event_type")).alias("last")
    return events.groupBy(key).agg(last).select(key, "last.event_id", F.col("last.event_type").alias("state"))


def read_jobs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def process(jobs: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, keys: list[str]):
    """Runs work on jobs that out doesn't have yet, once for each micro-batch; starting again goes on where it ended."""

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        todo = rows.dropDuplicates(keys)
        path = spark._jvm.org.apache.hadoop.fs.Path(out)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            done = spark.read.parquet(out).select(*(F.col(k).alias(f"_done_{k}") for k in keys))
            same = [F.col(k).eqNullSafe(F.col(f"_done_{k}")) for k in keys]  # a null key is done once, too
            todo = todo.join(done, same, "left_anti")
        work(todo).write.mode("append").parquet(out)

    return jobs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
