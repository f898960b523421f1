"""Sinks: partitioned run tables, page documents and ledgers keyed by columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def write_run(rows: DataFrame, path: str) -> None:
    """Run rows by configuration and page; a page that is run again replaces its own partition only."""
    rows.write.partitionBy("config_slug", "page_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def merge_ledger(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; where keys meet, the new row stands, of several new ones the last by its JSON text. Null keys meet each other."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc(F.to_json(F.struct("*")))))
    return both.withColumn("_rank", first).filter("_rank = 1").drop("_rank", "_new")
