"""Sources: parquet tables, page text files, JSON prediction maps and CSV ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, line_no, text): documents broken at line ends, in order from 1. Null texts have none."""
    parts = docs.select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    return parts.select("doc_id", "source", "lang", (F.col("at") + 1).alias("line_no"), "text")


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction documents (one JSON each) as rows (model_tag, page_id, line_id, pred_greedy, pred_beam, non_character, glyph_count, ink_ratio)."""
    line = "STRUCT<column: INT, pred_greedy: STRING, pred_beam: STRING, non_character: BOOLEAN, glyph_count: INT, ink_ratio: DOUBLE>"
    raw = spark.read.schema(f"model_tag STRING, base_id STRING, target STRING, lines MAP<STRING, {line}>").option("multiLine", True).json(path)
    rows = raw.select("model_tag", F.col("base_id").alias("page_id"), F.explode("lines").alias("line_id", "l"))
    return rows.select("model_tag", "page_id", "line_id", "l.*").withColumn("non_character", F.coalesce("non_character", F.lit(False))).withColumn("ink_ratio", F.coalesce("ink_ratio", F.lit(0.0)))


def ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV ledger with a header, quotes doubled, and line ends within fields."""
    return spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"').csv(path)


def label_files(spark: SparkSession, path: str) -> DataFrame:
    """(line_id, text) of text files, one label each; line ends at their end don't count."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return files.select(F.regexp_extract("file", r"([^/]+)\.[^./]+$", 1).alias("line_id"), F.regexp_replace("text", r"\n+$", "").alias("text"))
