"""Chunked token files.

The reference stores tokenized reviews as CSV files of 100,000 rows each, named
by the first row. ``maxRecordsPerFile`` is only a per-task ceiling, so exact
chunks carry an explicit chunk id (the start row) from an exact row index, and
the write is partitioned by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.functions.text import tokens_from_json, tokens_to_json
from reviewkit.operators.ranking import as_list, rank_by_key

# --- fixed values ------------------------------------------------------------
CHUNK_ROWS = 100_000
# -----------------------------------------------------------------------------


def assign_chunks(df: DataFrame, key: str | Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunk id = start row of the chunk, rows counted in key order."""
    r = rank_by_key(df, key, "__r")
    return r.withColumn("chunk", (F.floor((F.col("__r") - 1) / chunk_rows) * chunk_rows)
                        .cast("long")).drop("__r")


def write_token_chunks(df: DataFrame, path: str, key: str | Sequence[str], tokens_col: str = "tokens",
                       label_col: str = "star", chunk_rows: int = CHUNK_ROWS) -> None:
    """CSV with the token list as JSON text plus the label, one folder per chunk."""
    c = assign_chunks(df.select(*as_list(key), tokens_col, label_col), key, chunk_rows)
    (c.select("chunk", *as_list(key), tokens_to_json(F.col(tokens_col)).alias("Comment"),
              F.col(label_col).alias("Star"))
     .repartition("chunk")
     .write.mode("overwrite").option("header", True).option("escape", '"')
     .partitionBy("chunk").csv(path))


def read_token_chunks(spark: SparkSession, path: str, key: str = "review_id long") -> DataFrame:
    """Read S4 files back to (chunk, key, tokens array, star); ``key`` is the key's schema text."""
    schema = f"{key}, Comment string, Star int, chunk long"
    raw = (spark.read.schema(schema).option("header", True).option("escape", '"')
           .option("multiLine", True).csv(path))
    names = [c for c in raw.columns if c not in ("Comment", "Star", "chunk")]
    return raw.select("chunk", *names, tokens_from_json(F.col("Comment")).alias("tokens"),
                      F.col("Star").alias("star"))
