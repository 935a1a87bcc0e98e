"""Driver tables and the review-table stand-ins built from them.

The driver's parquet tables hold no star ratings and no Chinese text, so the
review tables are mapped plainly (synthetic stars, meaningless as sentiment):

* source A: ``documents`` -> review_id = doc_id, comment = text, star = 1 + doc_id % 5
* source B: ``benchmark`` -> review_id = item_id, comment = text, star = 1 + item_id % 5
* labelled reviews: ``documents`` left join ``labels`` (quality / toxic are null
  where a document has no label).

Readers select only the needed columns so the parquet scan prunes the rest.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

REVIEW_COLUMNS = ("review_id", "source", "comment", "star")


# Row keys of the text tables, for a caller that wants to spread an under-split scan.
TEXT_TABLE_KEYS = {"documents": ("doc_id",), "pages": ("page_id",), "conversations": ("conv_id", "turn"),
                   "benchmark": ("item_id",)}

# Session setting that asks :func:`table` for :func:`spread` (number of partitions); off when unset.
SPREAD_CONF = "reviewkit.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. No shuffle is added unless the session sets ``reviewkit.spread``."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    parts = int(spark.conf.get(SPREAD_CONF, "0"))
    return spread(df, parts, TEXT_TABLE_KEYS[name]) if parts and name in TEXT_TABLE_KEYS else df


def spread(df: DataFrame, parts: int, key: tuple[str, ...]) -> DataFrame:
    """Hash-repartition a scan on its full row key to ``parts`` partitions.

    For a table that is one parquet row group, which one task reads: cleaning and
    tokenizing then run on one core. It shuffles the texts, so it is a caller's choice
    (bench and tests on one machine ask for it), never a default.
    """
    return df.repartition(parts, *key)


def synthetic_star(id_col) -> "F.Column":
    return (F.lit(1) + id_col % 5).cast("int")


def reviews_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        d.doc_id.alias("review_id"),
        F.lit("A").alias("source"),
        d.text.alias("comment"),
        synthetic_star(d.doc_id).alias("star"),
    )


def reviews_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        b.item_id.alias("review_id"),
        F.lit("B").alias("source"),
        b.text.alias("comment"),
        synthetic_star(b.item_id).alias("star"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents left join labels: the raw, nullable profile/quality input."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


# SQL renderings of the same stand-ins, for oracle queries.
SQL_REVIEWS_A = ("SELECT doc_id AS review_id, 'A' AS source, text AS comment, "
                 "CAST(1 + doc_id % 5 AS INTEGER) AS star FROM documents")
SQL_REVIEWS_B = ("SELECT item_id AS review_id, 'B' AS source, text AS comment, "
                 "CAST(1 + item_id % 5 AS INTEGER) AS star FROM benchmark")
SQL_LABELLED = ("SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic "
                "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
