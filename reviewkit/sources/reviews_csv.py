"""Review CSV dumps (S1, S2) and the working table.

CSV parsing: header row, quoted fields that may span lines, doubled quotes
inside quotes (``escape='"'``; Spark's default backslash escape would split or
merge records). Types are declared, never inferred (inference costs a full
extra pass). Spark's multi-line scan reads each file in one task;
:mod:`reviewkit.sources.csv_split` reads the same rows in many. Convert the dumps
to parquet once (:func:`to_parquet`) and run every job from parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

# --- fixed values: text cells pandas' read_csv turns into NaN by default ------
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
# -----------------------------------------------------------------------------

SCHEMA_A = StructType([
    StructField("ID", LongType()), StructField("Movie_Name_EN", StringType()),
    StructField("Movie_Name_CN", StringType()), StructField("Crawl_Date", StringType()),
    StructField("Number", IntegerType()), StructField("Username", StringType()),
    StructField("Date", StringType()), StructField("Star", IntegerType()),
    StructField("Comment", StringType()), StructField("Like", IntegerType()),
])
SCHEMA_B = StructType([
    StructField("ID", LongType()), StructField("Movie_Name", StringType()),
    StructField("Score", DoubleType()), StructField("Review_People", IntegerType()),
    StructField("Star_Distribution", StringType()), StructField("Craw_Date", StringType()),
    StructField("Username", StringType()), StructField("Date", StringType()),
    StructField("Star", IntegerType()), StructField("Comment", StringType()),
    StructField("Comment_Distribution", StringType()), StructField("Like", IntegerType()),
])


#: Column that holds a record the parser could not read (null for good records).
CORRUPT = "_corrupt_record"


def read_reviews_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                     pandas_na: bool = True, keep_corrupt: bool = False) -> DataFrame:
    """Scan review CSV files with a declared schema.

    ``pandas_na=True`` turns the NA tokens above into nulls in string columns,
    as the reference's reader does (a comment that is literally "None" then
    disappears at the null drop). A record with too many, too few or unreadable fields
    keeps what could be read; with ``keep_corrupt`` its text stands in
    ``_corrupt_record``, so :func:`corrupt_records` can count what a null drop loses.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    df = (spark.read.schema(full if keep_corrupt else schema)
          .options(columnNameOfCorruptRecord=CORRUPT, header=True, multiLine=True, escape='"', quote='"', mode="PERMISSIVE")
          .csv(paths if isinstance(paths, str) else list(paths)))
    return null_tokens(df) if pandas_na else df


def null_tokens(df: DataFrame) -> DataFrame:
    """The NA tokens above as nulls in every string column but the corrupt record."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType) and f.name != CORRUPT:
            c = F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def corrupt_records(df: DataFrame) -> DataFrame:
    """Rows and unreadable records of a scan with ``keep_corrupt`` (one row)."""
    # The scan refuses to read the corrupt record alone, so the count takes in the parsed columns.
    whole = F.hash(*[c for c in df.columns if c != CORRUPT])
    return df.agg(F.count(whole).alias("n_rows"), F.count(F.when(F.col(CORRUPT).isNotNull(), whole)).alias("n_corrupt"))


def to_parquet(df: DataFrame, path: str) -> None:
    """Store a parsed dump as parquet (splittable, columnar, pruned reads)."""
    df.write.mode("overwrite").parquet(path)


def first_rows(df: DataFrame, n: int, order_col: str = "ID") -> DataFrame:
    """The first ``n`` rows in file order (order carried by the key column)."""
    return df.orderBy(order_col).limit(n)


def working_table(sources: dict[str, DataFrame], id_col: str = "ID", exclude_stars: Sequence[int] = (),
                  dedup: bool = False) -> DataFrame:
    """P1 + K3 + P4 + P5 (+ A2): (source, review_id, comment, star) from several dumps.

    Sources are unioned in the given order, which an ordinal carries (their names do
    not sort that way). ``dedup`` keeps the first row, in source and id order, of every
    (comment, star) pair.
    """
    from reviewkit.operators.quality import dedup_pairs, drop_nulls, exclude_values
    parts = [df.select(F.lit(at).alias("__ordinal"), F.lit(name).alias("source"), F.col(id_col).cast("long").alias("review_id"),
                       F.col("Comment").alias("comment"), F.col("Star").cast("int").alias("star"))
             for at, (name, df) in enumerate(sources.items())]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = exclude_values(drop_nulls(u, ["comment", "star"]), "star", list(exclude_stars))
    return (dedup_pairs(u, order_cols=("__ordinal", "review_id")) if dedup else u).drop("__ordinal")
