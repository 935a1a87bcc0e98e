"""Size-checked broadcast and materialization helpers.

A side is broadcast only after its row count is known to be under a bound;
otherwise the join stays a shuffle join (sort-merge), and AQE's skew handling
splits hot keys. Derived tables are first written as parquet in the shared
``spark.checkpoint.dir``, so the count and the join read the same stored rows, later
reads prune columns and know sizes, and the lineage is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewkit.session import scratch_path

# Broadcast bounds for lookup tables such as vocabularies and vector tables: a
# row count and an estimate of the in-memory bytes every executor receives.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written as parquet in the shared folder, and read again."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(field: T.StructField) -> Column:
    """Rough in-memory size of one value: bytes of text, 8 per number / element."""
    c = F.col(field.name)
    t = field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(t, T.ArrayType):
        n = F.coalesce(F.size(c), F.lit(0)).cast("long")
        if isinstance(t.elementType, T.StringType):
            return n * 8 + F.coalesce(F.octet_length(F.array_join(c, "")), F.lit(0)) + F.lit(16)
        return n * 8 + F.lit(16)
    return F.lit(8)


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of a stored table in one aggregate pass."""
    size = sum((_row_bytes(f) for f in df.schema.fields), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      materialized: bool = False,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if it is within both bounds, else return it as is.

    ``materialized=True`` means ``df`` is a stored table that is cheap to measure;
    otherwise it is stored first.
    Beyond the bounds the join stays a shuffle join (AQE may still pick a
    broadcast from measured sizes under its own threshold).
    """
    table = df if materialized else materialize(df)
    n, nbytes = table_size(table)
    return F.broadcast(table) if n <= max_rows and nbytes <= max_bytes else table
