"""Exact global row numbers without a one-partition sort (W4 machinery).

A plain ``row_number() OVER (ORDER BY k)`` moves every row into one task. Here the
rows are range-partitioned on the order itself (Spark samples the keys for even
ranges, so sparse ids, one far-away id or many equal frequencies do not matter) and
sorted inside each partition. ``monotonically_increasing_id`` then holds the partition
and the position in it, both already in the wanted order. The rows are stored once;
the rank is the position plus the rows of all earlier partitions, a table of one row
per partition. Rows with null keys sort first and are kept: nothing is joined on a key. Rows that
share a key are spread by a hash of the row, and equal rows are counted and written out again, so
a key that a third of all rows share (a null, for one) fills no partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewkit.operators.joins import materialize

# Bits of monotonically_increasing_id that hold the position inside a partition.
POSITION_BITS = 33
# Copies of one row that a task writes out at once.
COPIES = 2_000


def as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def placed_rows(df: DataFrame, order: Sequence[Column], unique: bool) -> DataFrame:
    """The rows with their partition (``__part``) and place in it (``__pos``) in ``order``, stored.

    Unless they are ``unique`` in ``order``, equal rows become one with their number (``__copies``) and a hash of the row
    ends the order, so that neither rows with one key nor copies of one row make a partition large.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not unique:
        order = [*order, F.xxhash64(*df.columns)]
        df = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__at", F.monotonically_increasing_id()))
    return materialize(placed.select(
        *df.columns, F.shiftright("__at", POSITION_BITS).cast("int").alias("__part"),
        F.col("__at").bitwiseAND((1 << POSITION_BITS) - 1).alias("__pos")))


def exact_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank",
               total_col: str | None = None, unique: bool = True) -> DataFrame:
    """Add a 1-based rank in ``order``; ``total_col`` adds the row count.

    The rows that go in are sorted and stored, so pass the key columns only and join
    or compare the rest. Rows that tie in ``order`` get different ranks in any order;
    where many may tie, say ``unique=False``.
    """
    out_cols = [*df.columns, rank_col, *([total_col] if total_col else [])]
    placed = placed_rows(df, order, unique)
    most = 1 if unique else placed.agg(F.max("__copies")).first()[0] or 1
    size = F.count(F.lit(1)) if unique else F.sum("__copies")
    counts = placed.groupBy("__part").agg(size.alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                            F.sum("__n").over(Window.partitionBy()).alias("__total"))
    if most > 1:
        inside = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("__pos", F.coalesce(F.sum("__copies").over(inside), F.lit(0)))
    ranked = placed.join(F.broadcast(offsets), "__part")
    if most > 1:
        # Copies are written out in pieces, dealt anew where one row has many.
        ranked = ranked.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1, F.lit(COPIES).cast("long"))))
        if most > COPIES:
            ranked = ranked.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        ranked = ranked.withColumn("__k", F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + COPIES, F.col("__copies")) - 1)))
        ranked = ranked.withColumn("__pos", F.col("__pos") + F.col("__k"))
    out = ranked.withColumn(rank_col, F.col("__before") + F.col("__pos") + 1)
    if total_col:
        out = out.withColumn(total_col, F.col("__total"))
    return out.select(*out_cols)


def hash_key(seed: int | str, key: str | Sequence[str]) -> Column:
    """Repeatable random order key: md5 of 'seed:key' (same value in DuckDB).

    Several key columns are joined by ``:``; a null is written as ``~``.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in as_list(key)]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def rank_by_hash(df: DataFrame, key: str | Sequence[str], seed: int | str, rank_col: str = "rank",
                 total_col: str | None = None) -> DataFrame:
    """Exact rank in md5('seed:key') order, ties by key (K2 shuffle order, E9 batches)."""
    d = df.withColumn("__hkey", hash_key(seed, key))
    return exact_rank(d, [F.col("__hkey"), *map(F.col, as_list(key))], rank_col, total_col, unique=False).drop("__hkey")


def rank_by_key(df: DataFrame, key: str | Sequence[str], rank_col: str = "rank",
                total_col: str | None = None) -> DataFrame:
    """Exact rank in key order (W4); null keys first."""
    return exact_rank(df, list(map(F.col, as_list(key))), rank_col, total_col, unique=False)
