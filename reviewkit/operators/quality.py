"""Profiles, data-quality predicates, union and dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One pass -> long form (column, rows, nulls), one row per input column.

    The aggregate is a single partial+final pass; ``stack`` turns the one wide
    result row into rows.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', __n{i}" for i, c in enumerate(cols))
    return wide.selectExpr("__rows AS rows", f"stack({len(cols)}, {pairs}) AS (column_name, nulls)") \
        .select("column_name", F.col("rows").cast("long"), F.col("nulls").cast("long"))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """P5: drop rows whose ``col`` is in ``values``; an empty list is a no-op."""
    return df if not values else df.filter(~F.col(col).isin(list(values)))


def range_violations(df: DataFrame, col: str, lo: int = 1, hi: int = 5) -> DataFrame:
    """P6 report: rows outside [lo, hi] (nulls are not violations; P4 drops them)."""
    return df.filter(~F.col(col).between(lo, hi))


def range_summary(df: DataFrame, col: str, lo: int = 1, hi: int = 5) -> DataFrame:
    """Min, max and violation count in one aggregate."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"),
                  F.count_if(~F.col(col).between(lo, hi)).cast("long").alias("violations"))


def assert_range(df: DataFrame, col: str, lo: int = 1, hi: int = 5) -> None:
    """Fail when min < lo or max > hi ("Label out of range")."""
    r = range_summary(df, col, lo, hi).first()
    if r["min_value"] is not None and (r["min_value"] < lo or r["max_value"] > hi):
        raise ValueError(f"Label out of range: min={r['min_value']} max={r['max_value']}")


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on the key; counts of matched and one-sided keys."""
    lk = left.select(F.col(key).alias("__k"), F.lit(1).alias("__l"))
    rk = right.select(F.col(key).alias("__k"), F.lit(1).alias("__r"))
    j = lk.join(rk, "__k", "full_outer")
    return j.agg(
        F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).cast("long").alias("matched"),
        F.count_if(F.col("__r").isNull()).cast("long").alias("left_only"),
        F.count_if(F.col("__l").isNull()).cast("long").alias("right_only"),
    )


def assert_aligned(left: DataFrame, right: DataFrame, key: str) -> None:
    r = alignment(left, right, key).first()
    if r["left_only"] or r["right_only"]:
        raise ValueError(f"inputs and labels are not aligned: {r.asDict()}")


def keep_shorter(df: DataFrame, tokens_col: str = "tokens", max_len: int = 64) -> DataFrame:
    """Keep token lists strictly shorter than ``max_len``."""
    return df.filter(F.size(tokens_col) < max_len)


def dedup_pairs(df: DataFrame, cols: Sequence[str] = ("comment", "star"),
                order_cols: Sequence[str] = ("review_id",),
                count_col: str | None = None) -> DataFrame:
    """A2: one row per distinct (comment, star) pair, keeping the first row.

    "First" is the smallest ``order_cols`` tuple (the reference keeps the first
    row in file order; here the row key carries that order). Rows are grouped by a
    256-bit digest of long columns, so texts are neither compared nor sorted; the first
    row travels as one struct, whose minimum is partial before the shuffle: a pair
    repeated millions of times costs one row per task. ``count_col`` adds the number
    of copies.
    """
    kinds = dict(df.dtypes)
    keys = [F.sha2(F.col(c), 256) if kinds[c] == "string" else F.col(c) for c in cols]
    rest = [c for c in df.columns if c not in order_cols]
    aggs = [F.min(F.struct(*order_cols, *rest)).alias("__first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    g = df.groupBy(*[k.alias(f"__k{i}") for i, k in enumerate(keys)]).agg(*aggs)
    return g.select(*[F.col(f"__first.{c}").alias(c) for c in df.columns], *([count_col] if count_col else []))


def star_distribution(df: DataFrame, col: str = "star", lo: int = 1, hi: int = 5) -> DataFrame:
    """A3: count per star value lo..hi, empty bins as 0."""
    spark = df.sparkSession
    bins = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias(col))
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return bins.join(counts, col, "left").select(col, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def zip_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Index-aligned zip = inner equi join on the row key."""
    return left.join(right, key, "inner")


def preview(df: DataFrame, order_col: str, n: int = 5) -> DataFrame:
    """First n rows in key order (a top-n, not a full sort)."""
    return df.orderBy(order_col).limit(n)
