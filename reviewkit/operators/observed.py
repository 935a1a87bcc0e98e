"""Checks counted while a table is written (P2, P6, P7): no pass of their own.

The measures ride on the write of a stored table (``DataFrame.observe``), so profile, range and alignment of a table cost no second
scan. They sit on the last stage of the write, whose tasks Spark counts once each, also when a task fails and runs again or an
executor is lost. The values are a few numbers on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewkit.operators.joins import materialize


def store_observed(df: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """``df`` stored (:func:`reviewkit.operators.joins.materialize`), and the measures' values over its rows."""
    seen = Observation()
    table = materialize(df.observe(seen, *[m.alias(name) for name, m in measures.items()]))
    return table, dict(seen.get)


def profile_measures(columns: Sequence[str]) -> dict[str, Column]:
    """Rows, and the nulls of each column by its place."""
    return {"rows": F.count(F.lit(1)), **{f"nulls{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(columns)}}


def range_measures(col: str, lo: int = 1, hi: int = 5) -> dict[str, Column]:
    """Minimum, maximum and the rows outside [lo, hi]; nulls are no violations."""
    return {"min_value": F.min(col), "max_value": F.max(col), "violations": F.count_if(~F.col(col).between(lo, hi))}


def alignment_measures(left: str, right: str) -> dict[str, Column]:
    """P7 on a full outer join with a marker column from either side (null where the side has no row)."""
    l, r = F.col(left).isNotNull(), F.col(right).isNotNull()
    return {"matched": F.count_if(l & r), "left_only": F.count_if(l & ~r), "right_only": F.count_if(~l & r)}


def check_range(seen: Mapping, lo: int = 1, hi: int = 5) -> None:
    """Fail when a value lies outside [lo, hi]; a table without values passes."""
    if seen["violations"]:
        raise ValueError(f"Label out of range: min={seen['min_value']} max={seen['max_value']}")


def check_alignment(seen: Mapping) -> None:
    """Fail when a side has rows that the other lacks."""
    if seen["left_only"] or seen["right_only"]:
        raise ValueError(f"inputs and labels are not aligned: {({k: seen[k] for k in ('left_only', 'right_only')})}")


def stored_profile(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P2 of a table on its way to storage: (the stored table, (column_name, rows, nulls) in the order of its columns)."""
    table, seen = store_observed(df, profile_measures(df.columns))
    rows = [(c, seen["rows"], seen[f"nulls{i}"]) for i, c in enumerate(df.columns)]
    return table, values_table(df.sparkSession, rows, "column_name string, rows long, nulls long")


def values_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Observed values as a small table."""
    return spark.createDataFrame(list(rows), schema)
