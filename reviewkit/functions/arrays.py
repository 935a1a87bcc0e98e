"""Array helpers: argmax, masks, padding, cross-entropy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: list, arr: Column, name: str,
                 pos_name: str | None = None) -> DataFrame:
    """One row per array element (``explode`` / ``posexplode``), empty arrays give none.

    For the plain generators Catalyst infers ``size(arr) > 0 AND isnotnull(arr)``
    and pushes it below the generator (past any exchange), so an expensive array
    expression such as clean + tokenize is computed for that filter and again
    for the generator. The ``_outer`` forms get no inferred filter; their one
    null row for an empty array is dropped right after, which gives the same rows
    with one evaluation. Array elements must not be null themselves.
    """
    if pos_name:
        out = df.select(*keep, F.posexplode_outer(arr).alias(pos_name, name))
        return out.filter(F.col(pos_name).isNotNull())
    out = df.select(*keep, F.explode_outer(arr).alias(name))
    return out.filter(F.col(name).isNotNull())


def argmax(scores: Column) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def padding_mask(ids: Column, pad_id: int = 1) -> Column:
    """1 where the id is not the pad id, else 0."""
    return F.transform(ids, lambda x: F.when(x == pad_id, F.lit(0)).otherwise(F.lit(1)))


def pad_to(ids: Column, length: Column | int, pad_id: int = 1) -> Column:
    """Right-pad with ``pad_id`` / cut to exactly ``length`` elements."""
    length = F.lit(length) if isinstance(length, int) else length
    cut = F.slice(ids, 1, length)
    fill = F.array_repeat(F.lit(pad_id).cast("long"),
                          F.greatest(F.lit(0), length - F.size(cut)).cast("int"))
    return F.concat(cut, fill)


def cross_entropy(scores: Column, label: Column) -> Column:
    """-log softmax(scores)[label], via log-sum-exp in double precision."""
    d = F.transform(scores, lambda x: x.cast("double"))
    m = F.array_max(d)
    lse = m + F.log(F.aggregate(d, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))
    return lse - F.get(d, label)


def ids_text(ids: Column) -> Column:
    """Comma-joined text of a numeric array (for order-insensitive comparisons)."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")
