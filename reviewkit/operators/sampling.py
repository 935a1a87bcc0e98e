"""Row index, shuffles, splits, folds and mini-batches.

Keys are one column or a list (a review is keyed by source and review_id). Every
random operator takes a seed and orders by md5('seed:key'), which is repeatable,
independent of partitioning, and equal in DuckDB. Exact ranks come from
:mod:`reviewkit.operators.ranking`; the exact split compares rows with one threshold
and moves none. Rows with null keys are kept everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewkit.functions.arrays import padding_mask
from reviewkit.operators.ranking import as_list, hash_key, rank_by_hash, rank_by_key

Key = str | Sequence[str]


def row_index(df: DataFrame, key: Key, out_col: str = "row_index",
              keep_old: bool = False, old_col: str = "index") -> DataFrame:
    """Dense 0-based index in key order; optionally keep the (first) old key as ``index``."""
    res = rank_by_key(df, key, "__r").withColumn(out_col, F.col("__r") - 1).drop("__r")
    return res.withColumn(old_col, F.col(as_list(key)[0])) if keep_old else res


def shuffle_order(df: DataFrame, key: Key, seed: int, out_col: str = "position") -> DataFrame:
    """K2: repeatable random order, 0-based position."""
    return rank_by_hash(df, key, seed, "__r").withColumn(out_col, F.col("__r") - 1).drop("__r")


def _sort_text(key: Key, seed: int) -> Column:
    """Hash and key as one text that is unique for a key, so that the split has one threshold."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in as_list(key)]
    return F.concat_ws(":", hash_key(seed, key), *parts)


def _threshold(keys: DataFrame, cut: int) -> tuple[str, int, int] | None:
    """The ``cut``-th text ``t`` in order, how many of its rows belong before the cut, and how many there are.

    Counts by four more hexadecimal digits a round (65,536 at most reach the driver), then by the whole text of one hash.
    """
    prefix, left = "", cut
    while True:
        inside = keys.where(F.col("t").startswith(prefix)) if prefix else keys
        part = F.substring("t", 1, len(prefix) + 4) if len(prefix) < 32 else F.col("t")
        groups = inside.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("least"), F.max("t").alias("most")).collect()
        for g in sorted(groups, key=lambda g: g.p.encode()):
            if left <= g.n:
                break
            left -= g.n
        else:
            return None
        if g.least == g.most:
            return g.least, left, g.n
        prefix = g.p


def exact_split(df: DataFrame, key: Key, seed: int, fraction: float = 0.9,
                out_col: str = "split") -> DataFrame:
    """Exactly floor(n * fraction) rows 'train' (double arithmetic), rest 'valid'.

    Counts per hash prefix tell in which prefix the cut falls (:func:`_threshold`), down to the
    key at the cut, the threshold every row is compared with. No row is shuffled or sorted. Rows that
    share the key at the threshold, if there are any, are told apart by an exact rank.
    """
    text = _sort_text(key, seed)
    keys = df.select(text.alias("t"))
    total = keys.count()
    cut = int(float(total) * fraction)
    if not cut:
        return df.withColumn(out_col, F.lit("valid"))
    found = _threshold(keys, cut)
    if found is None:
        return df.withColumn(out_col, F.lit("train"))
    last, left, upto = found
    if upto == left:
        return df.withColumn(out_col, F.when(text <= last, F.lit("train")).otherwise(F.lit("valid")))
    tied = rank_by_hash(df.where(text == last), key, seed, "__r")
    tied = tied.withColumn(out_col, F.when(F.col("__r") <= left, F.lit("train"))
                           .otherwise(F.lit("valid"))).drop("__r")
    rest = df.where(text != last).withColumn(out_col, F.when(text < last, F.lit("train")).otherwise(F.lit("valid")))
    return rest.unionByName(tied)


def approx_split(df: DataFrame, key: Key, seed: int, fraction: float = 0.9,
                 out_col: str = "split") -> DataFrame:
    """Each row independently 'train' with probability ``fraction``.

    The draw is the first 8 hex digits of md5('seed:key') / 16**8, so it is
    repeatable and needs no count.
    """
    u = F.conv(F.substring(hash_key(seed, key), 1, 8), 16, 10).cast("double") / F.lit(float(16 ** 8))
    return df.withColumn(out_col, F.when(u < F.lit(float(fraction)), F.lit("train"))
                         .otherwise(F.lit("valid")))


def k_fold(df: DataFrame, key: Key, k: int, i: int, out_col: str = "role") -> DataFrame:
    """Contiguous folds of n // k rows in key order; the last n % k rows are in no fold.

    Returns rows of fold ``i`` as 'valid', other folds as 'train', with ``fold``.
    """
    if k <= 1:
        raise ValueError("k must be greater than 1")
    if not 0 <= i < k:
        raise ValueError("fold index out of range")
    r = rank_by_key(df, key, "__r", total_col="__n")
    size = F.floor(F.col("__n") / F.lit(k))
    fold = F.when(size > 0, F.floor((F.col("__r") - 1) / size))
    res = r.withColumn("fold", fold.cast("long")).filter(F.col("fold") < k)
    return res.withColumn(out_col, F.when(F.col("fold") == i, F.lit("valid"))
                          .otherwise(F.lit("train"))).drop("__r", "__n")


def mini_batches(df: DataFrame, key: Key, batch_size: int, seed: int | None = None,
                 out_col: str = "batch_id") -> DataFrame:
    """batch = position div batch_size, in shuffled order (seed) or key order."""
    r = rank_by_key(df, key, "__r") if seed is None else rank_by_hash(df, key, seed, "__r")
    return r.withColumn(out_col, F.floor((F.col("__r") - 1) / F.lit(batch_size)).cast("long")) \
        .withColumn("batch_pos", ((F.col("__r") - 1) % batch_size).cast("long")).drop("__r")


def packed_batches(examples: DataFrame, key: Key, batch_size: int, seed: int | None = None, ids_col: str = "input_ids",
                   label_col: str = "label", pad_id: int = 1) -> DataFrame:
    """E9 as a trainer reads it: one row per batch with its stacked ids, masks and labels.

    (batch_id, n_rows, input_ids, attention_mask, labels), rows in batch order; the last batch may be short. A group holds
    ``batch_size`` rows and no more, whatever the keys: positions are unique, so null or repeated keys fill no batch.
    """
    placed = mini_batches(examples, key, batch_size, seed)
    row = F.struct("batch_pos", F.col(ids_col).alias("ids"), padding_mask(F.col(ids_col), pad_id).alias("mask"), F.col(label_col).alias("label"))
    grouped = placed.groupBy("batch_id").agg(F.sort_array(F.collect_list(row)).alias("r"))
    return grouped.select("batch_id", F.size("r").alias("n_rows"), F.col("r.ids").alias("input_ids"),
                          F.col("r.mask").alias("attention_mask"), F.col("r.label").alias("labels"))
