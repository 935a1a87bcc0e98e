"""Ranks, folds, batches and splits where a third of all rows share one key."""

from collections import Counter

from pyspark.sql import functions as F

from reviewkit.operators import ranking
from reviewkit.operators.ranking import placed_rows
from reviewkit.operators.sampling import exact_split, k_fold, mini_batches, row_index, shuffle_order

N = 30_000


def table(spark, other: bool):
    """A third of the keys is null, a sixth is 7; with ``other`` the rows differ in another column."""
    key = F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).when(F.col("id") % 6 == 1, 7).otherwise(F.col("id"))
    df = spark.range(N).select(key.alias("k"), F.col("id").alias("o"))
    return df if other else df.select("k")


def largest_share(df):
    """Rows of the largest partition over the mean of the partitions."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / (sum(sizes) / 8)


def test_no_partition_is_large(spark):
    for other in (True, False):
        df = table(spark, other)
        placed = placed_rows(df, [F.col("k")], unique=False)
        sizes = Counter(r["__part"] for r in placed.select("__part").collect())
        assert max(sizes.values()) < 2 * sum(sizes.values()) / 8
        assert largest_share(row_index(df, "k")) < 2


def test_ranks_are_dense_and_in_order(spark, monkeypatch):
    for copies in (100, 10 ** 9):
        monkeypatch.setattr(ranking, "COPIES", copies)
        for other in (True, False):
            rows = sorted((r.row_index, r.k) for r in row_index(table(spark, other), "k").collect())
            assert [i for i, _ in rows] == list(range(N))
            keys = [(k is not None, k or 0) for _, k in rows]
            assert keys == sorted(keys)
    both = {(r.k, r.o) for r in row_index(table(spark, True), "k").collect()}
    assert len(both) == N


def test_shuffles_folds_and_batches(spark):
    df = table(spark, False)
    assert sorted(r.position for r in shuffle_order(df, "k", 3).collect()) == list(range(N))
    folds = Counter(r.fold for r in k_fold(df, "k", 7, 0).collect())
    assert set(folds.values()) == {N // 7}
    batches = Counter(r.batch_id for r in mini_batches(df, "k", 128, 5).collect())
    assert sum(batches.values()) == N and set(batches.values()) <= {128, N % 128}


def test_exact_split_at_a_hot_key(spark):
    for other in (True, False):
        df = table(spark, other)
        for fraction in (0.0, 0.1, 0.35, 0.5, 0.9, 1.0):
            got = Counter(r.split for r in exact_split(df, "k", 4, fraction).collect())
            assert got["train"] == int(N * fraction) and got["train"] + got["valid"] == N
    assert exact_split(df.limit(0), "k", 1).count() == 0
    same = spark.range(5000).select(F.lit("x").alias("k"))
    assert Counter(r.split for r in exact_split(same, "k", 1, 0.25).collect()) == {"train": 1250, "valid": 3750}


def test_packed_batches(spark):
    from reviewkit.operators.sampling import packed_batches
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), (F.col("id") % 3).cast("int").alias("label"),
                                  F.array(F.col("id") + 5, F.lit(1).cast("long")).alias("input_ids"))
    rows = {r.batch_id: r for r in packed_batches(df, "k", 64, 2).collect()}
    assert sorted(rows) == list(range(16)) and [rows[b].n_rows for b in range(16)] == [64] * 15 + [40]
    seen = [(i[0] - 5, x, tuple(m)) for r in rows.values() for i, x, m in zip(r.input_ids, r.labels, r.attention_mask)]
    assert sorted(seen) == [(i, i % 3, (1, 0)) for i in range(1000)]
    again = {r.batch_id: r.labels for r in packed_batches(df, "k", 64, 2).collect()}
    assert again == {b: r.labels for b, r in rows.items()}
