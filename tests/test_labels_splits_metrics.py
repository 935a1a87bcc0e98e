"""F9 labels, F10 splits and folds, F11 metrics."""

import math

import pytest
from pyspark.sql import functions as F

from reviewkit.functions.arrays import argmax
from reviewkit.functions.labels import sentiment
from reviewkit.operators.metrics import (batch_accuracy, mean_batch_accuracy,
                                         mean_cross_entropy, new_best, pooled_accuracy)
from reviewkit.operators.quality import assert_range
from reviewkit.operators.sampling import approx_split, exact_split, k_fold, mini_batches

# star -> class per rule
TABLE = {
    "canonical": {1: 0, 2: 0, 3: 1, 4: 2, 5: 2},
    "shifted": {1: 0, 2: 0, 3: 0, 4: 1, 5: 2},
    "top_star": {1: 0, 2: 0, 3: 0, 4: 0, 5: 2},
}


@pytest.mark.parametrize("rule", sorted(TABLE))
def test_label_rules(spark, rule):
    df = spark.createDataFrame([(s,) for s in range(1, 6)], "star int")
    got = {r.star: r.label for r in df.select("star", sentiment(F.col("star"), rule).alias("label")).collect()}
    assert got == TABLE[rule]


@pytest.mark.parametrize("bad", [0, 6])
def test_canonical_rejects_out_of_range(spark, bad):
    df = spark.createDataFrame([(bad,)], "star int")
    with pytest.raises(Exception, match="Unknown value"):
        df.select(sentiment(F.col("star"))).collect()
    with pytest.raises(ValueError):
        assert_range(df, "star")


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "rid")


def test_exact_split_sizes_disjoint_repeatable(spark):
    a = exact_split(ids(spark, 1000), "rid", 7, 0.9)
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert counts == {"train": 900, "valid": 100}
    b = exact_split(ids(spark, 1000), "rid", 7, 0.9)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    c = exact_split(ids(spark, 1000), "rid", 8, 0.9)
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, c.collect()))


def test_exact_split_floor_in_double(spark):
    a = exact_split(ids(spark, 100), "rid", 1, 0.29)
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert counts == {"train": 28, "valid": 72}


def test_approx_split_is_repeatable(spark):
    a = approx_split(ids(spark, 2000), "rid", 3, 0.9)
    n_train = a.filter(F.col("split") == "train").count()
    assert 1700 < n_train < 1900
    assert a.filter(F.col("split") == "train").count() == n_train


def test_k_fold(spark):
    got = {r.rid: (r.fold, r.role) for r in k_fold(ids(spark, 11), "rid", 3, 1).collect()}
    assert sorted(got) == list(range(9))  # rows 9 and 10 are in no fold
    assert [got[i][0] for i in range(9)] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert [i for i in range(9) if got[i][1] == "valid"] == [3, 4, 5]
    with pytest.raises(ValueError):
        k_fold(ids(spark, 11), "rid", 1, 0)


def test_mini_batches(spark):
    b = mini_batches(ids(spark, 70), "rid", 32, seed=5)
    sizes = sorted((r.batch_id, r["count"]) for r in b.groupBy("batch_id").count().collect())
    assert sizes == [(0, 32), (1, 32), (2, 6)]
    assert b.select("rid").distinct().count() == 70


def test_argmax_first_maximum(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    assert df.select(argmax(F.col("s")).alias("c")).first().c == 1


def test_pooled_vs_mean_of_batches(spark):
    pred = spark.createDataFrame([(0, 1, 1), (0, 2, 2), (1, 0, 1)], "batch_id long, label int, pred int")
    assert pooled_accuracy(pred).first().accuracy == pytest.approx(2 / 3, abs=1e-6)
    assert mean_batch_accuracy(batch_accuracy(pred)).first().mean_batch_accuracy == 0.5


def test_truncated_eval_uses_101_batches(spark):
    pred = spark.range(150).select(F.col("id").alias("batch_id"), F.lit(1).alias("label"),
                                   F.lit(1).alias("pred"))
    assert mean_batch_accuracy(batch_accuracy(pred), max_batch=100).first().batches == 101


def test_cross_entropy_uniform(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0], 2)], "scores array<double>, label int")
    assert mean_cross_entropy(df).first().cross_entropy == pytest.approx(math.log(3), abs=1e-6)


def test_new_best_strict(spark):
    df = spark.createDataFrame(list(enumerate([50.0, 50.0, 60.0, 55.0, 61.0])), "epoch int, accuracy double")
    best = [r.epoch + 1 for r in new_best(df).orderBy("epoch").collect() if r.is_best]
    assert best == [1, 3, 5]


@pytest.mark.parametrize("lengths", [[1, 2, 2, 3, 10, 64, 64, 7], [5, 5, 5]])
def test_length_histogram_matches_numpy(spark, lengths):
    import numpy as np

    from reviewkit.operators.metrics import length_histogram
    df = spark.createDataFrame([(n,) for n in lengths], "n_tokens int")
    got = length_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(lengths, bins=30)
    assert [r.n for r in got] == counts.tolist()
    assert [r.lo_edge for r in got] == pytest.approx(edges[:-1].tolist(), abs=1e-6)
    assert got[-1].hi_edge == pytest.approx(edges[-1], abs=1e-6)


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_exact_split_with_null_and_repeated_keys(spark, n):
    rows = [(i if i % 3 else None, i) for i in range(n)] + [(5, -1)] * (n // 2)
    df = spark.createDataFrame(rows, "rid long, x long")
    for f in (0.0, 0.3, 0.5, 1.0):
        got = exact_split(df, "rid", 11, f)
        assert got.count() == len(rows)
        assert got.where("split = 'train'").count() == math.floor(float(len(rows)) * f)


def test_split_on_two_keys_tells_the_sources_apart(spark):
    df = spark.range(500).selectExpr("id % 250 AS rid", "if(id < 250, 'A', 'B') AS source")
    got = exact_split(df, ["source", "rid"], 4, 0.5)
    assert got.where("split = 'train'").count() == 250
    assert got.groupBy("rid").agg(F.countDistinct("split").alias("n")).where("n = 2").count() > 50


def test_ranks_with_a_far_away_id_and_null_ids(spark):
    from reviewkit.operators.ranking import rank_by_key
    from reviewkit.operators.sampling import row_index, shuffle_order
    df = spark.range(20_000).select("id").union(spark.createDataFrame([(2 ** 40,), (None,), (None,)], "id long"))
    got = sorted((r.rank, r.id) for r in rank_by_key(df, "id").collect())
    assert [r for r, _ in got] == list(range(1, 20_004))
    assert [i for _, i in got] == [None, None, *range(20_000), 2 ** 40]
    assert row_index(df, "id").count() == shuffle_order(df, "id", 3).count() == 20_003
    assert sorted(r.position for r in shuffle_order(df, "id", 3).collect()) == list(range(20_003))
    # Even ranges in spite of the far-away id: no task holds more than a few times its share.
    placed = df.repartitionByRange(8, "id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert placed < 3 * 20_003 / 8


def test_vocabulary_of_many_equally_frequent_two_character_words(spark):
    from reviewkit.operators.vocab import build_vocabulary
    words = spark.range(60_000).selectExpr(
        "concat(char(19968 + id % 300), char(19968 + id div 300)) AS token", "CAST(1 AS BIGINT) AS freq")
    v = build_vocabulary(words, 1).where("token_id >= 2").orderBy("token_id").collect()
    assert [r.token_id for r in v] == list(range(2, 60_002))
    assert [r.token for r in v] == sorted(r.token for r in v)


def test_history_keeps_events_without_time(spark):
    from reviewkit.operators.metrics import metric_history, running_metrics
    rows = [(i, f"2024-01-0{1 + i // 50} 10:00:{i % 50:02d}", float(i), "purchase" if i % 4 == 0 else "view") for i in range(100)]
    ev = spark.createDataFrame([*rows, (100, None, 5.0, "view")], "event_id long, ts string, value double, event_type string") \
        .selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "value", "event_type")
    h = metric_history(ev, 8)
    assert h.agg(F.sum("total")).first()[0] == 101
    got = {(r.epoch, r.batch): r.running_loss for r in running_metrics(h).collect()}
    assert got[(0, 0)] == pytest.approx(3.5) and got[(0, 6)] == pytest.approx(np_mean_of_means(range(50), 8), abs=1e-5)


def np_mean_of_means(values, size):
    values = list(values)
    means = [sum(values[i:i + size]) / len(values[i:i + size]) for i in range(0, len(values), size)]
    return sum(means) / len(means)


def test_running_metrics_over_many_runs(spark, monkeypatch):
    from reviewkit.operators import metrics
    monkeypatch.setattr(metrics, "RUN_BATCHES", 3)
    h = spark.createDataFrame([(e, b, float(b * e), b, 10) for e in (1, 2) for b in range(20)],
                              "epoch int, batch long, loss double, correct long, total long")
    for r in metrics.running_metrics(h).collect():
        assert r.running_loss == pytest.approx(r.epoch * r.batch / 2, abs=1e-5)
        assert r.running_accuracy == pytest.approx(100 * (r.batch / 2) / 10, abs=1e-5)
