"""M1/M2 on a small labelled set, S8 save/load, X1 stream = batch, U1 tokenizer."""

import os

import pytest
from pyspark.sql import functions as F

from reviewkit.operators.tokens import python_tokenizer, tokenize
from reviewkit.plans.model import load_model, save_model, score, select_model, train
from reviewkit.streaming.score import read_sink, run_to_end, score_stream

GOOD = ["great film loved it", "wonderful acting great story", "loved the music wonderful"]
BAD = ["terrible film hated it", "awful acting boring story", "hated the music awful"]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, GOOD[i % 3], 1) for i in range(30)] + [(100 + i, BAD[i % 3], 0) for i in range(30)]
    return spark.createDataFrame(rows, "rid long, comment string, label int")


@pytest.fixture(scope="module")
def model(labelled):
    return train(labelled, ["the", "it"], max_iter=30, num_features=4096)


def test_train_and_score(model, labelled):
    pred = score(model, labelled, keep=("rid", "label")).collect()
    assert len(pred) == 60
    assert all(len(r.scores) == 2 for r in pred)
    assert sum(r.prediction == r.label for r in pred) == 60


def test_mean_embeddings_learn_the_classes(labelled, tmp_dir):
    from reviewkit.plans.model import embedding_pipeline
    m = train(labelled, ["the", "it"], pipeline=embedding_pipeline, num_features=512, dim=8, max_iter=40)
    pred = score(m, labelled, keep=("label",)).collect()
    assert sum(r.prediction == r.label for r in pred) == 60
    path = os.path.join(tmp_dir, "embedding")
    save_model(m, path)
    assert score(load_model(path), labelled, keep=("label",)).count() == 60


def test_save_load_same_scores(spark, model, labelled, tmp_dir):
    path = os.path.join(tmp_dir, "model")
    save_model(model, path)
    again = load_model(path)
    a = {r.rid: r.prediction for r in score(model, labelled, keep=("rid",)).collect()}
    b = {r.rid: r.prediction for r in score(again, labelled, keep=("rid",)).collect()}
    assert a == b


def test_stream_equals_batch(spark, model, labelled, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    labelled.select("rid", "comment").repartition(4).write.parquet(src)
    q = score_stream(spark, model, src, "rid long, comment string", os.path.join(tmp_dir, "out"),
                     os.path.join(tmp_dir, "ckpt"), keep=("rid",), max_files_per_trigger=1)
    run_to_end(q, 300)
    streamed = {r.rid: (r.prediction, tuple(round(x, 9) for x in r.scores))
                for r in read_sink(spark, os.path.join(tmp_dir, "out")).collect()}
    batch = {r.rid: (r.prediction, tuple(round(x, 9) for x in r.scores))
             for r in score(model, labelled, keep=("rid",)).collect()}
    assert streamed == batch


def test_stream_restarts_after_a_written_batch(spark, model, labelled, tmp_dir):
    from reviewkit.streaming.score import score_stream_by_batch
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    labelled.select("rid", "comment").repartition(4).write.parquet(src)
    written = []

    def start(stop_after):
        def after(batch):
            written.append(batch)
            if batch == stop_after:
                raise RuntimeError("stop")
        return score_stream_by_batch(spark, model, src, "rid long, comment string", out, ckpt, ("rid",), 1, after)

    with pytest.raises(Exception, match="stop"):
        run_to_end(start(2), 300)
    run_to_end(start(None), 300)
    assert written == [0, 1, 2, 2, 3]  # the batch that was not committed is written again
    rows = read_sink(spark, out).collect()
    assert sorted(r.rid for r in rows) == sorted(r.rid for r in labelled.collect())
    batch = {r.rid: r.scores for r in score(model, labelled, keep=("rid",)).collect()}
    assert {r.rid: r.scores for r in rows} == batch


def test_model_selection_marks_one_best(labelled):
    best, table = select_model(labelled, None, reg_params=(0.0, 0.1), num_features=4096)
    rows = table.collect()
    # Both separate the classes, so they tie: the first is the best, and only that one.
    assert [r.is_best for r in rows] == [True, False] and rows[0].accuracy == rows[1].accuracy
    assert best.stages[-1].numClasses == 2


def test_evaluate_gives_accuracy_loss_and_report(spark, model, labelled):
    from reviewkit.plans.model import evaluate
    wrong = labelled.where("rid = 0").selectExpr("rid + 1000 AS rid", "comment", "0 AS label")
    rows = evaluate(model, labelled.union(wrong)).collect()
    assert {r["class"]: r.support for r in rows} == {0: 31, 1: 30}
    assert all(r.n_rows == 61 and abs(r.accuracy - 60 / 61) < 1e-6 and r.log_loss > 0 for r in rows)
    assert {r["class"]: round(r.recall, 4) for r in rows} == {0: round(30 / 31, 4), 1: 1.0}


def test_features_keep_the_case_rules_of_the_stop_filter(spark):
    from pyspark.ml.functions import vector_to_array

    from reviewkit.plans.model import feature_vectors
    df = spark.createDataFrame([(1, "The the NBA nba 3 x"), (2, None)], "rid long, comment string")
    v = feature_vectors(df, ["the", "NBA"], ("rid",), num_features=1 << 16)
    got = {r.rid: sum(r.f) for r in v.select("rid", vector_to_array("features").alias("f")).collect()}
    assert got == {1: 3.0, 2: 0.0}  # NBA, nba, x: an upper-case list entry matches no lower-cased token


def test_python_tokenizer_udf(spark):
    df = spark.createDataFrame([(1, "a b  c"), (2, None)], "rid long, comment string")
    out = tokenize(df, profile="none", tokenizer=python_tokenizer(str.split))
    got = {r.rid: r.tokens for r in out.collect()}
    assert list(got[1]) == ["a", "b", "c"] and got[2] is None
    assert out.filter(F.size("tokens") == 3).count() == 1
