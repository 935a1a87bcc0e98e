"""Naive Bayes against Spark ML's own and by hand; features by vocabulary id."""

import math

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from reviewkit.operators.encode import vocabulary_counts, vocabulary_vectors
from reviewkit.plans.bayes import evaluate_bayes, load_bayes, score_bayes, train_bayes
from reviewkit.plans.model import fit_vectors

ROWS = [("A", 1, 0, ["bad", "bad", "poor"]), ("A", 2, 1, ["fair", "so"]), ("A", 3, 2, ["good", "good", "fine", "so"]),
        ("B", 1, 2, ["good"]), ("B", 2, 0, ["bad", "so"]), ("B", 3, 1, []), ("B", 4, None, ["good"])]
SCHEMA = "source string, review_id long, label int, tokens array<string>"
KEY = ("source", "review_id")


def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_counts_and_likelihoods_by_hand(spark):
    m = train_bayes(rows(spark), 3)
    t = {r.token: r for r in m.tokens.collect()}
    assert list(t["bad"]["counts"]) == [3, 0, 0] and list(t["so"]["counts"]) == [1, 1, 1] and "good" in t
    assert len(t) == 6  # bad poor fair so good fine
    assert math.isclose(t["bad"].log_likelihood[0], math.log(4 / (5 + 6))) and math.isclose(t["bad"].log_likelihood[1], math.log(1 / (2 + 6)))
    c = {r["class"]: r for r in m.classes.collect()}
    assert [c[k].n_rows for k in range(3)] == [2, 2, 2] and c[0].n_tokens == 5 and c[0].vocabulary == 6
    assert math.isclose(c[1].log_prior, math.log(3 / 9))


def test_scores_equal_spark_ml(spark):
    labelled = rows(spark).where("label is not null")
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate(["bad", "poor", "fair", "so", "good", "fine"])], "token string, token_id long")
    v = vocabulary_vectors(labelled, vocab, KEY, keep=("label",))
    ml = NaiveBayes(smoothing=1.0).fit(v).transform(v)
    want = {(r.source, r.review_id): (list(r.rawPrediction), int(r.prediction)) for r in ml.collect()}
    model = train_bayes(labelled, 3)
    got = {(r.source, r.review_id): (r.scores, r.prediction) for r in score_bayes(model, labelled, KEY).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert all(math.isclose(a, b) for a, b in zip(got[k][0], want[k][0])) and got[k][1] == want[k][1]


def test_saved_model_unknown_tokens_and_empty_reviews(spark, tmp_dir):
    model = train_bayes(rows(spark), 3)
    model.save(tmp_dir + "/nb")
    loaded = load_bayes(spark, tmp_dir + "/nb")
    new = spark.createDataFrame([("C", 1, None, ["never", "seen"]), ("C", 2, None, []), ("C", 3, None, None), ("C", 4, None, ["bad"])], SCHEMA)
    got = {r.review_id: r for r in score_bayes(loaded, new, KEY).collect()}
    fitted = {r.review_id: r for r in score_bayes(model, new, KEY).collect()}
    assert all(got[k] == fitted[k] for k in fitted) and len(got) == 4
    assert got[1].scores == got[2].scores == got[3].scores and got[4].prediction == 0
    report = {r["class"]: r for r in evaluate_bayes(loaded, rows(spark), KEY).collect()}
    assert report[0].support == 2 and report[0].n_rows == 6 and 0 < report[0].accuracy <= 1


def test_empty_table_and_a_hot_token(spark):
    empty = spark.createDataFrame([], SCHEMA)
    m = train_bayes(empty, 3)
    assert m.tokens.count() == 0 and m.classes.count() == 3
    assert score_bayes(m, empty, KEY).count() == 0
    many = spark.range(3000).select(F.lit("A").alias("source"), F.col("id").alias("review_id"), (F.col("id") % 3).cast("int").alias("label"),
                                    F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id") % 7)).alias("tokens"))
    t = {r.token: list(r["counts"]) for r in train_bayes(many, 3).tokens.collect()}
    assert t["hot"] == [1000, 1000, 1000]


def test_vocabulary_features(spark):
    vocab = spark.createDataFrame([("<unk>", 0), ("<pad>", 1), ("good", 2), ("bad", 3), ("so", 4)], "token string, token_id long")
    got = {(r.source, r.review_id): r for r in vocabulary_counts(rows(spark), vocab, KEY).collect()}
    assert got["A", 1].indices == [0, 3] and got["A", 1]["values"] == [1.0, 2.0] and got["A", 1]["size"] == 5
    assert got["B", 3].indices == []
    v = vocabulary_vectors(rows(spark), vocab, KEY, keep=("label",))
    vec = {(r.source, r.review_id): r.features for r in v.collect()}
    assert vec["A", 3].size == 5 and vec["A", 3].toArray().tolist() == [1.0, 0, 2.0, 0, 1.0] and vec["B", 3].numNonzeros() == 0
    model = fit_vectors(v.where("label is not null"), max_iter=3)
    assert model.numFeatures == 5 and model.numClasses == 3
    plan = v._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_tokens_cross_the_network_as_arrays(spark):
    """one shuffle of the token arrays serves the counts by (row, token) and the sums by row."""
    from reviewkit.operators.encode import row_counts
    rows = spark.createDataFrame([("a", 1, ["x", "y", "x"]), ("a", 2, []), ("a", 3, None), (None, 4, ["x"]), ("a", 1, ["x"])],
                                 "source string, rid long, tokens array<string>")
    c = row_counts(rows, ["source", "rid"], "tokens", "n")
    assert sorted(map(tuple, c.collect()), key=str) == sorted(
        [("a", 1, "x", 3), ("a", 1, "y", 1), ("a", 2, None, 1), ("a", 3, None, 1), (None, 4, "x", 1)], key=str)
    plan = c.groupBy("source", "rid").agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
