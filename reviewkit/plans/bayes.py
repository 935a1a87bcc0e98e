"""Multinomial naive Bayes in closed form from aggregates.

One pass counts (token, class); the model is two tables: a row for each token with its count and log likelihood
in every class, and a row for each class with its prior. Training is one aggregate, scoring one join on the token and one
aggregate by review: no iteration, nothing on the driver, any vocabulary size. Smoothing is additive, as in
Spark ML's ``NaiveBayes``, of priors and likelihoods.

A token that training has not seen adds nothing to any class. A review without known tokens gets the priors. Rows without a
label are not trained on; a class without rows keeps the smoothed prior.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.functions.arrays import argmax, explode_rows
from reviewkit.operators.encode import row_counts
from reviewkit.operators.joins import checked_broadcast, materialize
from reviewkit.operators.metrics import class_report, mean_cross_entropy, pooled_accuracy
from reviewkit.operators.ranking import as_list


@dataclass
class BayesModel:
    """``tokens``: token, counts, log_likelihood (arrays by class); ``classes``: class, n_rows, n_tokens, vocabulary, log_prior."""

    tokens: DataFrame
    classes: DataFrame
    n_classes: int

    def save(self, path: str) -> None:
        """Both tables under one folder."""
        self.tokens.write.mode("overwrite").parquet(os.path.join(path, "tokens"))
        self.classes.write.mode("overwrite").parquet(os.path.join(path, "classes"))


def load_bayes(spark: SparkSession, path: str) -> BayesModel:
    """A saved model."""
    classes = spark.read.parquet(os.path.join(path, "classes"))
    return BayesModel(spark.read.parquet(os.path.join(path, "tokens")), classes, classes.count())


def train_bayes(rows: DataFrame, n_classes: int, label_col: str = "label", tokens_col: str = "tokens",
                smoothing: float = 1.0) -> BayesModel:
    """M1: fit on token arrays with labels 0 .. ``n_classes`` - 1.

    ``rows`` is read twice (tokens by class, rows by class); pass a stored table. The counts of a token are one row,
    summed before the shuffle, so a token in every review costs one row per task.
    """
    labelled = rows.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("label"), F.col(tokens_col).alias("tokens"))
    of = range(n_classes)
    counted = explode_rows(labelled, ["label"], F.col("tokens"), "token").groupBy("token").agg(
        F.array(*[F.count_if(F.col("label") == k) for k in of]).alias("counts"))
    counted = materialize(counted)
    sums = counted.agg(F.count(F.lit(1)).alias("vocabulary"),
                       F.array(*[F.coalesce(F.sum(F.get("counts", k)), F.lit(0)) for k in of]).alias("n_tokens"))
    size = labelled.agg(F.array(*[F.count_if(F.col("label") == k) for k in of]).alias("n_rows"))
    lam = F.lit(float(smoothing))
    each = sums.crossJoin(size)  # one row each
    total = F.aggregate("n_rows", F.lit(0).cast("long"), lambda a, x: a + x)
    classes = materialize(each.select("vocabulary", total.alias("n"), F.posexplode(F.arrays_zip("n_rows", "n_tokens")).alias("class", "c")).select(
        "class", "c.n_rows", "c.n_tokens", "vocabulary",
        F.log((F.col("c.n_rows") + lam) / (F.col("n") + lam * n_classes)).alias("log_prior")))
    like = F.zip_with("counts", "n_tokens", lambda c, n: F.log((c + lam) / (n + lam * F.col("vocabulary"))))
    tokens = counted.crossJoin(F.broadcast(sums)).select("token", "counts", like.alias("log_likelihood"))
    return BayesModel(materialize(tokens), classes, n_classes)


def _prior(model: BayesModel) -> DataFrame:
    """The log priors as one array in one row."""
    return model.classes.agg(F.sort_array(F.collect_list(F.struct("class", "log_prior"))).alias("p")).select(F.col("p.log_prior").alias("prior"))


def score_bayes(model: BayesModel, rows: DataFrame, key: str | Sequence[str], keep: Sequence[str] = (),
                tokens_col: str = "tokens") -> DataFrame:
    """M2: (key, keep..., scores, prediction); scores are log prior plus log likelihood by class, the prediction their argmax.

    Rows are told apart by ``key`` and ``keep``. Tokens are counted by review before the join; the model is broadcast only within
    the size bounds, else the join shuffles on the token and AQE splits hot ones.
    """
    by = [*as_list(key), *keep]
    counted = row_counts(rows, by, tokens_col, "n")
    joined = counted.join(checked_broadcast(model.tokens.select("token", "log_likelihood"), materialized=True), "token", "left")
    sums = joined.groupBy(*by).agg(F.array(*[F.coalesce(F.sum(F.col("n") * F.get("log_likelihood", k)), F.lit(0.0))
                                             for k in range(model.n_classes)]).alias("s"))
    scored = sums.crossJoin(F.broadcast(_prior(model))).select(*by, F.zip_with("s", "prior", lambda a, b: a + b).alias("scores"))
    return scored.withColumn("prediction", argmax(F.col("scores")))


def evaluate_bayes(model: BayesModel, rows: DataFrame, key: str | Sequence[str], label_col: str = "label",
                   tokens_col: str = "tokens") -> DataFrame:
    """M3: the report of each class and the table's accuracy, log_loss and n_rows, from scores computed once and stored."""
    scored = materialize(score_bayes(model, rows.where(F.col(label_col).isNotNull()), key, (label_col,), tokens_col).select(
        "scores", F.col(label_col).cast("int").alias("label"), F.col("prediction").alias("pred")))
    whole = pooled_accuracy(scored).select("accuracy").crossJoin(  # one row each
        mean_cross_entropy(scored).select(F.col("cross_entropy").alias("log_loss"), F.col("total").alias("n_rows")))
    return class_report(scored).crossJoin(F.broadcast(whole))
