"""Length statistics, accuracy, loss and training-history metrics.

Inputs:
* predictions: (id, scores array<double>, label int) -> :func:`with_prediction`
* metric history: (epoch, batch, loss, correct, total), one row per mini-batch.

Per-row work is array expressions. A window without a partition runs only over the
per-epoch table (one row per epoch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewkit.functions.arrays import argmax, cross_entropy
from reviewkit.operators.joins import materialize
from reviewkit.operators.ranking import exact_rank

ROUND = 6
# Batch means of 2-decimal values over 32 rows are exact binary fractions, so
# running means often sit exactly on a 6th-digit tie; float noise from the
# summation order would then decide the rounding. The guard rounds ties up.
TIE_GUARD = 1e-9
RUN_BATCHES = 1024  # batches of one run of the running metrics


def round_metric(c):
    """Half-up rounding to 6 digits that is stable at exact ties (non-negative values)."""
    return F.round(c + F.lit(TIE_GUARD), ROUND)


def length_histogram(df: DataFrame, len_col: str = "n_tokens", bins: int = 30) -> DataFrame:
    """Equal-width histogram like ``numpy.histogram(x, bins)``; last bin closed.

    Integer lengths give exact bins: least(bins-1, (n-min)*bins div (max-min)).
    When all lengths are equal, numpy widens the range by 0.5 each side and every
    value lands in the middle bin; that is kept. Empty bins show 0.
    """
    spark = df.sparkSession
    # One pass over the input: rows per distinct length (a small table, partial
    # counts before the shuffle), checkpointed; bounds and bins come from it.
    per_len = materialize(df.groupBy(F.col(len_col).cast("long").alias("__len"))
                          .agg(F.count(F.lit(1)).alias("__c")))
    # Two numbers from the small stored table, used as literals (a scalar
    # subquery column would be planned once per expression that uses it).
    r = per_len.agg(F.min("__len").alias("lo"), F.max("__len").alias("hi")).first()
    if r["lo"] is None:
        lo = hi = F.lit(None).cast("long")
    else:
        lo, hi = F.lit(int(r["lo"])), F.lit(int(r["hi"]))
    n = F.col("__len")
    b = F.when(hi == lo, F.lit(bins // 2)).otherwise(
        F.least(F.lit(bins - 1), F.floor((n - lo) * bins / (hi - lo)))).cast("int")
    counts = per_len.groupBy(b.alias("bin")).agg(F.sum("__c").alias("n"))
    first = F.when(hi == lo, lo - 0.5).otherwise(lo.cast("double"))
    last = F.when(hi == lo, hi + 0.5).otherwise(hi.cast("double"))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = all_bins.join(counts, "bin", "left")
    step = (last - first) / bins
    return out.select(
        "bin",
        F.round(first + F.col("bin") * step, ROUND).alias("lo_edge"),
        F.round(first + (F.col("bin") + 1) * step, ROUND).alias("hi_edge"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def length_coverage(df: DataFrame, len_col: str = "n_tokens", max_len: int = 64) -> DataFrame:
    """Rows with length < max_len and their percentage."""
    return df.agg(
        F.count_if(F.col(len_col) < max_len).cast("long").alias("n_short"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.round(100.0 * F.count_if(F.col(len_col) < max_len) / F.count(F.lit(1)), ROUND)
        .alias("pct_short"))


def with_prediction(df: DataFrame, scores_col: str = "scores", out_col: str = "pred") -> DataFrame:
    """T17 applied: predicted class = argmax of the scores."""
    return df.withColumn(out_col, argmax(F.col(scores_col)))


def pooled_accuracy(pred: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """A10: correct / total over all rows (fraction and percent)."""
    acc = F.avg((F.col(pred_col) == F.col(label_col)).cast("double"))
    return pred.agg(F.round(acc, ROUND).alias("accuracy"),
                    F.round(100.0 * acc, ROUND).alias("accuracy_pct"),
                    F.count(F.lit(1)).cast("long").alias("total"))


def batch_accuracy(pred: DataFrame, batch_col: str = "batch_id", label_col: str = "label",
                   pred_col: str = "pred") -> DataFrame:
    """Accuracy per batch (batch, correct, total, accuracy)."""
    ok = (F.col(pred_col) == F.col(label_col)).cast("long")
    return pred.groupBy(batch_col).agg(
        F.sum(ok).alias("correct"), F.count(F.lit(1)).cast("long").alias("total"),
        F.round(F.avg(ok.cast("double")), ROUND).alias("accuracy"))


def mean_batch_accuracy(batch_acc: DataFrame, max_batch: int | None = None,
                        batch_col: str = "batch_id") -> DataFrame:
    """A12 (all batches) / A13 (batches 0..max_batch): unweighted mean of batch accuracies."""
    b = batch_acc if max_batch is None else batch_acc.filter(F.col(batch_col) <= max_batch)
    acc = F.avg(F.col("correct") / F.col("total"))
    return b.agg(F.round(acc, ROUND).alias("mean_batch_accuracy"),
                 F.count(F.lit(1)).cast("long").alias("batches"))


def mean_cross_entropy(pred: DataFrame, scores_col: str = "scores",
                       label_col: str = "label") -> DataFrame:
    """Mean cross-entropy of scores (logits) against the label."""
    return pred.agg(F.round(F.avg(cross_entropy(F.col(scores_col), F.col(label_col))), ROUND)
                    .alias("cross_entropy"), F.count(F.lit(1)).cast("long").alias("total"))


def class_report(pred: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Per-class precision, recall, F1 and support from the confusion counts."""
    conf = pred.groupBy(label_col, pred_col).agg(F.count(F.lit(1)).alias("n"))
    as_true = conf.select(F.col(label_col).alias("cls"), "n",
                          F.when(F.col(label_col) == F.col(pred_col), F.col("n")).otherwise(0).alias("tp"),
                          F.lit(0).alias("pn"))
    as_pred = conf.select(F.col(pred_col).alias("cls"), F.lit(0).alias("n"), F.lit(0).alias("tp"),
                          F.col("n").alias("pn"))
    per = as_true.unionByName(as_pred).groupBy("cls").agg(
        F.sum("tp").alias("tp"), F.sum("n").alias("support"), F.sum("pn").alias("predicted"))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return per.select(F.col("cls").cast("int").alias("class"),
                      F.round(p, ROUND).alias("precision"), F.round(r, ROUND).alias("recall"),
                      F.round(f1, ROUND).alias("f1"), F.col("support").cast("long").alias("support"))


def metric_history(events: DataFrame, batch_size: int = 32) -> DataFrame:
    """Training-history stand-in from an event log.

    epoch = days since the first event day; batches of ``batch_size`` events in
    (ts, event_id) order inside the epoch; loss = mean ``value`` of the batch,
    correct = purchase events, total = events. One exact rank over (epoch, ts,
    event_id), minus the rows of earlier epochs: no epoch, and no busy second, is
    sorted in one task. Events without a time form an epoch of their own (null).
    """
    first_day = events.agg(F.min(F.to_date("ts")).alias("d")).select("d").scalar()
    e = events.select("event_id", "ts", "value", "event_type",
                      F.datediff(F.to_date("ts"), first_day).alias("epoch"))
    r = exact_rank(e, [F.col("epoch"), F.col("ts"), F.col("event_id")], "__r")
    starts = r.groupBy(F.col("epoch").alias("__e")).agg(F.min("__r").alias("__first"))  # a row per epoch
    r = r.join(F.broadcast(starts), F.col("epoch").eqNullSafe(F.col("__e")))
    r = r.withColumn("batch", F.floor((F.col("__r") - F.col("__first")) / batch_size).cast("long"))
    return r.groupBy("epoch", "batch").agg(
        F.avg("value").alias("loss"),
        F.count_if(F.col("event_type") == "purchase").cast("long").alias("correct"),
        F.count(F.lit(1)).cast("long").alias("total"))


def epoch_loss(history: DataFrame) -> DataFrame:
    """Epoch loss = mean of the batch means."""
    return history.groupBy("epoch").agg(round_metric(F.avg("loss")).alias("epoch_loss"),
                                        F.count(F.lit(1)).cast("long").alias("batches"))


def running_metrics(history: DataFrame) -> DataFrame:
    """Running mean loss and running pooled accuracy (percent) within each epoch.

    A two-level prefix sum: sums per run of ``RUN_BATCHES`` batches, their running sums
    (one row per run), and running sums inside a run, so an epoch's batches are many tasks.
    """
    h = history.withColumn("__run", F.floor(F.col("batch") / RUN_BATCHES))
    sums = {"__loss": F.sum("loss"), "__n": F.count("loss"), "__correct": F.sum("correct"), "__total": F.sum("total")}
    runs = h.groupBy("epoch", "__run").agg(*[v.alias(k) for k, v in sums.items()])
    before = Window.partitionBy("epoch").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("epoch").alias("__e"), F.col("__run").alias("__r"),
                       *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k + "_before") for k in sums])
    j = h.join(runs, F.col("epoch").eqNullSafe(F.col("__e")) & (F.col("__run") == F.col("__r")))
    w = Window.partitionBy("epoch", "__run").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    upto = {k: F.col(k + "_before") + F.coalesce(agg.over(w), F.lit(0)) for k, agg in sums.items()}
    return j.select("epoch", "batch",
                    round_metric(upto["__loss"] / upto["__n"]).alias("running_loss"),
                    round_metric(100.0 * upto["__correct"] / upto["__total"]).alias("running_accuracy"))


def epoch_accuracy(history: DataFrame) -> DataFrame:
    """Per-epoch pooled accuracy in percent (one row per epoch)."""
    return history.groupBy("epoch").agg(
        round_metric(100.0 * F.sum("correct") / F.sum("total")).alias("accuracy"))


def new_best(per_epoch: DataFrame, value_col: str = "accuracy") -> DataFrame:
    """Epochs whose value is strictly above the best so far (start 0.0).

    The window runs over the per-epoch table (one row per epoch).
    """
    w = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.coalesce(F.max(value_col).over(w), F.lit(0.0))
    return per_epoch.select("epoch", value_col, (F.col(value_col) > best_before).alias("is_best"))


def every_nth_epoch(per_epoch: DataFrame, n: int = 20) -> DataFrame:
    """Epochs whose 1-based number is a multiple of n."""
    return per_epoch.filter((F.col("epoch") + 1) % n == 0)
