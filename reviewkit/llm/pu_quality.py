"""Quality classifier learned from positives and unlabelled text (non-negative PU risk).

Trusted positives are documents labelled 1; everything else is unlabelled web text, in which a share ``prior`` is
positive. The prior is estimated from the data: a first classifier separates positives from unlabelled text, and over
its score thresholds the ratio of accepted unlabelled to accepted positive rows, with confidence margins, is smallest
where almost only positives are accepted. The final linear classifier minimises the non-negative unbiased
risk ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` under the logistic loss.

Fitted on a bounded sample (``POSITIVES`` and ``UNLABELLED`` rows of smallest id hash); every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewkit.llm.words import texts
from reviewkit.session import ship_package

#: Most rows the classifier is fitted on, by kind.
POSITIVES, UNLABELLED = 6_000, 12_000
#: Hashed byte pairs, and all features: bytes 0-127 and the rest, pairs, and shape statistics.
PAIRS = 128
SHAPES = 12
FEATURES = 129 + PAIRS + SHAPES
#: Columns of the sample whose spread is taken at once.
COLUMNS = 16
#: A document is predicted to be good from this score on.
THRESHOLD = 0.3


def features(text: bytes | None) -> np.ndarray:
    """Fixed-length description of a whole text; null like empty."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    b = np.frombuffer(text, np.uint8)
    counts = np.bincount(b, minlength=256)
    n = len(b)
    out[:128] = counts[:128]
    out[128] = counts[128:].sum()
    pair = (b[:-1].astype(np.uint32) * np.uint32(0x9E37) + b[1:] * np.uint32(0x85EB)) * np.uint32(0x9E3779B1)
    out[129:129 + PAIRS] = np.bincount(pair >> np.uint32(25), minlength=PAIRS)
    out[:129 + PAIRS] = np.sqrt(out[:129 + PAIRS] / n)
    words = text.split()
    k = max(len(words), 1)
    lines = text.split(b"\n")
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    letters = upper + lower + out[128] ** 2 * n
    out[129 + PAIRS:] = (
        np.log1p(n), np.log1p(k), (n - counts[32]) / k / 10, len(set(words)) / k, len(set(lines)) / len(lines),
        upper / n, digit / n, letters / n, upper / max(letters, 1.0), (n - letters - digit - counts[32] - counts[10]) / n,
        np.log1p(k / len(lines)), counts[10] / n * 10)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _fit(x: np.ndarray, weight_pos: np.ndarray, weight_neg: np.ndarray, clipped: tuple[np.ndarray, float] | None = None,
         steps: int = 300, rate: float = 0.03, decay: float = 3e-4) -> np.ndarray:
    """Linear logistic fit by Adam: ``sum weight_pos * loss(+) + weight_neg * loss(-)`` over the rows.

    With ``clipped`` = (positive rows' mask, prior) the negative part is the non-negative PU estimate: while it is below zero
    the step goes up its own gradient only.
    """
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    for t in range(1, steps + 1):
        g = x @ w
        up = weight_neg * _sigmoid(g)             # derivative of the negative part's loss
        down = -weight_pos * _sigmoid(-g)
        if clipped is not None and (weight_neg * np.logaddexp(0, g)).sum() < 0:
            grad = -(x.T @ up)
        else:
            grad = x.T @ (up + down)
        grad = grad + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled rows, from held-out scores of both.

    Over all thresholds: accepted share of the unlabelled over that of the positives, plus a margin that grows as the
    accepted positives get few; the smallest upper bound is taken at its ratio.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.quantile(positive, np.linspace(0, 0.98, 99))
    qp = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    qu = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    margin = np.sqrt(np.log(100) / 2) * (len(unlabelled) ** -0.5 + len(positive) ** -0.5)
    best = np.argmin((qu + margin) / np.maximum(qp, 1e-9))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.05, 0.99))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._rows(x) @ self.weights)

    def _rows(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(x), 1))], 1)


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Class prior, then the non-negative PU risk, on feature rows."""
    # One matrix in double precision, scaled in place; all else are views of it, or columns at a time.
    x = np.ones((len(positive) + len(unlabelled), positive.shape[1] + 1))
    x[:len(positive), :-1], x[len(positive):, :-1] = positive, unlabelled
    z = x[:, :-1]
    spread = [z[:, i:i + COLUMNS].std(0) for i in range(0, z.shape[1], COLUMNS)]
    model = Model(z.mean(0), np.maximum(np.concatenate(spread), 1e-3), np.zeros(x.shape[1]), 0.5)
    z -= model.mean
    z /= model.scale
    np.clip(z, -8, 8, out=z)
    p, u = x[:len(positive)], x[len(positive):]
    # Prior: a positive-against-unlabelled classifier on even rows, judged on odd ones.
    pe, ue = p[::2], u[::2]
    first = _fit(np.concatenate([pe, ue]), np.r_[np.full(len(pe), 0.5 / len(pe)), np.zeros(len(ue))],
                 np.r_[np.zeros(len(pe)), np.full(len(ue), 0.5 / max(len(ue), 1))], steps=200)
    model.prior = estimate_prior(p[1::2] @ first, u[1::2] @ first)
    good = np.r_[np.full(len(p), model.prior / len(p)), np.zeros(len(u))]
    bad = np.r_[np.full(len(p), -model.prior / len(p)), np.full(len(u), 1 / max(len(u), 1))]
    model.weights = _fit(x, good, bad, clipped=(good > 0, model.prior))
    return model


def held_out(doc_id: Column, k: int = 5) -> Column:
    """crc32 of the id as text leaves remainder 0; so does, by definition, a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % k == 0, F.lit(True))


def _sample(ids: DataFrame, n: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(n)


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on documents that are not held out; None without trusted positives."""
    ids = docs.select(F.col("doc_id").cast("long")).where(~held_out(F.col("doc_id"))).distinct()
    trusted = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).groupBy("doc_id")
               .agg(F.min("quality").alias("q")).where("q = 1").select("doc_id"))
    p = _sample(ids.join(trusted, "doc_id"), POSITIVES).withColumn("kind", F.lit(1))
    u = _sample(ids, UNLABELLED).withColumn("kind", F.lit(0))
    chosen = p.union(u).groupBy("doc_id").agg(F.max("kind").alias("p"), F.min("kind").alias("u"))

    @F.arrow_udf("binary")
    def rows(text: pa.Array) -> pa.Array:
        return pa.array([features(t).tobytes() for t in texts(text)], pa.binary())

    # At most POSITIVES + UNLABELLED ids, and one row of each: the smallest text hash.
    got = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
           .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "p", "u")
           .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
           .select("doc_id", "p", "u", rows("text").alias("x")).collect())
    got.sort(key=lambda r: r.doc_id)  # here, not in Spark: to find ranges Spark would read the texts and send features once more
    positive, unlabelled = ([r.x for r in got if r[k] == v] for k, v in (("p", 1), ("u", 0)))
    del got
    if not positive:
        return None
    return fit(*(np.frombuffer(b"".join(x), np.float32).reshape(-1, FEATURES) for x in (positive, unlabelled)))


def score_quality(docs: DataFrame, labels: DataFrame, keep: bool = False) -> DataFrame:
    """Quality of every whole text, learned from ``labels.quality``.

    Returns per row of ``docs``: doc_id, held_out (not learned from), score (0 to 1), predicted (1 from ``THRESHOLD``), prior.
    With ``keep``, the input's columns and __pu_score, __pu_predicted. Only doc_id and text are read: neither
    labels nor other columns enter a score.

    Null and empty texts have all-zero features and one common score. Null ids are held out. A document labelled both ways
    is no trusted positive. Without trusted positives every score is 0.5. Repeated rows score alike; an empty table
    gives an empty result.

    Scale: one pass to find the sample's ids (a bounded top-k per task), one to read their texts, one to score; only
    the sample's texts are shuffled, one of each id and task at most.
    """
    ship_package(docs.sparkSession)
    model = train(docs, labels)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(text), 0.5))
        rows = texts(text)
        return pa.array(model.score(np.stack([features(t) for t in rows])) if rows else np.empty(0))

    good = (F.col("__pu_score") >= THRESHOLD).cast("int")
    if keep:
        own = [c for c in docs.columns if c.lower() not in ("__pu_score", "__pu_predicted")]
        return docs.select(*own, score(F.col("text").cast("string")).alias("__pu_score")).withColumn("__pu_predicted", good)
    prior = F.lit(model.prior if model else None).cast("double")
    return docs.select(F.col("doc_id").cast("long"), score(F.col("text").cast("string")).alias("__pu_score")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__pu_score").alias("score"),
        good.alias("predicted"), prior.alias("prior"))
