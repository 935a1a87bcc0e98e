"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

A source's mean repetition rate is its target share of the output over its own size. Every document draws a uniform
number from a hash of the seed, its id and its text and inverts its source's Poisson distribution with it: the draw is
independent of partitions, retries and other documents. Documents are exploded by their count, and the copies are put
into a global random order by a hash of seed, id, text and copy number.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewkit.llm.components import stored

#: Uniform draws have this many bits (13 hex digits of an md5 digest, exact in a double).
DRAW_BITS = 52
_P = "__mix_"


def rates(docs: DataFrame, weights: Mapping[str, float], budget: float | None = None) -> DataFrame:
    """(source, n, rate): mean repetition of each source's documents.

    ``weights`` are target shares of the output's documents and are normalised over the sources that occur; a source
    that is not listed has the weight ``weights['*']`` (default 1). ``budget`` is the mean number of output rows (default:
    as many as the input). A null source is a source of its own and counts as not listed.
    """
    listed = {k: v for k, v in weights.items() if k != "*"}
    if any(not (0 <= v < math.inf) for v in weights.values()):
        raise ValueError("weights are finite and not negative")
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    weight = F.lit(float(weights.get("*", 1.0)))
    for k, v in sorted(listed.items()):
        weight = F.when(F.col("source") == k, F.lit(float(v))).otherwise(weight)
    sizes = sizes.withColumn("w", weight)
    totals = sizes.agg(F.sum("w").alias("ws"), F.sum("n").alias("ns"))
    out = F.col("ns").cast("double") if budget is None else F.lit(float(budget))
    return sizes.crossJoin(F.broadcast(totals)).select(  # one row
        "source", "n", F.when(F.col("ws") > 0, F.col("w") / F.col("ws") * out / F.col("n")).otherwise(0.0).alias("rate"))


def uniform(seed: int, *keys: Column) -> Column:
    """In [0, 1): 52 bits of the md5 digest of ``seed:key:key``; null keys are written as ``~``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("~")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << DRAW_BITS))


def distribution(rate: Column) -> Column:
    """Cumulative probabilities of Poisson(rate) for 0, 1, 2, ... until no draw of 52 bits lies above.

    Large rates are split into equal parts of at most 16 by :func:`replicate`, so ``exp(-rate)`` never underflows;
    80 terms leave less than 2 ** -53 above the last.
    """
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(80)), start, lambda a, k: F.struct(
        (a["p"] * rate / k).alias("p"),
        F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * rate / k)).alias("cdf")))
    return terms["cdf"]


def draw(cdf: Column, u: Column) -> Column:
    """The smallest k with u < P(X <= k)."""
    return F.size(F.filter(cdf, lambda c: c <= u))


def replicate(docs: DataFrame, weights: Mapping[str, float], budget: float | None = None, seed: int = 17) -> DataFrame:
    """Every document repeated Poisson(rate of its source) times, in global random order.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; all its columns are returned, and __mix_copy (0, 1, ... of a document),
    __mix_count, __mix_rate and __mix_order (the sort key of the shuffle). Documents that draw 0 go.

    A null source is a source of its own. A document is its id and its text: rows that share an id, or have none, draw
    by their texts; rows that repeat in both draw alike, being the same document. Null and empty texts are repeated like others. Input columns that begin with __mix_ are
    replaced. Empty table: empty result; a rate above 16 is drawn as the sum of equal parts.

    Scale: one count per source (partially aggregated), a rate table of one row per source joined back (broadcast by
    Spark when small; a hot source's partition is split otherwise), and one range shuffle of the copies.
    """
    own = [c for c in docs.columns if not c.lower().startswith(_P)]
    table = stored(rates(docs.select("source"), weights, budget), "rates")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / 16)).cast("int")
    table = table.select(F.col("source").alias(_P + "source"), F.col("rate").alias(_P + "rate"), parts.alias(_P + "parts"),
                         distribution(F.col("rate") / parts).alias(_P + "cdf"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.coalesce(F.md5("text"), F.lit("~")))
    # Bound as an array of one: inside a lambda the text's digest would be made for every term of the distribution.
    counts = F.transform(F.array(_P + "key"), lambda k: F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col(_P + "parts")), lambda i: uniform(seed, k, i)), F.lit(0),
        lambda n, u: n + draw(F.col(_P + "cdf"), u)))[0]
    joined = docs.select(*own, key.alias(_P + "key")).join(table, F.col("source").eqNullSafe(F.col(_P + "source")))
    counted = joined.select(*own, _P + "key", F.col(_P + "rate"), counts.alias(_P + "count"))
    # No filter on the count: it would be pushed below and draw a second time.
    copies = counted.select("*", F.explode_outer(F.when(F.col(_P + "count") > 0, F.sequence(F.lit(0), F.col(_P + "count") - 1)))
                            .alias(_P + "copy")).where(F.col(_P + "copy").isNotNull())
    order = F.md5(F.concat_ws(":", F.lit(f"order {seed}"), F.col(_P + "key"), F.col(_P + "copy").cast("string")))
    return copies.withColumn(_P + "order", order).drop(_P + "key").sort(_P + "order", "doc_id")
