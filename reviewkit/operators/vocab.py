"""Word counts, frequency lists and vocabularies.

Counting explodes the token arrays and aggregates on the token. The aggregate is
partial before the shuffle, so a very frequent token costs one row per task, not
one row per occurrence.

Vocabulary layout: ``(token, freq, token_id)``; special tokens first
(``<unk>`` = 0, ``<pad>`` = 1), then words by frequency descending and token
ascending (Spark compares strings by UTF-8 bytes = code point order). Ids come
from :func:`reviewkit.operators.ranking.exact_rank`, which range-partitions on
(frequency, token): no step sorts or broadcasts the whole vocabulary, whatever
the language.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.functions.arrays import explode_rows
from reviewkit.operators.joins import materialize

from reviewkit.operators.ranking import exact_rank

# --- fixed values ------------------------------------------------------------
UNK, PAD = "<unk>", "<pad>"
SPECIALS = (UNK, PAD)
HIGH_FREQUENCY_MIN = 1000  # inclusive threshold of the high-frequency word list
# -----------------------------------------------------------------------------


def word_counts(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """A4: (token, freq) over all token arrays."""
    return (explode_rows(df, [], F.col(tokens_col), "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))


def high_frequency_words(counts: DataFrame, min_count: int = HIGH_FREQUENCY_MIN) -> DataFrame:
    """A5 + K1: words with freq >= min_count, most frequent first, ties by token."""
    return counts.filter(F.col("freq") >= min_count).orderBy(F.desc("freq"), F.asc("token"))


def most_common(counts: DataFrame, k: int | None = None) -> DataFrame:
    """K1: frequency-descending order; with ``k`` a top-k (TakeOrderedAndProject)."""
    ordered = counts.orderBy(F.desc("freq"), F.asc("token"))
    return ordered.limit(k) if k is not None else ordered


def build_vocabulary(counts: DataFrame, min_freq: int = 16,
                     specials: Sequence[str] = SPECIALS) -> DataFrame:
    """(token, freq, token_id) with specials first, then ids from len(specials).

    Literal special tokens in the text are not counted as words. Special rows
    carry freq = 0.
    """
    spark = counts.sparkSession
    # The thresholded counts (one row per kept word, far smaller than the text)
    # are stored: the range sort samples them before it sorts them, and each read
    # would otherwise re-run cleaning, tokenizing and counting over the corpus.
    words = materialize(
        counts.filter((F.col("freq") >= min_freq) & ~F.col("token").isin(list(specials))))
    ranked = exact_rank(words, [F.col("freq").desc(), F.col("token").asc()], "__r")
    words = ranked.select("token", "freq",
                          (F.col("__r") + F.lit(len(specials) - 1)).cast("long").alias("token_id"))
    special_rows = spark.createDataFrame(
        [(s, 0, i) for i, s in enumerate(specials)], "token string, freq long, token_id long")
    return special_rows.unionByName(words)


def vocabulary_size(vocab: DataFrame) -> DataFrame:
    """Number of entries, specials included."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


def save_vocabulary(vocab: DataFrame, path: str, min_freq: int | None = None) -> None:
    """Write the vocabulary as parquet; ``min_freq`` is kept in the schema metadata."""
    meta = {"min_freq": min_freq} if min_freq is not None else {}
    vocab.select(F.col("token").alias("token", metadata=meta), "freq", "token_id") \
        .write.mode("overwrite").parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved vocabulary."""
    return spark.read.parquet(path)


def write_word_list(words: DataFrame, path: str) -> None:
    """One word per line, most frequent first.

    A range sort: the part files follow one another in the order, so reading them by
    name gives the list whatever its size.
    """
    words.orderBy(F.desc("freq"), F.asc("token")).select("token").write.mode("overwrite").text(path)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """(line, token) of a written word list, lines counted over the part files in order."""
    from reviewkit.operators.ranking import exact_rank
    lines = spark.read.text(path).select(
        F.col("value").alias("token"), F.col("_metadata.file_name").alias("__file"),
        F.monotonically_increasing_id().alias("__id"))
    return exact_rank(lines, [F.col("__file"), F.col("__id")], "line").select("line", "token")
