"""High-frequency word job (flagship).

reviews -> clean (full profile) -> full-mode dictionary segmentation -> case-insensitive
stop list -> exact stop list -> word count -> keep freq >= ``min_count``, most frequent first.

Segmentation works once per distinct block and already yields (word, count); the stop lists
are then applied to the counted words, which gives the same counts as filtering every
occurrence and touches each distinct word once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewkit.functions.text import clean_text
from reviewkit.operators.segment import HAN_RE, OTHER_RE, pieces_of_units, unit_counts
from reviewkit.operators.tokens import not_stopped
from reviewkit.operators.vocab import HIGH_FREQUENCY_MIN, high_frequency_words


def cleaned_units(reviews: DataFrame, text_col: str = "comment", block_re: str = HAN_RE,
                  other_re: str = OTHER_RE) -> DataFrame:
    """Counts of the units of the cleaned texts, stored: the one pass over the corpus."""
    return unit_counts(reviews.select(clean_text(F.col(text_col), "full").alias("text")), "text", block_re, other_re)


def high_frequency_job(units: DataFrame, dictionary: DataFrame, stopwords: Iterable[str],
                       exact_stopwords: Iterable[str] = (), min_count: int = HIGH_FREQUENCY_MIN,
                       block_re: str = HAN_RE) -> DataFrame:
    """(token, freq), most frequent first, from :func:`cleaned_units` (a dictionary may be built from them too)."""
    words = pieces_of_units(units, dictionary, "full", block_re)
    kept = words.where(not_stopped(F.col("piece"), stopwords, False) & not_stopped(F.col("piece"), exact_stopwords, True))
    return high_frequency_words(kept.select(F.col("piece").alias("token"), "freq"), min_count)
