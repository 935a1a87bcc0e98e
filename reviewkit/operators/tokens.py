"""Tokenizing and stop-word removal.

Tokens are kept as ``array<string>`` per review: the array form needs no shuffle
and no regrouping. A stop list given as words becomes a literal set in the plan (a
hash probe per token); one given as a table is anti-joined, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.functions.arrays import explode_rows
from reviewkit.functions.text import clean_text, letter_tokens
from reviewkit.operators.joins import materialize
from reviewkit.operators.ranking import as_list
from reviewkit.session import ship_package


def not_stopped(token: Column, stopwords: Iterable[str], case_sensitive: bool) -> Column:
    """Whether a token stays. The list is taken as written: J3 lower-cases the token only."""
    words = list(dict.fromkeys(stopwords))
    probe = token if case_sensitive else F.lower(token)
    return ~probe.isin(words) if words else F.lit(True)


def remove_stopwords(df: DataFrame, tokens_col: str, stopwords: Iterable[str] | DataFrame,
                     case_sensitive: bool = False, out_col: str | None = None) -> DataFrame:
    """Drop stop words from an array column, keeping order and duplicates.

    ``case_sensitive=False`` (J3) compares the lower-cased token with the list as it
    stands and keeps the original token; ``True`` (J4) is an exact match. A list given
    as a table (column ``word``) is anti-joined with the exploded tokens.
    """
    out_col = out_col or tokens_col
    if isinstance(stopwords, DataFrame):
        return _anti_join(df, tokens_col, stopwords, case_sensitive, out_col)
    words = list(stopwords)
    kept = F.filter(F.col(tokens_col), lambda t: not_stopped(t, words, case_sensitive))
    cols = [c for c in df.columns if c != out_col]
    return df.select(*cols, kept.alias(out_col))


def _anti_join(df: DataFrame, tokens_col: str, words: DataFrame, case_sensitive: bool, out_col: str) -> DataFrame:
    """The same by a join: distinct tokens, then their stopped ones per row, as maps of bounded work per row.

    Rows keep an id of their own for the regrouping, which is stored so that it stays the same.
    """
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()))
    long = rows.select("__row", F.posexplode(tokens_col).alias("__pos", "__token"))
    probe = F.col("__token") if case_sensitive else F.lower("__token")
    kept = long.join(words.select(F.col("word").alias("__word")).distinct(), probe == F.col("__word"), "left_anti")
    lists = kept.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("__pos", "__token"))).alias("__kept"))
    empty = F.when(F.col(tokens_col).isNotNull(), F.array().cast("array<string>"))
    cols = [c for c in df.columns if c != out_col]
    return rows.join(lists, "__row", "left").select(
        *cols, F.coalesce(F.col("__kept.__token"), empty).alias(out_col))


def tokenize(df: DataFrame, text_col: str = "comment", out_col: str = "tokens",
             profile: str = "full", stopwords: Iterable[str] | DataFrame | None = None,
             exact_stopwords: Iterable[str] | DataFrame | None = None,
             tokenizer: Callable[[Column], Column] = letter_tokens) -> DataFrame:
    """Clean -> split into tokens -> optional stop-word filters.

    ``stopwords`` is applied case-insensitively (J3), ``exact_stopwords`` exactly
    (J4), in that order. ``tokenizer`` maps a cleaned text column to an
    ``array<string>`` column (U1); the default takes runs of Unicode letters.
    Tokens keep their case.
    """
    res = df.withColumn(out_col, tokenizer(clean_text(F.col(text_col), profile)))
    if stopwords is not None:
        res = remove_stopwords(res, out_col, stopwords, case_sensitive=False)
    if exact_stopwords is not None:
        res = remove_stopwords(res, out_col, exact_stopwords, case_sensitive=True)
    return res


def python_tokenizer(fn: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """Wrap a user ``str -> list[str]`` callable as an Arrow pandas UDF.

    Use it only when no column expression can do the job; it runs in Python
    workers in Arrow batches, never row by row through the JVM.
    """

    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)

    @F.pandas_udf("array<string>")
    def _tok(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: None if s is None else list(fn(s)))

    return _tok


def explode_tokens(df: DataFrame, key: str | Sequence[str], tokens_col: str = "tokens",
                   keep_empty: bool = False) -> DataFrame:
    """Long form (key, pos, token); ``keep_empty`` keeps empty lists as one null row."""
    if keep_empty:
        return df.select(*as_list(key), F.posexplode_outer(tokens_col).alias("pos", "token"))
    return explode_rows(df, as_list(key), F.col(tokens_col), "token", pos_name="pos")
