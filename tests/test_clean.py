"""F7 cleaning cases: Spark expressions and the DuckDB renderings agree with Python."""

import duckdb
import pytest

from reviewkit.functions.text import clean_text, sql_clean

# (input, expected) for the full profile
CASES = [
    ("好看。，！12３4 abc", "好看     abc"),
    ("{html}<b>x</b> y", "x y"),
    ("a<b\nc>d", "a<b\nc>d"),
    ("a<b\rc>d", "ad"),
    ("a<b c>d", "ad"),
    ("see http://x.y/z?q=1 end", "see  end"),
    ("http　tail", "http tail"),
    ("http://é\xa0x", "x"),
    ("http\x1cx y", "http\x1cx y"),
    ("  \xa0pad\t ", "pad"),
    ("١٢٣ 456", "١٢٣"),
    ("<a><b>", ""),
    ("1<2>3", ""),
    ("hthttp://q q", "ht q"),
    ("\x1c\x1fz\x85", "z"),
    ("{ht<i>ml}x", "{html}x"),
    ("https://a.b/{html}c d", "d"),
]


def test_spark_full_profile(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "id int, s string")
    got = {r.id: r.c for r in df.select("id", clean_text(F.col("s")).alias("c")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, (i, CASES[i][0], got[i], want)


def test_duckdb_full_profile():
    con = duckdb.connect()
    for s, want in CASES:
        got = con.execute(f"SELECT {sql_clean('?')}", [s]).fetchone()[0]
        assert got == want, (s, got, want)


@pytest.mark.parametrize("profile,inp,want", [
    ("punct_only", " a。<b>1 ", "a <b>1"),
    ("strip_only", " a。<b>1 ", "a。<b>1"),
    ("none", " a ", " a "),
])
def test_profiles(spark, profile, inp, want):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(inp,)], "s string")
    assert df.select(clean_text(F.col("s"), profile)).first()[0] == want


def test_unknown_profile():
    from pyspark.sql import functions as F
    with pytest.raises(ValueError):
        clean_text(F.col("x"), "nope")
