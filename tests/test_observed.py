"""Checks observed while a table is written: equal to their own passes, and counted once."""

import pytest
from pyspark.sql import functions as F

from reviewkit.operators import observed as O
from reviewkit.operators import quality as Q


def _stars(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("rid"), F.when(F.col("id") % 11 != 0, (F.col("id") % 7).cast("int")).alias("star"))


def test_profile_equals_the_pass(spark):
    df = _stars(spark).repartition(5)
    table, profile = O.stored_profile(df)
    assert sorted(map(tuple, profile.collect())) == sorted(map(tuple, Q.profile(df).collect()))
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_range_equals_the_pass_and_fails_outside(spark):
    df = _stars(spark)
    _, seen = O.store_observed(df, O.range_measures("star"))
    want = Q.range_summary(df, "star").first()
    assert seen == want.asDict() and seen["violations"] > 0
    with pytest.raises(ValueError, match="Label out of range: min=0 max=6"):
        O.check_range(seen)
    _, good = O.store_observed(df.where("star BETWEEN 1 AND 5 OR star IS NULL"), O.range_measures("star"))
    O.check_range(good)


def test_empty_table_has_values(spark):
    _, seen = O.store_observed(_stars(spark, 0), {**O.range_measures("star"), **O.profile_measures(["star"])})
    assert seen == {"min_value": None, "max_value": None, "violations": 0, "rows": 0, "nulls0": 0}
    O.check_range(seen)


def test_alignment_equals_the_pass(spark):
    a = spark.range(100).where("id % 3 <> 0").select(F.col("id").alias("k"), F.lit(True).alias("l"))
    b = spark.range(120).where("id % 7 <> 0").select(F.col("id").alias("k"), F.lit(True).alias("r"))
    _, seen = O.store_observed(a.join(b, "k", "full_outer"), O.alignment_measures("l", "r"))
    assert seen == Q.alignment(a, b, "k").first().asDict()
    with pytest.raises(ValueError, match="not aligned"):
        O.check_alignment(seen)


def test_rows_behind_a_shuffle_are_counted_once(spark):
    """A shuffle below the write, and rows over several tasks: each row in one measure only."""
    df = _stars(spark, 5000).repartition(13, "rid").groupBy("rid").agg(F.max("star").alias("star"))
    _, seen = O.store_observed(df, O.profile_measures(["rid", "star"]))
    assert (seen["rows"], seen["nulls0"], seen["nulls1"]) == (5000, 0, 455)


def test_examples_scan_their_inputs_once(spark):
    """E5 runs one job over its join: the encoding's expression is evaluated once a row."""
    from reviewkit.operators.encode import assemble_examples
    calls = spark.sparkContext.accumulator(0)

    def counted(x):
        calls.add(1)
        return x

    enc = spark.range(50).select(F.col("id").alias("rid"), F.udf(counted, "long")("id").alias("v")) \
        .select("rid", F.array("v").alias("input_ids"))
    stars = spark.range(50).select(F.col("id").alias("rid"), (F.col("id") % 5 + 1).cast("int").alias("star"))
    assert assemble_examples(enc, stars, "rid").count() == 50 and calls.value == 50
