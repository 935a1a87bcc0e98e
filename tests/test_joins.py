"""Size-checked broadcast: broadcast within both bounds, shuffle join beyond them."""

from reviewkit.operators.joins import checked_broadcast, table_size


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_size_counts_text_and_arrays(spark):
    df = spark.createDataFrame([("abcd", [1.0, 2.0]), ("é", [])], "s string, v array<double>")
    n, nbytes = table_size(df)
    assert n == 2
    # strings: 4 + 8 and 2 + 8 bytes; arrays: 2 * 8 + 16 and 16 bytes
    assert nbytes == (12 + 10) + (32 + 16)


def test_broadcast_only_within_bounds(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.createDataFrame([(i, "word%d" % i) for i in range(50)], "k long, w string")
        yes = big.join(checked_broadcast(small), "k")
        no = big.join(checked_broadcast(small, max_bytes=100), "k")
        assert "BroadcastHashJoin" in plan_of(yes)
        assert "BroadcastHashJoin" not in plan_of(no)
        assert yes.count() == no.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_spread_only_when_asked_for(spark):
    from reviewkit.sources.driver import SPREAD_CONF, table
    sf = "/root/testdata/sf0.001"
    assert "Exchange" not in plan_of(table(spark, sf, "conversations"))
    spark.conf.set(SPREAD_CONF, "3")
    try:
        plan = plan_of(table(spark, sf, "conversations"))
        assert "Exchange hashpartitioning(conv_id" in plan and "turn" in plan  # the full row key
        assert "Exchange" not in plan_of(table(spark, sf, "orders"))
    finally:
        spark.conf.unset(SPREAD_CONF)


def test_materialize_writes_columns_that_reads_prune(spark):
    from pyspark.sql import functions as F

    from reviewkit.operators.joins import materialize
    t = materialize(spark.range(10).select("id", F.lit("x").alias("s"), F.array(F.lit(None).cast("int")).alias("a")))
    assert t.count() == 10 and "ReadSchema: struct<id:bigint>" in plan_of(t.select("id"))


def test_no_local_folder_on_a_cluster(monkeypatch):
    """Without a shared folder only a run on one machine may make its own."""
    from types import SimpleNamespace

    import pytest

    from reviewkit.session import work_dir

    def fake(master):
        made = {}
        return SimpleNamespace(
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: made.get("d"), setCheckpointDir=lambda d: made.update(d=d)),
            conf=SimpleNamespace(get=lambda k, default=None: default, set=lambda k, v: None))

    for master in ("spark://h:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            work_dir(fake(master))
    for master in ("local", "local[*]", "local[8]"):
        assert work_dir(fake(master))
