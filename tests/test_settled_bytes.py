"""A table is broadcast within a bound of rows and one of bytes, and a caller's cache is left alone."""

from loomframe.plans.runtime import settle


def test_few_but_long_rows_are_not_broadcast(spark):
    df = spark.range(50).selectExpr("id", "repeat('x', 1000) AS text", "sequence(0L, id) AS a", "named_struct('b', 1) AS s", "CAST(NULL AS STRING) AS n")
    spark.conf.set("spark.loomframe.broadcastBytes", 40_000)
    try:
        long = settle(df)
        assert not long.small and long.df.count() == 50 and long.df.columns == df.columns
        assert settle(df.select("id", "s", "n")).small and settle(df.filter("id < 20")).small and settle(df.filter("id < 0")).small
    finally:
        spark.conf.unset("spark.loomframe.broadcastBytes")
    assert settle(df).small


def test_a_callers_cache_stays(spark):
    df = spark.range(10).selectExpr("id", "'a' AS text").cache()
    df.count()
    assert settle(df).small and df.storageLevel.useMemory
    df.unpersist()
    assert not settle(df).df.storageLevel.useMemory
