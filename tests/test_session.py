from ledgerloom import session


def test_checkpoint_cuts_lineage(spark):
    df = session.checkpoint(spark.range(10).repartition(3))
    assert df.count() == 10 and "Exchange" not in df._jdf.queryExecution().toString()


def test_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(spark.range(5).coalesce(1)).rdd.getNumPartitions() == cores
    wide = spark.range(5).repartition(cores * 3)
    assert session.spread(wide).rdd.getNumPartitions() == cores * 3
    assert session.fan_out(spark.range(5)).count() == 5


def test_shipped_once(spark):
    session.ship(spark)
    session.ship(spark)
    assert spark.sparkContext._ledgerloom_shipped
