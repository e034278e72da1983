"""Cluster sizing of shuffle partitions (pure function of the cluster's conf)."""

from lakestrata.session import cluster_shuffle_partitions


def test_fixed_executor_count():
    conf = {"spark.executor.instances": "1000", "spark.executor.cores": "8"}
    assert cluster_shuffle_partitions(conf, default_parallelism=16) == 24000


def test_dynamic_allocation_maximum():
    conf = {"spark.dynamicAllocation.maxExecutors": "500", "spark.executor.cores": "4"}
    assert cluster_shuffle_partitions(conf, default_parallelism=16) == 6000


def test_falls_back_to_parallelism_and_never_below_default():
    assert cluster_shuffle_partitions({}, default_parallelism=400) == 1200
    assert cluster_shuffle_partitions({}, default_parallelism=8) == 200


def test_local_session_keeps_its_count(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_materialized_tables_can_be_dropped(spark):
    import os
    from lakestrata.session import drop_materialized, materialize
    drop_materialized(spark)
    df = materialize(spark.range(5), "drop-test")
    path = os.path.dirname(df.inputFiles()[0].replace("file://", "").replace("file:", ""))
    assert df.count() == 5 and os.path.exists(path)
    assert drop_materialized(spark) == 1 and not os.path.exists(path)
