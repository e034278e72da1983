"""Session helpers.

The library never creates a session behind the caller's back in operators; jobs and tests call
:func:`get_session`. Only settings the operators depend on are pinned here: UTC session zone (so
``to_date``/``datediff`` never see an offset), AQE with skew-join splitting and partition coalescing.
On a cluster without an explicit shuffle-partition count, the count is sized from the executor cores
(:func:`cluster_shuffle_partitions`) and AQE coalesces it per stage; an explicit value is honoured.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_WRITTEN: dict[str, list[str]] = {}


def get_session(master: str | None = None, app: str = "lakestrata", shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a partition counts as skewed when it is 5x the median and over 256 MB: AQE then splits it
        # and replicates the matching side, so a hot order_id cannot pin one task
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    sc = spark.sparkContext
    sc.setLogLevel("ERROR")
    if (not shuffle_partitions and not sc.master.startswith("local")
            and not sc.getConf().contains("spark.sql.shuffle.partitions")):
        # AQE only merges shuffle partitions (and splits skewed join sides); it never splits a big one.
        # Spark's default of 200 would put terabytes in each, so start from the cluster's size
        conf_items = dict(sc.getConf().getAll())
        spark.conf.set("spark.sql.shuffle.partitions",
                       str(cluster_shuffle_partitions(conf_items, sc.defaultParallelism)))
    return spark


def cluster_shuffle_partitions(conf: dict[str, str], default_parallelism: int, waves: int = 3,
                               minimum: int = 200) -> int:
    """Shuffle partitions for a cluster: ``waves`` task waves over every executor core the job can get
    (fixed executor count, else the dynamic-allocation maximum, else the current parallelism). AQE
    coalesces the partitions a small stage does not need."""
    executors = int(conf.get("spark.executor.instances") or conf.get("spark.dynamicAllocation.maxExecutors") or 0)
    cores = int(conf.get("spark.executor.cores") or 1)
    slots = executors * cores if executors else default_parallelism
    return max(minimum, waves * slots)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read; a cluster session without
    it is an error (a machine-local folder would not be visible to the executors). When it is unset in
    local mode (local runs and tests) a fresh scratch folder is created and registered once.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (e.g. on HDFS or the object store)")
        d = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and return the re-read frame.

    Used where a plan must be evaluated exactly once (its later uses must see the same rows in the
    same places) and to cut the lineage: one columnar write instead of ``checkpoint()``'s count job
    plus serialized-row write, and a lost executor never re-runs the upstream plan.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/lakestrata-{tag}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables that :func:`materialize` wrote for this application, once their results have been
    used; returns how many there were."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)
