"""Session set-up shared by tests, the bench and the entry points.

On a cluster the session already exists and carries its own settings; the
helpers here only fill in what is missing, they never override a value the
cluster provides (notably ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# ``spark.sql.shuffle.partitions`` is left to the cluster: size it so a
# shuffle partition holds a few hundred MB at the target scale (tens of
# thousands of partitions for ~100 TB) and let AQE coalesce small ones.
# Settings every plan in this package relies on. AQE re-plans joins and
# coalesces/splits shuffle partitions at runtime; skew-join splits a hot key
# (one key may hold a third of the rows) across tasks.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tabulon", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and the bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the executor; 1g (the default) is too small
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def held(*frames):
    """The frames persisted (memory, spilling to disk) for several actions,
    and released afterwards."""
    kept = [f.persist() for f in frames]
    try:
        yield kept[0] if len(kept) == 1 else kept
    finally:
        for f in kept:
            f.unpersist()


SWEEP_S = 10  # seconds


@contextmanager
def swept(spark: SparkSession, every: float = SWEEP_S):
    """Long fits leave the shuffle files of every iteration behind: Spark
    deletes those that nothing refers to when the driver's JVM collects its
    garbage, which a job with little garbage on the driver seldom does. Here it
    is asked to every few seconds."""
    over = threading.Event()

    def sweep():
        while not over.wait(every):
            spark.sparkContext._jvm.System.gc()

    thread = threading.Thread(target=sweep, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there). Only a local session without the setting gets a fresh
    scratch folder; on a cluster a machine-local folder would be lost to the
    other machines, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="tabulon-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut(df):
    """``df`` cut from its lineage by a reliable checkpoint in the shared
    folder: several readers share one computation, and nothing stays cached."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df):
    """``df`` cut from its lineage by a Parquet table in the shared folder:
    later passes read only the columns they need, and a filter above it meets
    stored values instead of the expressions behind them."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_AT_ONCE = 5_000_000  # rows that fits submitted together keep in memory


def at_once(df) -> int:
    """How many independent fits over ``df`` to submit together: enough to use
    the cores where the rows lie in few tasks (small tables have one row
    group), one where a fit fills the cores itself or the table is large."""
    n = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    rows, most = n[0] or 1, n[1] or 1
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(cores * most // rows, ROWS_AT_ONCE // rows, cores))


def submitted(spark: SparkSession, jobs: list, width: int) -> list:
    """The results of the functions ``jobs``, in their order, ``width`` of them
    at a time: Spark jobs that are submitted from several threads share the
    cores. Each job runs as it would alone, in the same tasks."""
    with ThreadPoolExecutor(max(1, width)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
