"""Session construction and cluster-shared locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on; each is applied only when the session leaves it unset
# would be wrong for our semantics (UTC for date/hour functions, AQE for runtime
# re-planning of joins, skewed partitions and partition counts).
_JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stratum") -> SparkSession:
    """Session for tests, benches and local runs. On a cluster use the
    session the platform hands you and call :func:`configure` on it."""
    master = master or os.environ.get("STRATUM_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEM", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in _JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings our results depend on (time zone) and enable AQE."""
    for k, v in _JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is read from ``spark.checkpoint.dir``. Only a session on a
    ``local[...]`` master may do without it (tests): it gets a temporary folder,
    recorded in the session so that later calls share it. On a cluster a
    machine's own folder would be invisible to the others, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: evaluated once, and safe from lost executors.

    The table stays until :func:`release` is called."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def release(spark: SparkSession) -> int:
    """Deletes the intermediate tables that :func:`written` made in this process so far; returns their number.

    For the end of a job, when its results are written elsewhere: data frames that still read those tables break."""
    conf, paths = spark.sparkContext._jsc.hadoopConfiguration(), list(_WRITTEN)
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
        _WRITTEN.remove(path)
    return len(paths)
