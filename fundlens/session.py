"""Session settings.

``build_session`` is a thin helper over ``SparkSession.builder`` with the
settings the plans rely on (ANSI on, UTC, adaptive execution with skew-join
handling). On a cluster, pass the master and resources through
``spark-submit`` and only the ``extra`` settings here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "fundlens", master: str | None = None,
                  shuffle_partitions: int | None = None, driver_memory: str | None = None,
                  jars: str | None = None, log_level: str = "WARN",
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if jars:
        conf["spark.jars"] = jars
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as is; when it is
    unset there, this raises instead of falling back to a folder only one machine
    sees. Only a local master (tests, a laptop) gets a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ABFS ...) "
                               "for staged tables and checkpoints")
        current = tempfile.mkdtemp(prefix="fundlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back, so that every
    later use sees the very same rows and an executor lost later costs no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

