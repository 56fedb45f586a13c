"""Spark session defaults for the library.

On a cluster the session already exists and carries its own settings; the
helpers below only fill in what is unset, so they are safe to call there.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins from measured sizes
# (runtime broadcast only when the shuffled side is actually small, sort-merge
# otherwise), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable RDD checkpoint files once their DataFrame is out of scope
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set for local runs and tests; on a cluster leave it
    ``None`` so the submitter decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEM", "16g"))
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared filesystem folder and is used as
    is. Only when it is unset (local runs, tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
