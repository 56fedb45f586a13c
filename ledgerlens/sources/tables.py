"""Reading input tables.

Reads are lazy: callers ``select`` the columns they need and filter early,
and Catalyst pushes both into the Parquet scan (``ReadSchema`` /
``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    single = os.path.join(base_dir, f"{name}.parquet")
    return single if os.path.exists(single) or "://" in base_dir else os.path.join(base_dir, name)


def table_bytes(spark: SparkSession, base_dir: str, name: str) -> int:
    """Bytes of one table's files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(base_dir, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def read_table(spark: SparkSession, base_dir: str, name: str, schema=None) -> DataFrame:
    """One Parquet table by name under ``base_dir`` (``<name>.parquet`` file or folder)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(base_dir, name))


def read_tables(spark: SparkSession, base_dir: str, names: Iterable[str], schemas: dict | None = None) -> dict[str, DataFrame]:
    schemas = schemas or {}
    return {n: read_table(spark, base_dir, n, schemas.get(n)) for n in names}


class Tables:
    """Lazy accessor ``t.orders`` / ``t["orders"]`` over a folder of Parquet tables."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark, self.base_dir, self._cache = spark, base_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base_dir, name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "base_dir"):
            raise AttributeError(name)
        return self[name]


def shared_path(spark: SparkSession, *parts: str) -> str:
    """The path ``parts`` under the shared folder named by ``spark.checkpoint.dir``.

    The configured folder itself is used (not the per-application subfolder
    Spark creates for RDD checkpoints): a caller that gives the same parts
    again overwrites its earlier tables, one that gives fresh parts adds to them.
    """
    from ledgerlens.session import checkpoint_dir

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return os.path.join(base, "ledgerlens", "tables", *parts)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that run inside remove their shuffle files when they end, not when the driver collects its garbage.

    For queries whose result is written: nothing else reads their shuffles.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def write_read(spark: SparkSession, df: DataFrame, *parts: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the re-read table."""
    path = shared_path(spark, *parts)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
