"""Materialised-view sink: stamped snapshots written to a shared folder.

The reference refreshes a materialised view by hand. Here a refresh writes
one ``as_of`` partition with dynamic partition overwrite: re-running the same
``as_of`` replaces only that snapshot, older ones stay readable, and a failed
job leaves the previous snapshot intact (the commit protocol only publishes
complete output). Writing a snapshot is also how a long lineage is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import qcol

AS_OF_COL = "as_of"


def write_snapshot(df: DataFrame, path: str, as_of: str, sort_cols: Sequence[str] = (),
                   partition_col: str = AS_OF_COL, fmt: str = "parquet") -> None:
    """Write ``df`` stamped with ``as_of`` (replacing only that partition)."""
    out = df.withColumn(partition_col, F.lit(as_of))
    if sort_cols:
        out = out.sortWithinPartitions(*[qcol(c) for c in sort_cols])
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .format(fmt)
        .save(path))


def read_snapshot(spark: SparkSession, path: str, as_of: str | None = None,
                  partition_col: str = AS_OF_COL, fmt: str = "parquet") -> DataFrame:
    """One snapshot (the latest when ``as_of`` is None); the partition filter prunes folders."""
    df = spark.read.format(fmt).load(path)
    if as_of is None:
        as_of = df.agg(F.max(partition_col)).first()[0]
    return df.filter(F.col(partition_col) == F.lit(as_of)).drop(partition_col)
