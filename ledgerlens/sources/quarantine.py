"""Ingest with a quarantine: texts are parsed once, rows with a bad one are kept apart.

One write per run: rows go to ``<path>/run=<run>/quarantined=false`` or ``=true``,
with the parsed columns and, for rejects, what did not parse. Readers prune to one
side by the partition column. The counts of the run come with the write
(``DataFrame.observe``), no second pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.codes import DATE_SENTINEL
from ledgerlens.functions.dates import parse_iso_date
from ledgerlens.functions.text import qcol

REJECTS = "__rejects"
_TEXT, _VALUE = "__text", "__value"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


class IngestCounts(NamedTuple):
    rows: int
    quarantined: int
    by_column: dict[str, int]


def _parsed(text: Column, kind: str) -> Column:
    return parse_iso_date(text) if kind == "date" else text.try_cast(kind)


def parse_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``df`` with each column of ``kinds`` parsed to its type and ``REJECTS``: the columns and texts that did not parse.

    NULL, blank and the date sentinel parse to NULL and are no rejects. A text is
    trimmed in one step, parsed in the next and judged in the last: none is parsed twice.
    """
    texts, parsed, rejects, failed = {}, {}, [], []
    for i, (name, kind) in enumerate(kinds.items()):
        text, value = F.col(f"{_TEXT}{i}"), F.col(f"{_VALUE}{i}")
        trimmed = F.trim(qcol(name).cast("string"))
        blanks = ["", DATE_SENTINEL] if kind == "date" else [""]
        texts[f"{_TEXT}{i}"] = F.when(~trimmed.isin(blanks), trimmed)
        parsed[f"{_VALUE}{i}"] = _parsed(text, kind)
        failed.append(text.isNotNull() & value.isNull())
        rejects.append(F.when(failed[-1], F.struct(F.lit(name).alias("column"), text.alias("text"))))
    none = F.array().cast("array<struct<column: string, text: string>>")
    at = {name: i for i, name in enumerate(kinds)}
    return df.withColumns(texts).withColumns(parsed).select(
        *[F.col(f"{_VALUE}{at[c]}").alias(c) if c in at else qcol(c) for c in df.columns],
        F.when(reduce(lambda a, b: a | b, failed, F.lit(False)), F.array_compact(F.array(*rejects))).otherwise(none).alias(REJECTS))


def ingest(df: DataFrame, kinds: Mapping[str, str], path: str, run: str) -> IngestCounts:
    """Write a run of ``df``; a rerun of the same run replaces it alone. Returns the run's counts.

    A task keeps a file open for each side: rows are not sorted by the side before they are written.
    """
    seen = Observation("ingest")
    bad = F.size(REJECTS) > 0
    counts = [F.sum(F.when(bad & F.array_contains(F.col(REJECTS)["column"], name), 1).otherwise(0)).alias(f"bad_{i}")
              for i, name in enumerate(kinds)]
    out = parse_columns(df, kinds).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(F.when(bad, 1).otherwise(0)).alias("bad"), *counts)
    conf = df.sparkSession.conf
    before = conf.get(_OPEN_FILES)
    conf.set(_OPEN_FILES, max(int(before), 2))
    try:
        (out.withColumn("run", F.lit(run)).withColumn("quarantined", bad).write.partitionBy("run", "quarantined")
         .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))
    finally:
        conf.set(_OPEN_FILES, before)
    got = seen.get
    return IngestCounts(got["rows"], got["bad"] or 0, {name: got[f"bad_{i}"] or 0 for i, name in enumerate(kinds)})


def clean_rows(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The run's rows that parsed whole."""
    return spark.read.parquet(path).filter((F.col("run") == run) & ~F.col("quarantined")).drop("run", "quarantined", REJECTS)


def quarantined_rows(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The run's rejects: one row per text that did not parse, with ``column`` and ``text``."""
    bad = spark.read.parquet(path).filter((F.col("run") == run) & F.col("quarantined")).drop("run", "quarantined")
    return bad.withColumn("__r", F.explode(REJECTS)).select(
        *[qcol(c) for c in bad.columns if c != REJECTS], F.col("__r.column").alias("column"), F.col("__r.text").alias("text"))
