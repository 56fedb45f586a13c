"""Structured Streaming wrappers around the batch view builders."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans.receipts import receipts
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources.schemas import ERP_SCHEMAS
from ledgerlens.sources.snapshot import write_snapshot


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or os.path.join(checkpoint_dir(spark), "streams", name)


def receipts_stream(spark: SparkSession, bseg_dir: str, kna1: DataFrame, sink_dir: str,
                    checkpoint_location: str | None = None, available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append receipt rows for accounting-line files landing in ``bseg_dir``.

    The same ``receipts`` builder as the batch view: filters run per
    micro-batch and the customer lookup is a stream-static left join, so no
    state is kept. Progress lives in the checkpoint (shared folder), so a
    restarted or failed query resumes without duplicates in the file sink.
    """
    reader = spark.readStream.schema(ERP_SCHEMAS["bseg"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = receipts(reader.parquet(bseg_dir), kna1)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", _checkpoint(spark, "receipts", checkpoint_location))
              .option("path", sink_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def refresh_on_arrival(spark: SparkSession, watch_dir: str, watch_schema: str, build: Callable[[], DataFrame],
                       snapshot_dir: str, as_of: Callable[[], str], name: str,
                       checkpoint_location: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Rewrite the ``as_of`` snapshot of ``build()`` each time files arrive in ``watch_dir``.

    ``build`` reads the current tables (batch), so each refresh is a full,
    consistent recomputation — the materialised-view refresh, triggered by
    data arrival instead of by hand. The overwrite is per ``as_of`` partition.
    """
    def refresh(batch: DataFrame, _epoch: int) -> None:
        if batch.isEmpty():
            return
        write_snapshot(build(), snapshot_dir, as_of())

    stream = spark.readStream.schema(watch_schema).parquet(watch_dir)
    writer = (stream.writeStream.foreachBatch(refresh)
              .option("checkpointLocation", _checkpoint(spark, name, checkpoint_location)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
