"""ledgerlens — contract-to-cash analytics as composable Spark DataFrame functions.

Layout:
  sources/    reading, schema conforming, ingest normalisation, manual
              dimensions, snapshot (materialised view) sink
  functions/  Column-level helpers: null-safe text, dates, code maps,
              business rules (pure expressions, no Python UDF)
  operators/  DataFrame -> DataFrame operators: pivot, latest-per-key,
              dedupe, lookups, interval / full range joins, side merge
  plans/      the reporting views built from the operators, plus the
              driver query catalogue and its SQL oracles
  streaming/  incremental refresh of a snapshot with Structured Streaming
"""

from ledgerlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
