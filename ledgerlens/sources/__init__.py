"""Inputs and outputs: table reads, schemas, ingest, dimensions, snapshots."""

from ledgerlens.sources.dims import (cast_rejects, conform, duplicate_keys, load_dim, parse_rows, syntax_rejects,
                                     upsert)
from ledgerlens.sources.ingest import date_rejects
from ledgerlens.sources.schemas import DATE_TEXT_COLUMNS, ERP_SCHEMAS, TRIMMED_KEYS
from ledgerlens.sources.snapshot import read_snapshot, write_snapshot
from ledgerlens.sources.tables import Tables, read_table, read_tables

__all__ = [
    "load_dim", "parse_rows", "syntax_rejects", "conform", "cast_rejects", "duplicate_keys", "upsert",
    "date_rejects", "ERP_SCHEMAS", "DATE_TEXT_COLUMNS", "TRIMMED_KEYS",
    "write_snapshot", "read_snapshot", "Tables", "read_table", "read_tables",
]
