"""Shared pieces of the text operators: column rules, batch mapping, partition counts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.tables import read_table

_LIBC = ctypes.CDLL(None)

# The white space that separates words, [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
WHITE_BYTES = bytes(WHITE, "ascii")
# Upper to lower case of A-Z alone, as a bytes.translate table.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The named columns of the documents table (others are never read)."""
    return read_table(spark, sf_dir, "documents").select(*cols)


def whole_text(text: Column) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    """Partitions the session shuffles into: what the cluster was sized with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_ROWS, DEFAULT_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(df: DataFrame) -> None:
    """Smaller Arrow batches for long texts, unless the session was given a size of its own.

    A batch is held in the executor and twice in its worker; 10,000 documents are
    far more than a step needs at once.
    """
    spark = df.sparkSession
    if spark.conf.get(BATCH_ROWS) == DEFAULT_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, "2000")


def record(arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def slices(lengths: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose summed length stays near ``most``: bounds the memory of one numpy step.

    A single longer text forms a range of its own; it is not cut. After the last
    range, freed memory goes back to the system (``release``).
    """
    lo = total = 0
    n = -1
    for n, size in enumerate(lengths):
        if n > lo and total + size > most:
            yield lo, n
            lo, total = n, 0
        total += size
    if n >= 0:
        yield lo, n + 1
    release()


def release() -> None:
    """Give freed memory back: workers are reused, and what one stage held would count against the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def crowded(df: DataFrame, bucket: str) -> DataFrame:
    """Buckets that hold two rows or more, one row each (counted map-side first)."""
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(bucket)


def sql_literal(value) -> str:
    """A whole number, text or flat list/dict of these as a Spark SQL literal."""
    if isinstance(value, dict):
        return "map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in value.items()) + ")"
    if isinstance(value, list):
        return "array(" + ", ".join(map(sql_literal, value)) + ")"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(int(value))


def fixed_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table as literals of the plan: no Python and no RDD behind it."""
    names, kinds = zip(*[field.split() for field in schema.split(", ")])
    values = ", ".join("(" + ", ".join(map(sql_literal, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST({n} AS {k}) AS {n}" for n, k in zip(names, kinds))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")


def equi_split(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """Equi join whose left side AQE can split at a hot key, though ``right`` comes grouped by its key.

    A grouped side already has the key's partitioning, so Spark adds no exchange
    that could be split beside it. A second join column, which the key determines,
    asks for one.
    """
    tagged = right.withColumn("__tag", F.pmod(F.hash(right_key), F.lit(8191)))
    match = (left[left_key] == tagged[right_key]) & (F.pmod(F.hash(left[left_key]), F.lit(8191)) == tagged["__tag"])
    out = left.join(tagged, match, how)
    return out if how in ("left_semi", "left_anti") else out.drop("__tag")


ASK_BUCKETS = 1 << 18


def split_by_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may carry one of ``ids`` (one column), and rows that carry none of them.

    The broadcast holds id buckets, at most ``ASK_BUCKETS`` of them. An exact join
    is still due on the first part, but the second, mostly far larger, is not shuffled.
    """
    own = ids.columns[0]
    asked = F.broadcast(ids.select(F.pmod(F.xxhash64(own), F.lit(ASK_BUCKETS)).alias("__asked")).distinct())
    match = F.pmod(F.xxhash64(docs[id_col]), F.lit(ASK_BUCKETS)) == asked["__asked"]
    return docs.join(asked, match, "left_semi"), docs.join(asked, match, "left_anti")
