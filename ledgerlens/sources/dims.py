"""Hand-maintained dimensions: load with a declared schema, validate, upsert.

The reference keeps these as literal INSERT scripts; here a dimension is a
CSV/Parquet file with a declared schema. Loading never infers types; a
value that does not cast is reported, not silently turned into NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


SYNTAX_COLUMN = "__row_text"


def parse_rows(lines: DataFrame, schema: StructType, line_col: str = "value") -> DataFrame:
    """CSV lines as text columns named by ``schema``, and ``SYNTAX_COLUMN``.

    That column holds the line where it does not have exactly the declared
    fields (too few, too many, an open quote) and is NULL for a good row, so a
    bad row is neither padded nor cut unnoticed.
    """
    fields = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    row = F.from_csv(F.col(line_col), f"{fields}, `{SYNTAX_COLUMN}` STRING",
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": SYNTAX_COLUMN})
    return lines.select(row.alias("r")).select("r.*")


def syntax_rejects(raw: DataFrame) -> DataFrame:
    """The lines that are not rows of the declared shape."""
    return raw.filter(F.col(SYNTAX_COLUMN).isNotNull()).select(F.col(SYNTAX_COLUMN).alias("row_text"))


def load_dim(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", header: bool = True) -> DataFrame:
    """Read a dimension file as text columns named by ``schema`` (validated by ``conform``).

    CSV rows that do not have the declared fields raise no error and lose no
    text: they come with ``SYNTAX_COLUMN`` set (``syntax_rejects``). A quoted field
    may not span lines.
    """
    if fmt == "csv":
        names = F.lit(",".join(f.name for f in schema.fields))
        lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
        return parse_rows(lines.filter(F.col("value") != names) if header else lines, schema)
    text_schema = StructType([f.__class__(f.name, StringType(), True) for f in schema.fields])
    return spark.read.schema(text_schema).format(fmt).load(path)


def conform(df: DataFrame, schema: StructType, trim: bool = True) -> DataFrame:
    """Cast every column to the declared type (lenient: a bad value -> NULL), trimming text first."""
    exprs = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if trim:
            c = F.trim(c.cast("string"))
        exprs.append(c.try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, StringType)
                     else c.alias(f.name))
    return df.select(*exprs)


def cast_rejects(raw: DataFrame, schema: StructType) -> DataFrame:
    """Rows of ``raw`` (text) holding a value that does not cast to its declared type."""
    bad = None
    for f in schema.fields:
        if isinstance(f.dataType, StringType):
            continue
        c = F.trim(F.col(f"`{f.name}`").cast("string"))
        e = c.isNotNull() & (c != "") & c.try_cast(f.dataType).isNull()
        bad = e if bad is None else bad | e
    return raw.filter(bad) if bad is not None else raw.limit(0)


def duplicate_keys(df: DataFrame, key: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur on more than one row, with their row count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """New dimension = base rows whose key is not in ``updates`` ∪ all ``updates`` rows."""
    kept = base.join(updates.select(*key).distinct(), list(key), "left_anti")
    return kept.unionByName(updates.select(*base.columns))
