"""Synthetic ERP-shaped fixture rows (all values invented)."""

from pyspark.sql.types import StructType

from ledgerlens.sources.schemas import ERP_SCHEMAS


def mk(spark, name, rows):
    """DataFrame of table ``name`` from dict rows; missing columns are NULL."""
    schema = StructType.fromDDL(ERP_SCHEMAS[name])
    cols = [f.name for f in schema.fields]
    data = []
    for r in rows:
        unknown = set(r) - set(cols)
        assert not unknown, f"{name}: unknown columns {unknown}"
        data.append(tuple(r.get(c) for c in cols))
    return spark.createDataFrame(data, schema)
