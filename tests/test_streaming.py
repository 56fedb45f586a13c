"""Streaming receipts equal the batch receipts over the same files."""

import tempfile
from decimal import Decimal as D

from ledgerlens.plans.receipts import receipts
from ledgerlens.sources.snapshot import read_snapshot
from ledgerlens.streaming import receipts_stream, refresh_on_arrival
from tests.conftest import rows
from tests.fixtures import mk


def _bseg(spark, n0):
    return mk(spark, "bseg", [dict(kunnr="C1", belnr=f"B{n0 + i}", h_blart="DZ", shkzg="H", xragl="",
                                   nebtr=D(i + 1), augdt="2024-01-05") for i in range(5)]
              + [dict(kunnr="C1", belnr=f"X{n0}", h_blart="DZ", shkzg="S", xragl="", nebtr=D(1))])


def test_receipts_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-")
    src, sink, ck = f"{base}/bseg", f"{base}/out", f"{base}/ck"
    kna1 = mk(spark, "kna1", [dict(kunnr="C1", stcd1="S", stcd2="P", name1="Ana")])
    _bseg(spark, 0).write.parquet(f"{src}/part0")
    _bseg(spark, 100).write.parquet(f"{src}/part1")
    q = receipts_stream(spark, f"{src}/*", kna1, sink, checkpoint_location=ck)
    q.awaitTermination()
    got = spark.read.parquet(sink)
    want = receipts(spark.read.parquet(f"{src}/*"), kna1)
    assert got.count() == 10
    assert rows(got, ["lancamento_contabil", "valor_pago"]) == rows(want, ["lancamento_contabil", "valor_pago"])
    # a second run over the same files adds nothing (checkpointed progress)
    receipts_stream(spark, f"{src}/*", kna1, sink, checkpoint_location=ck).awaitTermination()
    assert spark.read.parquet(sink).count() == 10


def test_refresh_on_arrival_writes_snapshot(spark):
    base = tempfile.mkdtemp(prefix="ll-refresh-")
    _bseg(spark, 0).write.parquet(f"{base}/in/a")
    kna1 = mk(spark, "kna1", [dict(kunnr="C1", stcd1="S", stcd2="P", name1="Ana")])
    q = refresh_on_arrival(spark, f"{base}/in/*", __import__("ledgerlens.sources.schemas", fromlist=["x"]).ERP_SCHEMAS["bseg"],
                           lambda: receipts(spark.read.parquet(f"{base}/in/*"), kna1), f"{base}/snap",
                           lambda: "2024-01-31", "receipts_refresh", checkpoint_location=f"{base}/ck")
    q.awaitTermination()
    assert read_snapshot(spark, f"{base}/snap").count() == 5
