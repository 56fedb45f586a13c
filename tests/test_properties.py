"""Property tests (hypothesis) for the operators whose contracts are easy to state."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.operators import dedupe_keep_null, interval_join, reconcile_full
from tests.conftest import rows

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
small_int = st.integers(min_value=0, max_value=6)
maybe = lambda s: st.one_of(st.none(), s)


@settings(**SETTINGS)
@given(st.lists(st.tuples(maybe(small_int), maybe(small_int)), max_size=12),
       st.lists(st.tuples(maybe(small_int), maybe(small_int), maybe(small_int)), max_size=12))
def test_reconcile_full_single_equals_split_and_keeps_every_row(spark, left, right):
    a = spark.createDataFrame(left, "ak int, ap int")
    b = spark.createDataFrame(right, "bk int, lo int, hi int")
    cols = ["ak", "ap", "bk", "lo", "hi"]
    single = rows(reconcile_full(a, b, [("ak", "bk")], [("ap", "lo", "hi")], strategy="single"), cols)
    split = rows(reconcile_full(a, b, [("ak", "bk")], [("ap", "lo", "hi")], strategy="split"), cols)
    assert single == split
    # brute force: every pair that matches, plus every row of either side without a partner
    def match(x, y):
        return x[0] is not None and x[0] == y[0] and None not in (x[1], y[1], y[2]) and y[1] <= x[1] <= y[2]
    pairs = [x + y for x in left for y in right if match(x, y)]
    lonly = [x + (None, None, None) for x in left if not any(match(x, y) for y in right)]
    ronly = [(None, None) + y for y in right if not any(match(x, y) for x in left)]
    key = lambda t: tuple((False, 0) if v is None else (True, v) for v in t)
    assert single == sorted(pairs + lonly + ronly, key=key)


@settings(**SETTINGS)
@given(st.lists(st.tuples(maybe(st.integers(0, 3)), st.integers(0, 50)), max_size=20))
def test_dedupe_keep_null_contract(spark, data):
    df = spark.createDataFrame(data, "k int, o int")
    out = rows(dedupe_keep_null(df, "k", [F.col("o").asc()]), ["k", "o"])
    keys = [k for k, _ in out if k is not None]
    assert len(keys) == len(set(keys))  # one row per non-null key
    assert sorted(o for k, o in out if k is None) == sorted(o for k, o in data if k is None)  # all NULL rows kept
    for k in set(keys):
        assert dict((kk, o) for kk, o in out if kk is not None)[k] == min(o for kk, o in data if kk == k)


@settings(**SETTINGS)
@given(st.lists(st.tuples(small_int, maybe(st.integers(0, 60))), max_size=10),
       st.lists(st.tuples(small_int, maybe(st.integers(0, 60)), maybe(st.integers(0, 60))), max_size=10))
def test_interval_join_is_exact(spark, left, right):
    base = dt.date(2024, 1, 1)
    d = lambda n: None if n is None else base + dt.timedelta(days=n)
    a = spark.createDataFrame([(k, d(p)) for k, p in left], "lk int, p date")
    b = spark.createDataFrame([(k, d(lo), d(hi)) for k, lo, hi in right], "rk int, lo date, hi date")
    got = rows(interval_join(a, b, [("lk", "rk")], "p", "lo", "hi", how="left"), ["lk", "p", "rk", "lo", "hi"])
    want = []
    for k, p in left:
        hits = [(k, d(p), *r) for r in ((x, d(lo), d(hi)) for x, lo, hi in right
                                        if x == k and None not in (p, lo, hi) and lo <= p <= hi)]
        want += hits or [(k, d(p), None, None, None)]
    key = lambda t: tuple((False, 0) if v is None else (True, v) for v in t)
    assert got == sorted(want, key=key)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["Máquina", "Seguro", "Fretes", "Avarias", "Outros", None]),
                          st.sampled_from(["BM PENDENTE", "FATURADO", None]),
                          st.sampled_from(["Sim", "Não"]),
                          *[maybe(st.integers(-50, 50)) for _ in range(5)], st.integers(1, 31)), min_size=1, max_size=8))
def test_final_price_is_sum_of_components_unless_blocked(spark, data):
    df = spark.createDataFrame(data, "t string, s string, bloq string, p int, ins int, fr int, dmg int, disc int, days int")
    comps = [rules.rental_amount("t", "s", F.lit("Proporcional Mobilização"), "p", "days").alias("loc"),
             rules.insurance_amount("t", "s", F.lit("Integral"), "p", "ins", "days").alias("seg"),
             rules.freight_amount("t", "p", "fr").alias("fre"), rules.damage_amount("t", "p", "dmg").alias("ava"),
             rules.discount_amount("p", "fr", "ins", "disc").alias("des")]
    out = df.select("bloq", *comps).select("*", rules.final_price("bloq", "loc", "seg", "fre", "ava", "des").alias("fin"))
    for r in out.collect():
        parts = sum((r[c] or 0.0) for c in ("loc", "seg", "fre", "ava", "des"))
        assert r.fin == (0.0 if r.bloq == "Sim" else parts)
