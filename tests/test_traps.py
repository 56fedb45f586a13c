"""One small test per semantic trap (T1-T17) of the reporting SQL."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.functions.dates import inclusive_days, parse_date, parse_date_sentinel, shift_hours
from ledgerlens.functions.text import code_map, first_nonblank, join_words, party_name, tax_id_pick
from ledgerlens.operators import desc_nulls_first, latest_per_key, surrogate_id
from ledgerlens.sources.ingest import date_rejects
from tests.conftest import rows


def one(spark, exprs, data, schema):
    return spark.createDataFrame(data, schema).select(*exprs).collect()


def test_t1_concat_skips_null(spark):
    r = one(spark, [join_words("a", "b", "c").alias("x")], [("A", None, "C"), (None, None, None)],
            "a string, b string, c string")
    assert [x.x for x in r] == ["A  C", "  "]


def test_t2_desc_puts_null_first(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "2", 2)], "k string, d string, i int")
    assert rows(latest_per_key(df, ["k"], [desc_nulls_first("d")]), ["i"]) == [(1,)]


def test_t3_three_tax_id_variants(spark):
    data = [("", "P"), (None, "P"), ("C", "")]
    exprs = [tax_id_pick("c", "p", v).alias(v) for v in ("blank_or_null", "blank_only", "nonblank")]
    r = one(spark, exprs, data, "c string, p string")
    assert [tuple(x) for x in r] == [("P", "P", "P"), ("P", None, "P"), ("C", "C", "C")]


def test_t4_t6_line_id_repeatable(spark):
    df = spark.createDataFrame([("F", "1", 2.0), ("F", "1", 1.0)], "f string, i string, v double")
    a = rows(surrogate_id(df, ["f", "i"], ["v"]), ["line_id", "v"])
    assert a == [("F|1|1", 1.0), ("F|1|2", 2.0)]


def test_t5_bad_dates_become_null_and_are_counted(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2024-02-30",), ("0000-00-00",), ("",), (None,), ("x",)], "d string")
    parsed = [r.p for r in df.select(parse_date_sentinel("d").alias("p")).collect()]
    assert parsed == [dt.date(2024, 1, 31), None, None, None, None, None]
    assert rows(date_rejects(df, ["d"]), ["column", "rejected_rows"]) == [("d", 2)]


def test_t7_proration_is_double(spark):
    r = one(spark, [rules.rental_amount("t", "s", "m", "p", "d").alias("x")],
            [("Máquina", "BM PENDENTE", "Proporcional Mobilização", __import__("decimal").Decimal("1.00"), 7)],
            "t string, s string, m string, p decimal(18,2), d int")
    assert abs(r[0].x - 7 / 30) < 1e-12


def test_t8_fanout_kept(spark):
    from ledgerlens.operators import lookup_join
    f = spark.createDataFrame([("k",)], "c string")
    dim = spark.createDataFrame([("k", "a"), ("k", "b")], "c string, v string")
    assert len(lookup_join(f, dim, on=[("c", "c")], select={"v": "v"}).collect()) == 2


def test_t9_shadowed_inputs(spark):
    # discount reads the *input* freight/insurance even though both are redefined alongside it
    df = spark.createDataFrame([(10.0, -5.0, 3.0, -1.0)], "p double, f double, i double, d double")
    out = df.select(rules.freight_amount(F.lit("x"), "p", "f").alias("f"),
                    rules.discount_amount("p", "f", "i", "d").alias("d")).collect()[0]
    assert (out.f, out.d) == (0.0, -6.0)


def test_t10_not_in_and_ne_drop_null(spark):
    df = spark.createDataFrame([("X",), ("",), (None,)], "f string")
    assert df.filter(F.col("f") != "X").count() == 1
    r = [x.s for x in df.select(rules.device_status("f").alias("s")).collect()]
    assert r == ["Devolvido", "Em Uso", "Não Encontrado"]


def test_t11_amount_vs_rate_kept_apart(spark):
    from ledgerlens.plans.billing_reconciliation import condition_prices
    from tests.fixtures import mk
    from decimal import Decimal as D
    pe = mk(spark, "prcd_elements", [dict(knumv="K", kposn="1", kschl="ZEXQ", kwert=D(9), kbetr=D(3))])
    r = condition_prices(pe).collect()[0]
    assert (r.qnt_h_exc, r.total_h_exc) == (D(3), D(9))


def test_t12_t15_month_and_hour_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1, 1, 30),)], "ts timestamp_ntz")
    r = df.select(shift_hours("ts", 3).alias("x"), F.trunc(F.col("ts").cast("date"), "MM").alias("m")).collect()[0]
    assert r.x == dt.datetime(2024, 2, 29, 22, 30) and r.m == dt.date(2024, 3, 1)


def test_t13_explicit_parentheses(spark):
    from ledgerlens.functions.dates import in_exception_windows
    df = spark.createDataFrame([(1, dt.date(2023, 5, 1)), (2, dt.date(2023, 5, 1)), (2, dt.date(2024, 2, 1))],
                               "k int, d date")
    cond = in_exception_windows("d", "k", [(1, "2023-05-01", "2023-05-31")], "2024-01-01")
    assert rows(df.filter(cond), ["k"]) == [(1,), (2,)]


def test_t14_blank_chain_is_not_coalesce(spark):
    r = one(spark, [first_nonblank("a", "b", "c").alias("x")], [("", None, "c"), ("a", "b", "c"), (None, "", None)],
            "a string, b string, c string")
    assert [x.x for x in r] == ["c", "a", None]


def test_t16_inclusive_days_and_nulls(spark):
    r = one(spark, [inclusive_days("a", "b").alias("x")], [(dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (None, None)],
            "a date, b date")
    assert [x.x for x in r] == [31, 0]


def test_party_name_falls_back_on_blank_org(spark):
    r = one(spark, [party_name("o1", "o2", "f", "l").alias("x")], [(None, None, "Ana", "Lima"), ("Acme", None, "x", "y")],
            "o1 string, o2 string, f string, l string")
    assert [x.x for x in r] == ["Ana Lima", "Acme "]


def test_code_map_null_goes_to_default(spark):
    r = one(spark, [code_map("c", [("1", "um")], "outro").alias("x")], [("1",), (None,), ("2",)], "c string")
    assert [x.x for x in r] == ["um", "outro", "outro"]


def test_parse_date_lenient(spark):
    r = one(spark, [parse_date("d").alias("x")], [("2024-13-01",), ("2024-01-02",)], "d string")
    assert [x.x for x in r] == [None, dt.date(2024, 1, 2)]


def test_t17_return_without_item_filter_is_distinct(spark):
    from ledgerlens.plans.billing_reconciliation import returns
    from tests.fixtures import mk
    vbak = mk(spark, "vbak", [dict(vbeln="H1", vbtyp="H", vgbel="F1", erdat="2024-05-02")])
    vbrp = mk(spark, "vbrp", [dict(vbeln="G1", posnr="10", aubel="H1", fkdat_ana="2024-05-03"),
                              dict(vbeln="G1", posnr="20", aubel="H1", fkdat_ana="2024-05-03")])
    vbrk = mk(spark, "vbrk", [dict(vbeln="G1", fkart="ZDEV", fksto="")])
    bseg = mk(spark, "bseg", [dict(vbeln="G1", belnr="D1", vorgn="SD00", buzei="001"),
                              dict(vbeln="G1", belnr="D1", vorgn="SD00", buzei="002")])
    out = returns(vbak, vbrp, vbrk, bseg).collect()
    assert len(out) == 1 and out[0]["Mes Contabil Dev."] == dt.date(2024, 5, 1)
