"""Aggregation and top-1 queries: grouped sums, conditional pivots, min/max
periods, wide groups, distinct rows, latest row per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import desc_nulls_first, latest_per_key, max_or_zero, pivot_by_key, sum_of_sums
from ledgerlens.plans.catalog.common import AS_OF, d, dtext, money, t
from ledgerlens.plans.registry import query


def _code():
    return F.concat(F.col("l_returnflag"), F.col("l_linestatus"))


@query("group_sum", sql="SELECT l_orderkey, ROUND(SUM(l_quantity), 2) AS sum_qty FROM lineitem GROUP BY l_orderkey")
def group_sum(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_orderkey").agg(money(F.sum("l_quantity")).alias("sum_qty"))


_SUM_CODES = [("price_af", "AF"), ("price_nf", "NF"), ("price_no", "NO"), ("price_rf", "RF")]


@query("pivot_sum", sql="""
SELECT l_orderkey,
       ROUND(SUM(CASE WHEN l_returnflag || l_linestatus = 'AF' THEN l_extendedprice END), 2) AS price_af,
       ROUND(SUM(CASE WHEN l_returnflag || l_linestatus = 'NF' THEN l_extendedprice END), 2) AS price_nf,
       ROUND(SUM(CASE WHEN l_returnflag || l_linestatus = 'NO' THEN l_extendedprice END), 2) AS price_no,
       ROUND(SUM(CASE WHEN l_returnflag || l_linestatus = 'RF' THEN l_extendedprice END), 2) AS price_rf
FROM lineitem WHERE l_returnflag || l_linestatus IN ('AF', 'NF', 'NO', 'RF')
GROUP BY l_orderkey
""")
def pivot_sum(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("code", _code())
    p = pivot_by_key(li, ["l_orderkey"], "code", _SUM_CODES, agg="sum", value_col="l_extendedprice")
    return p.select("l_orderkey", *[money(o).alias(o) for o, _ in _SUM_CODES])


_MAX_MEASURES = [("qty_af", "AF", "l_quantity"), ("price_af", "AF", "l_extendedprice"),
                 ("qty_rf", "RF", "l_quantity"), ("price_rf", "RF", "l_extendedprice"),
                 ("qty_no", "NO", "l_quantity"), ("price_no", "NO", "l_extendedprice")]


@query("pivot_max", sql="""
SELECT l_orderkey,
       MAX(CASE WHEN l_returnflag || l_linestatus = 'AF' THEN l_quantity END) AS qty_af,
       ROUND(MAX(CASE WHEN l_returnflag || l_linestatus = 'AF' THEN l_extendedprice END), 2) AS price_af,
       MAX(CASE WHEN l_returnflag || l_linestatus = 'RF' THEN l_quantity END) AS qty_rf,
       ROUND(MAX(CASE WHEN l_returnflag || l_linestatus = 'RF' THEN l_extendedprice END), 2) AS price_rf,
       MAX(CASE WHEN l_returnflag || l_linestatus = 'NO' THEN l_quantity END) AS qty_no,
       ROUND(MAX(CASE WHEN l_returnflag || l_linestatus = 'NO' THEN l_extendedprice END), 2) AS price_no
FROM lineitem GROUP BY l_orderkey
""")
def pivot_max(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("code", _code())
    p = pivot_by_key(li, ["l_orderkey"], "code", _MAX_MEASURES, agg="max", codes_only=False)
    return p.select("l_orderkey", *[money(o).alias(o) if o.startswith("price") else F.col(o)
                                    for o, _, _ in _MAX_MEASURES])


@query("agg_coalesce", sql="""
SELECT l_orderkey, COALESCE(MAX(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS max_returned_qty
FROM lineitem GROUP BY l_orderkey
""")
def agg_coalesce(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("rq", F.when(F.col("l_returnflag") == "R", F.col("l_quantity")))
    return li.groupBy("l_orderkey").agg(max_or_zero("rq").alias("max_returned_qty"))


@query("residual_value", sql=f"""
SELECT l_orderkey,
       ROUND(SUM(CASE WHEN l_returnflag || l_linestatus = 'AF' THEN l_extendedprice END)
           + SUM(CASE WHEN l_returnflag || l_linestatus = 'NF' THEN l_extendedprice END)
           + SUM(CASE WHEN l_returnflag || l_linestatus = 'RF' THEN l_extendedprice END)
           + SUM(CASE WHEN l_returnflag || l_linestatus = 'NO' THEN l_extendedprice END), 2) AS saldo_residual
FROM lineitem
WHERE strftime(l_shipdate, '%Y') = strftime(DATE '{AS_OF}', '%Y')
GROUP BY l_orderkey
""")
def residual_value(spark, sf):
    year = F.trunc(F.lit(AS_OF).cast("date"), "YEAR")
    shipped = F.col("l_shipdate")  # compared as it is stored, so the range reaches the scan
    li = t(spark, sf, "lineitem").filter((shipped >= year.cast("timestamp"))
                                         & (shipped < F.add_months(year, 12).cast("timestamp")))
    code = _code()
    terms = {c.lower(): F.when(code == c, F.col("l_extendedprice")) for c in ("AF", "NF", "RF", "NO")}
    li = li.select("l_orderkey", *[v.alias(k) for k, v in terms.items()])
    out = sum_of_sums(li, ["l_orderkey"], list(terms), "saldo_residual")
    return out.select("l_orderkey", money("saldo_residual").alias("saldo_residual"))


@query("period_minmax", sql="""
SELECT o_custkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS competencia,
       strftime(MIN(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS ini,
       strftime(MAX(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS fim,
       MIN(strftime(o_orderdate, '%Y-%m-%d')) AS ini_text
FROM orders GROUP BY o_custkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')
""")
def period_minmax(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", d("o_orderdate").alias("od"))
    # ISO text sorts as its date does: min and max run on dates (a hash aggregate, text would need a sort), text comes after
    g = o.groupBy("o_custkey", F.trunc("od", "MM").alias("competencia")).agg(F.min("od").alias("ini"), F.max("od").alias("fim"))
    return g.select("o_custkey", dtext("competencia").alias("competencia"), dtext("ini").alias("ini"), dtext("fim").alias("fim"),
                    dtext("ini").alias("ini_text"))


@query("wide_group", sql="""
SELECT o.o_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, o.o_orderstatus, o.o_orderpriority,
       strftime(MIN(CAST(o.o_orderdate AS DATE)), '%Y-%m-%d') AS first_order,
       strftime(MAX(CAST(o.o_orderdate AS DATE)), '%Y-%m-%d') AS last_order,
       ROUND(COALESCE(MAX(o.o_totalprice), 0), 2) AS max_total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY o.o_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, o.o_orderstatus, o.o_orderpriority
""")
def wide_group(spark, sf):
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    keys = ["o_custkey", "c_name", "c_mktsegment", "c_nationkey", "o_orderstatus", "o_orderpriority"]
    g = j.groupBy(*keys).agg(F.min(d("o_orderdate")).alias("fo"), F.max(d("o_orderdate")).alias("lo"),
                             money(max_or_zero("o_totalprice")).alias("max_total"))
    return g.select(*keys, dtext("fo").alias("first_order"), dtext("lo").alias("last_order"), "max_total")


@query("distinct_rows", sql="SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("latest_change", sql="""
WITH ch AS (
  SELECT LEFT(lpad(CAST(user_id AS VARCHAR), 10, '0') || 'X', 10) AS id, event_type AS usuario,
         strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S') AS stamp, event_id
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY stamp DESC, event_id DESC) AS rn FROM ch)
SELECT c.c_custkey, r.usuario, r.stamp AS ultima_modificacao
FROM customer c LEFT JOIN r ON lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') = r.id AND r.rn = 1
""")
def latest_change(spark, sf):
    ev = t(spark, sf, "events")
    # change-log object id: a 10-char key followed by a suffix; the key is derived, then joined
    ch = ev.select(F.left(F.concat(F.lpad(F.col("user_id").cast("string"), 10, "0"), F.lit("X")), F.lit(10)).alias("id"),
                   F.col("event_type").alias("usuario"),
                   F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")).alias("stamp"),
                   "event_id")
    last = latest_per_key(ch, ["id"], [F.col("stamp").desc(), F.col("event_id").desc()])
    c = t(spark, sf, "customer").select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("ck"))
    j = c.join(last, c["ck"] == last["id"], "left")
    return j.select("c_custkey", "usuario", F.col("stamp").alias("ultima_modificacao"))


@query("latest_status", sql="""
SELECT user_id, event_id, event_type, ROUND(value, 2) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY NULLIF(event_type, 'view') DESC NULLS FIRST, ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def latest_status(spark, sf):
    ev = t(spark, sf, "events").withColumn("st", F.nullif(F.col("event_type"), F.lit("view")))
    order = [desc_nulls_first("st"), F.col("ts").desc(), F.col("event_id").desc()]
    last = latest_per_key(ev, ["user_id"], order)
    return last.select("user_id", "event_id", "event_type", money("value").alias("value"))


_PRICE_MEASURES = [("click_max", "click", "value"), ("view_max", "view", "value")]


@query("latest_price", sql="""
WITH sel AS (
  SELECT user_id, event_id, event_type, value,
         CASE WHEN value < 5 THEN 'X' WHEN value > 95 THEN NULL ELSE '' END AS inactive
  FROM events WHERE event_type IN ('click', 'view', 'purchase')),
pmr AS (
  SELECT user_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
    FROM sel WHERE event_type = 'purchase' AND inactive <> 'X') WHERE rn = 1)
SELECT sel.user_id,
       ROUND(MAX(CASE WHEN sel.event_type = 'click' THEN sel.value END), 2) AS click_max,
       ROUND(MAX(CASE WHEN sel.event_type = 'view' THEN sel.value END), 2) AS view_max,
       ROUND(MAX(pmr.value), 2) AS preco
FROM sel LEFT JOIN pmr ON sel.user_id = pmr.user_id
GROUP BY sel.user_id
""")
def latest_price(spark, sf):
    v = F.col("value")
    sel = (t(spark, sf, "events").filter(F.col("event_type").isin("click", "view", "purchase"))
           .select("user_id", "event_id", "event_type", "value",
                   F.when(v < 5, F.lit("X")).when(v > 95, F.lit(None).cast("string")).otherwise(F.lit(""))
                   .alias("inactive")))
    # ``inactive <> 'X'`` also drops rows whose flag is NULL (three-valued logic)
    active = sel.filter((F.col("event_type") == "purchase") & (F.col("inactive") != "X"))
    pmr = latest_per_key(active, ["user_id"], [F.col("event_id").desc()]).select(
        F.col("user_id").alias("p_user"), F.col("value").alias("p_value"))
    piv = pivot_by_key(sel, ["user_id"], "event_type", _PRICE_MEASURES, agg="max", codes_only=False)
    # the latest price is one row per key: joining after the pivot equals MAX over the joined rows
    j = piv.join(pmr, piv["user_id"] == pmr["p_user"], "left")
    return j.select("user_id", money("click_max").alias("click_max"), money("view_max").alias("view_max"),
                    money("p_value").alias("preco"))
