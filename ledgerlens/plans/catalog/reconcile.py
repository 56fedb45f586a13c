"""Reconciliation-shaped queries: full range join, interval join, outer-join rewrites,
side merge, line ids and dedupe (orders play contracts, lineitem plays billing lines)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import coalesce_sides, dedupe_keep_null, interval_join, reconcile_full, surrogate_id
from ledgerlens.plans.catalog.common import d, dtext, idtext, money, t
from ledgerlens.plans.registry import query


def contract_months(spark, sf):
    """A side: one row per order with its 30-day window."""
    o = t(spark, sf, "orders")
    return (o.select(F.col("o_orderkey").alias("a_orderkey"), d("o_orderdate").alias("a_ini"))
            .withColumn("a_fim", F.date_add("a_ini", 30)))


def billing_lines(spark, sf):
    """B side: per (order, line) ship window plus the whole order's ship window.

    The order window is aggregated from the (already reduced) line windows,
    so lineitem is scanned and shuffled once; both aggregates are partial
    (map-side) and the final join on the order key is an equi join AQE can
    split when one order owns a large share of the lines (a window function
    over the order key could not be split).
    """
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", d("l_shipdate").alias("sd"))
    lines = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("sd").alias("b_ini"), F.max("sd").alias("b_fim"))
    heads = lines.groupBy(F.col("l_orderkey").alias("h_orderkey")).agg(F.min("b_ini").alias("h_ini"),
                                                                        F.max("b_fim").alias("h_fim"))
    b = lines.join(heads, lines["l_orderkey"] == heads["h_orderkey"], "inner").drop("h_orderkey")
    return b.withColumnRenamed("l_orderkey", "b_orderkey").withColumnRenamed("l_linenumber", "b_linenumber")


def reconcile(spark, sf, strategy="split"):
    a, b = contract_months(spark, sf), billing_lines(spark, sf)
    j = reconcile_full(a, b, on=[("a_orderkey", "b_orderkey")],
                       ranges=[("a_fim", "b_ini", "b_fim"), ("a_fim", "h_ini", "h_fim"), ("a_ini", "h_ini", "h_fim")],
                       strategy=strategy)
    status = (F.when(F.col("a_orderkey").isNull(), "B_ONLY").when(F.col("b_orderkey").isNull(), "A_ONLY")
              .otherwise("MATCHED"))
    return j.select(idtext("a_orderkey").alias("a_orderkey"), idtext("b_orderkey").alias("b_orderkey"),
                    idtext("b_linenumber").alias("b_linenumber"),
                    dtext("a_ini").alias("a_ini"), dtext("a_fim").alias("a_fim"),
                    dtext("b_ini").alias("b_ini"), dtext("b_fim").alias("b_fim"),
                    dtext("h_ini").alias("h_ini"), dtext("h_fim").alias("h_fim"),
                    status.alias("match_status"))


_RECONCILE_CTE = """
WITH a AS (
  SELECT o_orderkey AS a_orderkey, CAST(o_orderdate AS DATE) AS a_ini, CAST(o_orderdate AS DATE) + 30 AS a_fim
  FROM orders),
lines AS (
  SELECT l_orderkey, l_linenumber, MIN(CAST(l_shipdate AS DATE)) AS b_ini, MAX(CAST(l_shipdate AS DATE)) AS b_fim
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
heads AS (
  SELECT l_orderkey AS h_orderkey, MIN(CAST(l_shipdate AS DATE)) AS h_ini, MAX(CAST(l_shipdate AS DATE)) AS h_fim
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT lines.l_orderkey AS b_orderkey, lines.l_linenumber AS b_linenumber, b_ini, b_fim, h_ini, h_fim
  FROM lines JOIN heads ON lines.l_orderkey = heads.h_orderkey)
"""


@query("full_range_reconcile", sql=_RECONCILE_CTE + """
SELECT CAST(a_orderkey AS VARCHAR) AS a_orderkey, CAST(b_orderkey AS VARCHAR) AS b_orderkey,
       CAST(b_linenumber AS VARCHAR) AS b_linenumber,
       strftime(a_ini, '%Y-%m-%d') AS a_ini, strftime(a_fim, '%Y-%m-%d') AS a_fim,
       strftime(b_ini, '%Y-%m-%d') AS b_ini, strftime(b_fim, '%Y-%m-%d') AS b_fim,
       strftime(h_ini, '%Y-%m-%d') AS h_ini, strftime(h_fim, '%Y-%m-%d') AS h_fim,
       CASE WHEN a_orderkey IS NULL THEN 'B_ONLY' WHEN b_orderkey IS NULL THEN 'A_ONLY' ELSE 'MATCHED' END AS match_status
FROM a FULL JOIN b
  ON a.a_orderkey = b.b_orderkey
 AND ((a_fim >= b_ini AND a_fim <= b_fim) OR (a_fim >= h_ini AND a_fim <= h_fim) OR (a_ini >= h_ini AND a_ini <= h_fim))
""")
def full_range_reconcile(spark, sf):
    return reconcile(spark, sf)


@query("interval_join", sql="""
SELECT o.o_orderkey, CAST(l.l_linenumber AS VARCHAR) AS l_linenumber, CAST(l.l_partkey AS VARCHAR) AS l_partkey,
       strftime(l.l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM orders o LEFT JOIN lineitem l
  ON l.l_orderkey = o.o_orderkey
 AND CAST(l.l_shipdate AS DATE) >= CAST(o.o_orderdate AS DATE)
 AND CAST(l.l_shipdate AS DATE) <= CAST(o.o_orderdate AS DATE) + 30
""")
def q_interval_join(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", d("o_orderdate").alias("lo")).withColumn("hi", F.date_add("lo", 30))
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", d("l_shipdate").alias("ship"))
    # every order is kept (the point lives on the line side, so the order side is the right input)
    j = interval_join(li, o, on=[("l_orderkey", "o_orderkey")], point="ship", lo="lo", hi="hi", how="right")
    return j.select("o_orderkey", idtext("l_linenumber").alias("l_linenumber"), idtext("l_partkey").alias("l_partkey"),
                    dtext("ship").alias("l_shipdate"))


@query("full_to_left", sql="""
SELECT o.o_orderkey, CAST(l.l_linenumber AS VARCHAR) AS l_linenumber
FROM orders o FULL JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderstatus = 'F'
""")
def full_to_left(spark, sf):
    # FULL JOIN followed by a null-rejecting filter on the left side is a left join.
    o = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return (o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
            .select("o_orderkey", idtext("l_linenumber").alias("l_linenumber")))


@query("left_to_inner", sql="""
SELECT c.c_custkey, o.o_orderkey
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'O'
""")
def left_to_inner(spark, sf):
    # LEFT JOIN followed by a null-rejecting filter on the right side is an inner join.
    c = t(spark, sf, "customer").select("c_custkey")
    o = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "inner").select("c_custkey", "o_orderkey")


@query("coalesce_sides", sql="""
WITH a AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice) AS total, COUNT(*) AS n
           FROM orders GROUP BY 1),
     b AS (SELECT date_trunc('month', l_shipdate)::DATE AS m, SUM(l_extendedprice) AS revenue, COUNT(*) AS n
           FROM lineitem GROUP BY 1)
SELECT strftime(COALESCE(a.m, b.m), '%Y-%m-%d') AS month,
       ROUND(COALESCE(a.total, b.revenue), 2) AS amount_a_first,
       ROUND(COALESCE(b.revenue, a.total), 2) AS amount_b_first,
       COALESCE(b.n, a.n) AS rows_b_first
FROM a FULL JOIN b ON a.m = b.m
""")
def q_coalesce_sides(spark, sf):
    o = t(spark, sf, "orders")
    li = t(spark, sf, "lineitem")
    a = o.groupBy(F.trunc(d("o_orderdate"), "MM").alias("am")).agg(F.sum("o_totalprice").alias("total"),
                                                                     F.count(F.lit(1)).alias("an"))
    b = li.groupBy(F.trunc(d("l_shipdate"), "MM").alias("bm")).agg(F.sum("l_extendedprice").alias("revenue"),
                                                                     F.count(F.lit(1)).alias("bn"))
    j = a.join(b, a["am"] == b["bm"], "full_outer")
    m = coalesce_sides(j, {"month": ("am", "bm"), "amount_a_first": ("total", "revenue"),
                           "amount_b_first": ("revenue", "total"), "rows_b_first": ("bn", "an")})
    return m.select(dtext("month").alias("month"), money("amount_a_first").alias("amount_a_first"),
                    money("amount_b_first").alias("amount_b_first"), "rows_b_first")


_LINE_TIES = ["l_shipdate", "l_extendedprice", "l_quantity"]


@query("surrogate_line_id", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR)
         || '|' || CAST(l_suppkey AS VARCHAR) || '|' ||
       CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                               ORDER BY l_shipdate, l_extendedprice, l_quantity) AS VARCHAR) AS line_id
FROM lineitem
""")
def surrogate_line_id(spark, sf):
    li = t(spark, sf, "lineitem")
    out = surrogate_id(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], _LINE_TIES, name="line_id")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line_id")


@query("dedupe_keep_null", sql="""
WITH k AS (
  SELECT *, CASE WHEN NULLIF(l_returnflag, 'N') IS NULL THEN NULL
                 ELSE CAST(l_orderkey AS VARCHAR) || '-' || l_returnflag END AS dedupe_key
  FROM lineitem),
r AS (
  SELECT *, row_number() OVER (PARTITION BY dedupe_key
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS rn
  FROM k WHERE dedupe_key IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, dedupe_key FROM r WHERE rn = 1
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, dedupe_key FROM k WHERE dedupe_key IS NULL
""")
def q_dedupe_keep_null(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                                         *_LINE_TIES)
    key = F.when(F.nullif(F.col("l_returnflag"), F.lit("N")).isNull(), F.lit(None).cast("string")) \
        .otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_returnflag")))
    k = li.withColumn("dedupe_key", key)
    order = [F.col(c).asc() for c in ["l_linenumber", "l_partkey", "l_suppkey", *_LINE_TIES]]
    return dedupe_keep_null(k, "dedupe_key", order, stored=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "dedupe_key")

