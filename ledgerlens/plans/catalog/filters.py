"""Filter and predicate queries (3-valued logic kept as the SQL has it)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.functions.dates import in_exception_windows, months_ahead_start
from ledgerlens.functions.text import is_blank, prefix_not_in, regex_classify
from ledgerlens.plans.catalog.common import AS_OF, d, dtext, idtext, t
from ledgerlens.plans.registry import query


@query("scan_prune", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')
""")
def scan_prune(spark, sf):
    # Only four columns reach the Parquet reader; the IN list is a pushed filter.
    return (t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
            .filter(F.col("l_returnflag").isin("A", "R")))


@query("filter_eq", sql="SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, sf):
    return t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey",
                                                                                "o_orderstatus")


@query("filter_in", sql="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def filter_in(spark, sf):
    return (t(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", "o_orderpriority"))


@query("filter_not_in", sql="""
SELECT o_orderkey, o_orderstatus FROM orders WHERE NULLIF(o_orderstatus, 'P') NOT IN ('F')
""")
def filter_not_in(spark, sf):
    # NOT IN over a NULL value is unknown, so rows made NULL are dropped too.
    return (t(spark, sf, "orders").filter(~F.nullif(F.col("o_orderstatus"), F.lit("P")).isin("F"))
            .select("o_orderkey", "o_orderstatus"))


@query("filter_empty_string", sql="""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE (CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END) = ''
""")
def filter_empty_string(spark, sf):
    s = F.col("o_orderstatus")
    x = F.when(s == "O", F.lit("")).when(s == "P", F.lit(None).cast("string")).otherwise(s)
    return t(spark, sf, "orders").filter(x == "").select("o_orderkey", "o_orderstatus")


@query("filter_ne_null", sql="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') <> '1-URGENT'
""")
def filter_ne_null(spark, sf):
    return (t(spark, sf, "orders").filter(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")) != "1-URGENT")
            .select("o_orderkey", "o_orderpriority"))


@query("null_tests", sql="""
WITH dev AS (SELECT l_orderkey, MAX(l_linenumber) AS doc_dev FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'B' END AS recusa,
         CASE WHEN o.o_orderstatus = 'P' THEN 'X' END AS bloqueio,
         dev.doc_dev
  FROM orders o LEFT JOIN dev ON o.o_orderkey = dev.l_orderkey)
SELECT o_orderkey,
       CASE WHEN recusa IS NULL AND bloqueio IS NULL THEN 'Não' ELSE 'Sim' END AS bloq_geral,
       CASE WHEN doc_dev IS NULL THEN 'Não' ELSE 'Sim' END AS devolucao,
       doc_dev IS NOT NULL AS has_return
FROM b
""")
def null_tests(spark, sf):
    li = t(spark, sf, "lineitem")
    dev = (li.filter(F.col("l_returnflag") == "R").groupBy("l_orderkey")
           .agg(F.max("l_linenumber").alias("doc_dev")))
    o = t(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("B")).alias("recusa"),
        F.when(F.col("o_orderstatus") == "P", F.lit("X")).alias("bloqueio"))
    j = o.join(dev, o["o_orderkey"] == dev["l_orderkey"], "left")
    return j.select("o_orderkey", rules.yes_if_any_present("recusa", "bloqueio").alias("bloq_geral"),
                    rules.yes_if_any_present("doc_dev").alias("devolucao"),
                    F.col("doc_dev").isNotNull().alias("has_return"))


@query("blank_or_null", sql="""
WITH x AS (SELECT o_orderkey, o_orderpriority,
                  CASE o_orderpriority WHEN '1-URGENT' THEN '  ' WHEN '2-HIGH' THEN NULL ELSE o_orderpriority END AS v
           FROM orders)
SELECT o_orderkey, o_orderpriority FROM x WHERE v IS NULL OR TRIM(v) = ''
""")
def blank_or_null(spark, sf):
    p = F.col("o_orderpriority")
    v = F.when(p == "1-URGENT", F.lit("  ")).when(p == "2-HIGH", F.lit(None).cast("string")).otherwise(p)
    return t(spark, sf, "orders").filter(is_blank(v)).select("o_orderkey", "o_orderpriority")


@query("prefix_exclude", sql="""
SELECT p_partkey, p_name FROM part WHERE LEFT(p_name, 2) <> ALL (['sm', 're', 'bl', 'PÇ'])
""")
def prefix_exclude(spark, sf):
    return (t(spark, sf, "part").filter(prefix_not_in("p_name", 2, ["sm", "re", "bl", "PÇ"]))
            .select("p_partkey", "p_name"))


@query("ilike_prefix", sql="SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'SMALL%'")
def ilike_prefix(spark, sf):
    return t(spark, sf, "part").filter(F.col("p_name").ilike("SMALL%")).select("p_partkey", "p_name")


_PART_RULES = [("SMALL|ring", "Redondo"), ("bolt|GEAR", "Fixação"), ("widget", "Widget")]


@query("regex_classify", sql="""
SELECT p_partkey,
       CASE WHEN regexp_matches(p_name, 'SMALL|ring', 'i') THEN 'Redondo'
            WHEN regexp_matches(p_name, 'bolt|GEAR', 'i') THEN 'Fixação'
            WHEN regexp_matches(p_name, 'widget', 'i') THEN 'Widget'
            ELSE p_type END AS charge_type
FROM part
""")
def q_regex_classify(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", regex_classify("p_name", _PART_RULES, default="p_type").alias("charge_type"))


@query("profit_center_class", sql="""
SELECT p_partkey, p_brand,
       CASE WHEN POSITION('#25' IN p_brand) > 0 THEN '#25'
            ELSE CASE SUBSTRING(p_brand, 7, 1)
                   WHEN '1' THEN 'LONGO PRAZO' WHEN '2' THEN 'LONGO PRAZO'
                   WHEN '3' THEN 'SPOT - GRANDES CONTAS' WHEN '4' THEN 'SPOT - VAREJO'
                   WHEN 'T' THEN 'SPOT - GRANDES CONTAS' ELSE '' END END AS tipo_contrato
FROM part
""")
def profit_center_class(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", "p_brand",
                    rules.contract_type_from_profit_centre("p_brand", marker="#25", pos=7).alias("tipo_contrato"))


@query("date_window", sql=f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1997-01-01'
  AND CAST(o_orderdate AS DATE) < date_trunc('month', DATE '{AS_OF}') + INTERVAL 2 MONTH
""")
def date_window(spark, sf):
    # bounds are timestamps like the column, so the range reaches the scan
    od = F.col("o_orderdate")
    return (t(spark, sf, "orders")
            .filter((od >= F.lit("1997-01-01").cast("timestamp")) & (od < months_ahead_start(AS_OF, 2).cast("timestamp")))
            .select("o_orderkey", dtext("o_orderdate").alias("order_date")))


_WINDOWS = [(10, "1995-01-01", "1995-12-31"), (20, "1996-03-01", "1996-06-30"), (30, "1997-01-01", "1997-12-31")]


@query("exception_windows", sql=f"""
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
WHERE ((o_custkey = 10 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-12-31')
    OR (o_custkey = 20 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-06-30')
    OR (o_custkey = 30 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')
    OR CAST(o_orderdate AS DATE) >= DATE '1998-01-01')
  AND CAST(o_orderdate AS DATE) < date_trunc('month', DATE '{AS_OF}') + INTERVAL 2 MONTH
""")
def exception_windows(spark, sf):
    od = d("o_orderdate")
    cond = in_exception_windows(od, "o_custkey", _WINDOWS, "1998-01-01") & (od < months_ahead_start(AS_OF, 2))
    return t(spark, sf, "orders").filter(cond).select("o_orderkey", "o_custkey",
                                                      dtext("o_orderdate").alias("order_date"))


@query("left_join_or_null", sql="""
SELECT c.c_custkey, CAST(o.o_orderkey AS VARCHAR) AS o_orderkey
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
WHERE (CAST(o.o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o.o_orderdate AS DATE) <= DATE '1996-03-31')
   OR o.o_orderdate IS NULL
""")
def left_join_or_null(spark, sf):
    # The range test runs after the outer join (it must not become part of ON).
    c = t(spark, sf, "customer").select("c_custkey")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", d("o_orderdate").alias("od"))
    j = c.join(o, c["c_custkey"] == o["o_custkey"], "left")
    keep = ((F.col("od") >= F.lit("1996-01-01").cast("date")) & (F.col("od") <= F.lit("1996-03-31").cast("date"))) \
        | F.col("od").isNull()
    return j.filter(keep).select("c_custkey", idtext("o_orderkey").alias("o_orderkey"))


@query("order_output", sql="""
SELECT o_orderkey, o_custkey, ROUND(o_totalprice, 2) AS o_totalprice FROM orders ORDER BY o_orderkey
""")
def order_output(spark, sf):
    # A report order is a range-partitioned global sort (no single-task sort).
    return (t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"))
            .orderBy("o_orderkey"))
