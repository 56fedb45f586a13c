"""Projection, text, date and CASE-rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.functions.dates import month_text, parse_date, parse_date_sentinel, shift_hours
from ledgerlens.functions.text import code_map, join_words, party_name, tax_id_pick
from ledgerlens.plans.catalog.common import d, dtext, money, t
from ledgerlens.plans.registry import query


@query("project_alias", sql="""
SELECT o_orderkey AS "N. Ordem", o_custkey AS "Cód. Cliente", strftime(o_orderdate, '%Y-%m-%d') AS "Data/hora Pedido",
       ROUND(o_totalprice, 2) AS "Valor Total", o_orderpriority AS "Prioridade"
FROM orders
""")
def project_alias(spark, sf):
    return t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("N. Ordem"), F.col("o_custkey").alias("Cód. Cliente"),
        dtext("o_orderdate").alias("Data/hora Pedido"), money("o_totalprice").alias("Valor Total"),
        F.col("o_orderpriority").alias("Prioridade"))


@query("star_plus", sql="""
SELECT *, CASE WHEN c_acctbal < 0 THEN 'NEGATIVO' WHEN c_acctbal < 5000 THEN 'BAIXO' ELSE 'ALTO' END AS faixa
FROM customer
""")
def star_plus(spark, sf):
    b = F.col("c_acctbal")
    band = F.when(b < 0, "NEGATIVO").when(b < 5000, "BAIXO").otherwise("ALTO")
    return t(spark, sf, "customer").select("*", band.alias("faixa"))


@query("shadowed_columns", sql="""
SELECT l_orderkey, l_linenumber, ROUND(l_tax * 2, 4) AS l_tax, ROUND(l_discount + l_tax, 4) AS l_discount,
       ROUND(l_discount * 100 + l_tax, 4) AS mix
FROM lineitem
""")
def shadowed_columns(spark, sf):
    # One projection: every expression reads the input l_tax / l_discount, not its redefined sibling.
    return t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_tax") * 2, 4).alias("l_tax"),
        F.round(F.col("l_discount") + F.col("l_tax"), 4).alias("l_discount"),
        F.round(F.col("l_discount") * 100 + F.col("l_tax"), 4).alias("mix"))


@query("concat_null_safe", sql="""
SELECT c_custkey, concat(c_name, ' ', NULLIF(c_mktsegment, 'MACHINERY'), ' ', CAST(c_nationkey AS VARCHAR)) AS nome
FROM customer
""")
def concat_null_safe(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", join_words("c_name", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")),
                                            F.col("c_nationkey").cast("string")).alias("nome"))


_PARTY = """
WITH p AS (SELECT c_custkey,
                  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE c_mktsegment END AS org1,
                  CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN NULL ELSE 'LTDA' END AS org2,
                  c_name AS first_name, CAST(c_nationkey AS VARCHAR) AS last_name
           FROM customer)
SELECT c_custkey,
       CASE WHEN concat(org1, ' ', org2) = ' ' OR concat(org1, ' ', org2) IS NULL THEN concat(first_name, ' ', last_name)
            ELSE concat(org1, ' ', org2) END AS vendedor
FROM p
"""


@query("party_name", sql=_PARTY)
def q_party_name(spark, sf):
    seg = F.col("c_mktsegment")
    p = t(spark, sf, "customer").select(
        "c_custkey",
        F.when(seg.isin("BUILDING", "MACHINERY"), F.lit(None).cast("string")).otherwise(seg).alias("org1"),
        F.when(seg.isin("BUILDING", "HOUSEHOLD"), F.lit(None).cast("string")).otherwise(F.lit("LTDA")).alias("org2"),
        F.col("c_name").alias("first_name"), F.col("c_nationkey").cast("string").alias("last_name"))
    return p.select("c_custkey", party_name("org1", "org2", "first_name", "last_name").alias("vendedor"))


@query("right_day", sql="SELECT o_orderkey, RIGHT(strftime(o_orderdate, '%Y-%m-%d'), 2) AS dia_fat FROM orders")
def right_day(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", F.right(dtext("o_orderdate"), F.lit(2)).alias("dia_fat"))


@query("tax_id_pick", sql="""
WITH k AS (SELECT c_custkey,
                  CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS stcd1,
                  'P' || CAST(c_nationkey AS VARCHAR) AS stcd2
           FROM customer)
SELECT c_custkey,
       CASE WHEN stcd1 = '' OR stcd1 IS NULL THEN stcd2 ELSE stcd1 END AS tax_blank_or_null,
       CASE WHEN stcd1 = '' THEN stcd2 ELSE stcd1 END AS tax_blank_only,
       CASE WHEN stcd1 <> '' THEN stcd1 ELSE stcd2 END AS tax_nonblank
FROM k
""")
def q_tax_id_pick(spark, sf):
    seg = F.col("c_mktsegment")
    k = t(spark, sf, "customer").select(
        "c_custkey",
        F.when(seg == "BUILDING", F.lit("")).when(seg == "MACHINERY", F.lit(None).cast("string"))
        .otherwise(F.col("c_custkey").cast("string")).alias("stcd1"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("stcd2"))
    return k.select("c_custkey", *[tax_id_pick("stcd1", "stcd2", v).alias(f"tax_{v}")
                                   for v in ("blank_or_null", "blank_only", "nonblank")])


_DATE_TEXT = """CASE o_orderpriority WHEN '5-LOW' THEN 'not-a-date'
                    WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y/%m/%d')
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


@query("parse_date", sql=f"""
WITH x AS (SELECT o_orderkey, {_DATE_TEXT} AS data_texto FROM orders)
SELECT o_orderkey, data_texto, strftime(CAST(try_strptime(data_texto, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS data
FROM x
""")
def q_parse_date(spark, sf):
    p = F.col("o_orderpriority")
    txt = (F.when(p == "5-LOW", F.lit("not-a-date"))
           .when(p == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy/MM/dd"))
           .otherwise(dtext("o_orderdate")))
    x = t(spark, sf, "orders").select("o_orderkey", txt.alias("data_texto"))
    return x.select("o_orderkey", "data_texto", dtext(parse_date("data_texto")).alias("data"))


@query("parse_date_sentinel", sql="""
WITH x AS (SELECT o_orderkey,
                  CASE o_orderstatus WHEN 'P' THEN '0000-00-00' WHEN 'O' THEN NULL
                       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deakt
           FROM orders)
SELECT o_orderkey,
       CASE WHEN deakt IS NULL OR deakt = '0000-00-00' THEN NULL
            ELSE strftime(CAST(strptime(deakt, '%Y-%m-%d') AS DATE), '%Y-%m-%d') END AS data_baixa,
       CASE WHEN deakt IS NOT NULL AND deakt <> '0000-00-00' THEN 'Inativo' ELSE 'Ativo' END AS status_ativo
FROM x
""")
def q_parse_date_sentinel(spark, sf):
    s = F.col("o_orderstatus")
    x = t(spark, sf, "orders").select(
        "o_orderkey", F.when(s == "P", F.lit("0000-00-00")).when(s == "O", F.lit(None).cast("string"))
        .otherwise(dtext("o_orderdate")).alias("deakt"))
    baixa = parse_date_sentinel("deakt")
    return x.select("o_orderkey", dtext(baixa).alias("data_baixa"),
                    F.when(baixa.isNotNull(), F.lit("Inativo")).otherwise(F.lit("Ativo")).alias("status_ativo"))


@query("month_bucket", sql="""
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mes_contabil,
       strftime(o_orderdate, '%Y-%m-01') AS mes_texto
FROM orders
""")
def month_bucket(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", month_text("o_orderdate").alias("mes_contabil"),
                                         F.date_format("o_orderdate", "yyyy-MM-01").alias("mes_texto"))


@query("date_to_text", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS data_texto FROM orders")
def date_to_text(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", dtext("o_orderdate").alias("data_texto"))


@query("hour_shift", sql="""
SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS extracao FROM events
""")
def hour_shift(spark, sf):
    return t(spark, sf, "events").select("event_id", F.date_format(shift_hours("ts", 3), "yyyy-MM-dd HH:mm:ss")
                                         .alias("extracao"))


@query("header_default", sql="""
SELECT l.l_orderkey, l.l_linenumber,
       strftime(COALESCE(CASE WHEN l.l_linenumber = 1 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END,
                         CAST(o.o_orderdate AS DATE)), '%Y-%m-%d') AS data_inicio_item
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def header_default(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", d("l_shipdate").alias("sd"))
    o = t(spark, sf, "orders").select("o_orderkey", d("o_orderdate").alias("od"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    item = F.when(F.col("l_linenumber") == 1, F.lit(None).cast("date")).otherwise(F.col("sd"))
    return j.select("l_orderkey", "l_linenumber", dtext(F.coalesce(item, F.col("od"))).alias("data_inicio_item"))


@query("case_searched", sql="""
WITH j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_totalprice,
                  CASE WHEN o.o_orderstatus = 'F' THEN 'FATURADO' ELSE 'FAT. PENDENTE' END AS status
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey, l_linenumber, status,
       ROUND(CASE WHEN status = 'FATURADO' THEN l_extendedprice ELSE o_totalprice END, 2) AS preco_bruto,
       CASE WHEN l_extendedprice >= 50000 THEN 'A' WHEN l_extendedprice >= 20000 THEN 'B'
            WHEN l_extendedprice >= 5000 THEN 'C' ELSE 'D' END AS faixa
FROM j
""")
def case_searched(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).withColumn(
        "status", F.when(F.col("o_orderstatus") == "F", "FATURADO").otherwise("FAT. PENDENTE"))
    p = F.col("l_extendedprice")
    band = F.when(p >= 50000, "A").when(p >= 20000, "B").when(p >= 5000, "C").otherwise("D")
    return j.select("l_orderkey", "l_linenumber", "status",
                    money(rules.gross_price_choice("status", "l_extendedprice", "o_totalprice")).alias("preco_bruto"),
                    band.alias("faixa"))


_PRIORITY_LABELS = [("1-URGENT", "Urgente"), ("2-HIGH", "Alta"), ("3-MEDIUM", "Média"), ("4-NOT SPECIFIED", "Sem")]


@query("code_map", sql="""
SELECT o_orderkey,
       CASE NULLIF(o_orderpriority, '5-LOW') WHEN '1-URGENT' THEN 'Urgente' WHEN '2-HIGH' THEN 'Alta'
            WHEN '3-MEDIUM' THEN 'Média' WHEN '4-NOT SPECIFIED' THEN 'Sem' ELSE '' END AS vetor
FROM orders
""")
def q_code_map(spark, sf):
    return t(spark, sf, "orders").select(
        "o_orderkey", code_map(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), _PRIORITY_LABELS, "").alias("vetor"))


@query("nested_default", sql="""
WITH x AS (SELECT o_orderkey,
                  CASE o_orderstatus WHEN 'O' THEN '' WHEN 'P' THEN NULL ELSE 'A' || CAST(o_orderkey AS VARCHAR) END AS a,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN '' WHEN o_orderpriority = '2-HIGH' THEN NULL
                       ELSE 'B' || CAST(o_custkey AS VARCHAR) END AS b,
                  'C' || CAST(o_orderkey AS VARCHAR) AS c
           FROM orders)
SELECT o_orderkey,
       CASE WHEN a IS NULL OR a = '' THEN
            CASE WHEN b IS NULL OR b = '' THEN c ELSE b END
            ELSE a END AS n_contrato
FROM x
""")
def nested_default(spark, sf):
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    x = t(spark, sf, "orders").select(
        "o_orderkey",
        F.when(s == "O", F.lit("")).when(s == "P", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("A"), F.col("o_orderkey").cast("string"))).alias("a"),
        F.when(p == "1-URGENT", F.lit("")).when(p == "2-HIGH", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("B"), F.col("o_custkey").cast("string"))).alias("b"),
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("c"))
    return x.select("o_orderkey", rules.contract_id_chain("a", "b", "c").alias("n_contrato"))


@query("signed_amount", sql="""
WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice,
                  CASE l_returnflag WHEN 'R' THEN 'ZDAT' WHEN 'A' THEN 'ZRAT' ELSE 'ZVAT' END AS pstyv
           FROM lineitem)
SELECT l_orderkey, l_linenumber, pstyv,
       CASE WHEN pstyv = 'ZVAT' THEN 'FATURADO' ELSE 'DEVOLVIDO' END AS status,
       ROUND(CASE WHEN pstyv = 'ZVAT' THEN l_extendedprice ELSE -l_extendedprice END, 2) AS valor_faturado
FROM x
""")
def q_signed_amount(spark, sf):
    f = F.col("l_returnflag")
    x = t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(f == "R", "ZDAT").when(f == "A", "ZRAT").otherwise("ZVAT").alias("pstyv"))
    return x.select("l_orderkey", "l_linenumber", "pstyv", rules.sale_or_return("pstyv").alias("status"),
                    money(rules.signed_amount("pstyv", "l_extendedprice")).alias("valor_faturado"))


@query("chassis_fallback", sql="""
WITH a AS (SELECT p_partkey, ' ' || UPPER(LEFT(p_name, 2)) || CAST(p_partkey AS VARCHAR) AS anln1,
                  CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN '  ' ELSE p_brand END AS herst
           FROM part)
SELECT p_partkey,
       CASE WHEN LEFT(TRIM(anln1), 2) IN ('SM', 'RE') AND (herst IS NULL OR TRIM(herst) = '') THEN TRIM(anln1)
            ELSE herst END AS chassi
FROM a
""")
def chassis_fallback(spark, sf):
    sz = F.col("p_size")
    a = t(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit(" "), F.upper(F.substring("p_name", 1, 2)), F.col("p_partkey").cast("string")).alias("anln1"),
        F.when(sz < 10, F.lit(None).cast("string")).when(sz < 20, F.lit("  ")).otherwise(F.col("p_brand")).alias("herst"))
    return a.select("p_partkey", rules.chassis_fallback("anln1", "herst", prefixes=["SM", "RE"]).alias("chassi"))


@query("coalesce_zero", sql="""
WITH s AS (SELECT o_custkey, SUM(o_totalprice) AS total FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT c.c_custkey, ROUND(COALESCE(s.total, 0), 2) AS total_pendente
FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey
""")
def coalesce_zero(spark, sf):
    s = (t(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").groupBy("o_custkey")
         .agg(F.sum("o_totalprice").alias("total")))
    c = t(spark, sf, "customer").select("c_custkey")
    j = c.join(s, c["c_custkey"] == s["o_custkey"], "left")
    return j.select("c_custkey", money(F.coalesce("total", F.lit(0.0))).alias("total_pendente"))
