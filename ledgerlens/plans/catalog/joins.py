"""Join queries: inner/left/multi-key, lookups, role-playing, self join, fallbacks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.functions.text import code_map
from ledgerlens.operators import fallback_lookup, fanout_audit, lookup_join, semi_filter
from ledgerlens.plans.catalog.common import idtext, money, t
from ledgerlens.plans.registry import query


@query("join_inner", sql="""
SELECT o.o_orderkey, c.c_name, ROUND(o.o_totalprice, 2) AS o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def join_inner(spark, sf):
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select("o_orderkey", "c_name",
                                                                       money("o_totalprice").alias("o_totalprice"))


@query("join_inner_filtered", sql="""
SELECT o.o_orderkey, c.c_custkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING'
""")
def join_inner_filtered(spark, sf):
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select("o_orderkey", "c_custkey")


@query("join_left", sql="""
SELECT c.c_custkey, CAST(o.o_orderkey AS VARCHAR) AS o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
""")
def join_left(spark, sf):
    c = t(spark, sf, "customer")
    o = t(spark, sf, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left").select("c_custkey",
                                                                      idtext("o_orderkey").alias("o_orderkey"))


@query("join_left_multikey", sql="""
WITH open_qty AS (SELECT l_orderkey AS k, l_returnflag AS f, SUM(l_quantity) AS q
                  FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey, l_returnflag)
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, ROUND(open_qty.q, 2) AS open_qty
FROM lineitem l LEFT JOIN open_qty ON l.l_orderkey = open_qty.k AND l.l_returnflag = open_qty.f
""")
def join_left_multikey(spark, sf):
    li = t(spark, sf, "lineitem")
    agg = (li.filter(F.col("l_linestatus") == "O").groupBy(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("f"))
           .agg(F.sum("l_quantity").alias("q")))
    base = li.select("l_orderkey", "l_linenumber", "l_returnflag")
    j = base.join(agg, (base["l_orderkey"] == agg["k"]) & (base["l_returnflag"] == agg["f"]), "left")
    return j.select("l_orderkey", "l_linenumber", "l_returnflag", money("q").alias("open_qty"))


@query("join_left_lhs_pred", sql="""
SELECT o.o_orderkey, o.o_orderstatus, CAST(l.l_linenumber AS VARCHAR) AS l_linenumber
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F'
""")
def join_left_lhs_pred(spark, sf):
    # A left-side constant in ON keeps every left row; only eligible rows look for partners.
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    j = o.join(li, (o["o_orderkey"] == li["l_orderkey"]) & (o["o_orderstatus"] == "F"), "left")
    return j.select("o_orderkey", "o_orderstatus", idtext("l_linenumber").alias("l_linenumber"))


@query("join_lookup_lang", sql="""
SELECT o.o_orderkey, c.c_custkey, n.n_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_regionkey = 1
""")
def join_lookup_lang(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    # nation has a fixed size by definition of the schema -> broadcast hint is safe
    out = lookup_join(oc, t(spark, sf, "nation"), on=[("c_nationkey", "n_nationkey")], select={"n_name": "n_name"},
                      lang=1, lang_col="n_regionkey", bounded=True)
    return out.select("o_orderkey", "c_custkey", "n_name")


@query("join_fanout_audit", sql="""
WITH d AS (SELECT s_nationkey AS key, COUNT(*) AS dim_rows FROM supplier GROUP BY 1 HAVING COUNT(*) > 1),
     f AS (SELECT c_nationkey AS key, COUNT(*) AS fact_rows FROM customer GROUP BY 1)
SELECT f.key, f.fact_rows, d.dim_rows, f.fact_rows * d.dim_rows AS joined_rows FROM f JOIN d ON f.key = d.key
""")
def join_fanout_audit(spark, sf):
    return fanout_audit(t(spark, sf, "customer"), t(spark, sf, "supplier"), "c_nationkey", "s_nationkey") \
        .select("key", "fact_rows", "dim_rows", "joined_rows")


@query("join_role_playing", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, cn.n_name AS cust_nation, sn.n_name AS supp_nation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
""")
def join_role_playing(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, F.col("o_custkey") == c["c_custkey"])
         .join(s, F.col("l_suppkey") == s["s_suppkey"]))
    nation = t(spark, sf, "nation")
    j = lookup_join(j, nation, on=[("c_nationkey", "n_nationkey")], select={"cust_nation": "n_name"}, bounded=True)
    j = lookup_join(j, nation, on=[("s_nationkey", "n_nationkey")], select={"supp_nation": "n_name"}, bounded=True)
    return j.select("l_orderkey", "l_linenumber", "l_suppkey", "cust_nation", "supp_nation")


@query("self_join_attach", sql="""
SELECT p.p_partkey, CAST(att.p_partkey AS VARCHAR) AS attached,
       ROUND(CASE WHEN LEFT(p.p_name, 2) = 're' OR LEFT(att.p_name, 2) = 're'
                  THEN p.p_retailprice + COALESCE(att.p_retailprice, 0) ELSE p.p_retailprice END, 2) AS valor,
       ROUND(COALESCE(att.p_retailprice, 0), 2) AS valor_implemento
FROM part p LEFT JOIN part att ON p.p_partkey + 1000 = att.p_partkey
""")
def self_join_attach(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice").withColumn("attach_key",
                                                                                       F.col("p_partkey") + 1000)
    att = t(spark, sf, "part").select(F.col("p_partkey").alias("att_key"), F.col("p_name").alias("att_name"),
                                      F.col("p_retailprice").alias("att_price"))
    j = p.join(att, p["attach_key"] == att["att_key"], "left")
    val = rules.composite_value("p_name", "att_name", "p_retailprice", "att_price", prefix="re")
    return j.select("p_partkey", idtext("att_key").alias("attached"), money(val).alias("valor"),
                    money(F.coalesce("att_price", F.lit(0.0))).alias("valor_implemento"))


@query("join_trim_key", sql="""
WITH padded AS (SELECT '  ' || CAST(n_nationkey AS VARCHAR) || ' ' AS code, n_name FROM nation)
SELECT c.c_custkey, p.n_name FROM customer c JOIN padded p ON CAST(c.c_nationkey AS VARCHAR) = TRIM(p.code)
""")
def join_trim_key(spark, sf):
    padded = t(spark, sf, "nation").select(
        F.concat(F.lit("  "), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("code"), "n_name")
    # normalise the key once, then it is a plain equi join
    dim = padded.select(F.trim("code").alias("code"), "n_name")
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nk"))
    return c.join(dim, c["nk"] == dim["code"], "inner").select("c_custkey", "n_name")


@query("fallback_lookup", sql="""
WITH dim AS (SELECT c_custkey,
                    CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN '' ELSE c_mktsegment END AS label
             FROM customer)
SELECT o.o_orderkey, CASE WHEN a.label = '' OR a.label IS NULL THEN b.label ELSE a.label END AS segment
FROM orders o LEFT JOIN dim a ON o.o_custkey = a.c_custkey LEFT JOIN dim b ON o.o_custkey + 1 = b.c_custkey
""")
def q_fallback_lookup(spark, sf):
    seg = F.col("c_mktsegment")
    dim = t(spark, sf, "customer").select(
        "c_custkey", F.when(seg == "MACHINERY", F.lit(None).cast("string")).when(seg == "BUILDING", F.lit(""))
        .otherwise(seg).alias("label"))
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") + 1).alias("parent_key"))
    out = fallback_lookup(o, dim, "c_custkey", "o_custkey", "parent_key", {"segment": "label"},
                          blank_aware=["segment"])
    return out.select("o_orderkey", "segment")


_PRIORITY_TYPE = [("1-URGENT", "SPOT - VAREJO"), ("2-HIGH", "SPOT - GRANDES CONTAS"), ("3-MEDIUM", "LONGO PRAZO")]


@query("override_lookup", sql="""
WITH ovr AS (SELECT c_custkey AS numero, 'OVERRIDE ' || c_mktsegment AS mercado_real FROM customer WHERE c_acctbal > 9000)
SELECT o.o_orderkey,
       CASE WHEN o.o_custkey = ovr.numero THEN ovr.mercado_real
            WHEN o.o_orderpriority = '1-URGENT' THEN 'SPOT - VAREJO'
            WHEN o.o_orderpriority = '2-HIGH' THEN 'SPOT - GRANDES CONTAS'
            WHEN o.o_orderpriority = '3-MEDIUM' THEN 'LONGO PRAZO'
            ELSE '' END AS tipo_contrato
FROM orders o LEFT JOIN ovr ON o.o_custkey = ovr.numero
""")
def override_lookup(spark, sf):
    ovr = (t(spark, sf, "customer").filter(F.col("c_acctbal") > 9000)
           .select(F.col("c_custkey").alias("numero"), F.concat(F.lit("OVERRIDE "), "c_mktsegment").alias("mercado_real")))
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = o.join(ovr, o["o_custkey"] == ovr["numero"], "left")
    tipo = rules.override_or(F.col("o_custkey") == F.col("numero"), "mercado_real",
                             code_map("o_orderpriority", _PRIORITY_TYPE, ""))
    return j.select("o_orderkey", tipo.alias("tipo_contrato"))


@query("semi_exists", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
              WHERE o.o_orderkey = l.l_orderkey AND c.c_mktsegment = 'AUTOMOBILE'
                AND o.o_orderpriority IN ('1-URGENT', '2-HIGH'))
""")
def semi_exists(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    c = t(spark, sf, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    qual = o.join(c, o["o_custkey"] == c["c_custkey"], "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return semi_filter(li, qual, "l_orderkey")


@query("three_state_flag", sql="""
WITH f AS (SELECT l_orderkey, CASE WHEN MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN 'X' ELSE '' END AS flag_dev
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey,
       CASE WHEN f.flag_dev = 'X' THEN 'Devolvido' WHEN f.flag_dev <> 'X' THEN 'Em Uso' ELSE 'Não Encontrado' END AS status_ativo
FROM orders o LEFT JOIN f ON o.o_orderkey = f.l_orderkey
""")
def three_state_flag(spark, sf):
    f = (t(spark, sf, "lineitem").groupBy("l_orderkey")
         .agg(F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("has_r"))
         .select("l_orderkey", F.when(F.col("has_r") == 1, F.lit("X")).otherwise(F.lit("")).alias("flag_dev")))
    o = t(spark, sf, "orders").select("o_orderkey")
    j = o.join(f, o["o_orderkey"] == f["l_orderkey"], "left")
    return j.select("o_orderkey", rules.device_status("flag_dev").alias("status_ativo"))


_ORDER_STATUS = [("O", "FAT. PENDENTE"), ("F", "FATURADO"), ("P", "FATURADO")]


@query("case_null_branch", sql="""
WITH s AS (SELECT o_orderkey, o_custkey,
                  CASE o_orderstatus WHEN 'O' THEN 'FAT. PENDENTE' WHEN 'F' THEN 'FATURADO' WHEN 'P' THEN 'FATURADO'
                                     WHEN NULL THEN 'FAT. PENDENTE' ELSE 'FAT. PENDENTE' END AS status
           FROM orders)
SELECT c.c_custkey, CAST(s.o_orderkey AS VARCHAR) AS o_orderkey,
       CASE s.status WHEN 'FAT. PENDENTE' THEN 'FAT. PENDENTE' WHEN 'FATURADO' THEN 'FATURADO'
                     WHEN NULL THEN 'BM PENDENTE' ELSE 'BM PENDENTE' END AS status_ordem
FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey
""")
def case_null_branch(spark, sf):
    # ``WHEN NULL`` never matches; the ELSE branch decides, so it is simply left out.
    s = t(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                      code_map("o_orderstatus", _ORDER_STATUS, "FAT. PENDENTE").alias("status"))
    c = t(spark, sf, "customer").select("c_custkey")
    j = c.join(s, c["c_custkey"] == s["o_custkey"], "left")
    return j.select("c_custkey", idtext("o_orderkey").alias("o_orderkey"),
                    rules.reconciled_order_status("status").alias("status_ordem"))
