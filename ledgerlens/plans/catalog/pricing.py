"""Priced-flow queries: the V8 builder run over a flow derived from the driver
tables (lineitem ⋈ orders ⋈ part), one key per pricing rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.text import code_map
from ledgerlens.plans.catalog.common import d, dtext, t
from ledgerlens.plans.priced_flow import priced_flow
from ledgerlens.plans.registry import query

# part type -> charge type, order status -> order status label (driver roles)
_TYPE_MAP = [("ECONOMY", "Máquina"), ("SMALL", "Implementos"), ("MEDIUM", "Seguro"), ("PROMO", "Fretes"),
             ("STANDARD", "Avarias"), ("LARGE", "Outros")]
_STATUS_MAP = [("O", "BM PENDENTE"), ("F", "FATURADO"), ("P", "FAT. PENDENTE")]


def driver_flow(spark, sf):
    """Flow lines from the driver tables, named like the flow view the builder reads."""
    li = t(spark, sf, "lineitem")
    o = t(spark, sf, "orders")
    p = t(spark, sf, "part").select("p_partkey", "p_type")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"], "left")
    od, sd = d("o_orderdate"), d("l_shipdate")
    ini = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("date")).otherwise(F.least(od, sd))
    r2 = lambda c: F.round(c, 2)
    return j.select(
        F.col("o_orderdate").alias("Data/hora Extração"),
        F.col("o_custkey").cast("string").alias("Codigo Cliente"),
        F.col("o_orderkey").cast("string").alias("N. Ordem"),
        code_map("o_orderstatus", _STATUS_MAP, "").alias("Status Ordem"),
        ini.alias("Ini_Prog_Linha"), F.greatest(od, sd).alias("Fim_Prog_Linha"),
        F.trunc(od, "MM").alias("Ini_Prog_Cabe"), F.last_day(F.greatest(od, sd)).alias("Fim_Prog_Cabe"),
        F.col("l_partkey").cast("string").alias("Item Ctr"), F.col("l_linenumber").cast("string").alias("Item Ord"),
        code_map("p_type", _TYPE_MAP, "").alias("Tipo de Material"),
        F.col("l_partkey").cast("string").alias("Material"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice") / 100)
        .otherwise(F.col("l_extendedprice") / 100).alias("Preco"),
        r2(F.col("l_tax") * 1000 - 30).alias("Seguro"),
        r2(F.col("l_discount") * 1000 - 40).alias("Frete"),
        F.when(F.col("l_returnflag") == "A", F.lit(0.0)).otherwise(F.col("l_quantity") - 25).alias("Avaria"),
        r2((F.col("l_discount") - 0.05) * 100).alias("Desconto"),
        (F.col("l_quantity") - 30).alias("Total_H_Var"),
        r2(F.col("l_tax") * 100 - 4).alias("Total_H_Extra"),
        F.col("l_quantity").alias("Total_H_Exc"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("B1")).alias("Bloqueio"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"), F.lit("R1")).alias("Recusa"),
        F.when(F.col("l_returnflag") == "R", F.col("l_orderkey").cast("string")).alias("Doc. Contabil Dev."),
    )


_FLOW_SQL = """
WITH flow AS (
  SELECT o.o_orderdate AS "Data/hora Extração",
         CAST(o.o_custkey AS VARCHAR) AS "Codigo Cliente",
         CAST(o.o_orderkey AS VARCHAR) AS "N. Ordem",
         CASE o.o_orderstatus WHEN 'O' THEN 'BM PENDENTE' WHEN 'F' THEN 'FATURADO' WHEN 'P' THEN 'FAT. PENDENTE' ELSE '' END
           AS "Status Ordem",
         CASE WHEN l.l_linenumber = 7 THEN NULL
              ELSE LEAST(CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) END AS "Ini_Prog_Linha",
         GREATEST(CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS "Fim_Prog_Linha",
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS "Ini_Prog_Cabe",
         last_day(GREATEST(CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))) AS "Fim_Prog_Cabe",
         CAST(l.l_partkey AS VARCHAR) AS "Item Ctr", CAST(l.l_linenumber AS VARCHAR) AS "Item Ord",
         CASE p.p_type WHEN 'ECONOMY' THEN 'Máquina' WHEN 'SMALL' THEN 'Implementos' WHEN 'MEDIUM' THEN 'Seguro'
                       WHEN 'PROMO' THEN 'Fretes' WHEN 'STANDARD' THEN 'Avarias' WHEN 'LARGE' THEN 'Outros' ELSE '' END
           AS "Tipo de Material",
         CAST(l.l_partkey AS VARCHAR) AS "Material",
         CASE WHEN l.l_returnflag = 'R' THEN -l.l_extendedprice / 100 ELSE l.l_extendedprice / 100 END AS "Preco",
         ROUND(l.l_tax * 1000 - 30, 2) AS "Seguro",
         ROUND(l.l_discount * 1000 - 40, 2) AS "Frete",
         CASE WHEN l.l_returnflag = 'A' THEN 0.0 ELSE l.l_quantity - 25 END AS "Avaria",
         ROUND((l.l_discount - 0.05) * 100, 2) AS "Desconto",
         l.l_quantity - 30 AS "Total_H_Var",
         ROUND(l.l_tax * 100 - 4, 2) AS "Total_H_Extra",
         l.l_quantity AS "Total_H_Exc",
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'B1' END AS "Bloqueio",
         CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'R' THEN 'R1' END AS "Recusa",
         CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_orderkey AS VARCHAR) END AS "Doc. Contabil Dev."
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey),
kinds(kind, recurring, rental, insured, freight, damage, other) AS (VALUES
  ('Máquina', 1, 1, 0, 0, 0, 0), ('Implementos', 1, 1, 0, 0, 0, 0), ('Seguro', 1, 0, 1, 0, 0, 0),
  ('Fretes', 0, 0, 0, 1, 0, 0), ('Avarias', 0, 0, 0, 0, 1, 0), ('Outros', 0, 0, 0, 0, 0, 1)),
modes(moved_in, moved_out, mode) AS (VALUES
  (true, false, 'Proporcional Mobilização'), (true, true, 'Proporcional Mobilização'),
  (false, true, 'Proporcional Desmobilização')),
share(pending, partial, divisor, by_day) AS (VALUES
  (false, false, 1, false), (false, true, 1, false), (true, false, 1, false), (true, true, 30, true)),
measured AS (
  SELECT flow.*, coalesce(k.recurring, 0) AS recurring, coalesce(k.rental, 0) AS rental, coalesce(k.insured, 0) AS insured,
         coalesce(k.freight, 0) AS freight, coalesce(k.damage, 0) AS damage, coalesce(k.other, 0) AS other,
         coalesce(date_diff('day', "Ini_Prog_Linha", "Fim_Prog_Linha") + 1, 0) AS days,
         coalesce(day("Ini_Prog_Linha") != day("Ini_Prog_Cabe"), false) AS moved_in,
         coalesce(day("Fim_Prog_Linha") != day("Fim_Prog_Cabe"), false) AS moved_out,
         ("Recusa" IS NOT NULL)::INT + ("Bloqueio" IS NOT NULL)::INT AS holds
  FROM flow LEFT JOIN kinds k ON k.kind = "Tipo de Material"),
shared AS (
  SELECT measured.*, coalesce(modes.mode, 'Integral') AS mode, divisor, if(by_day, days, 1) AS times
  FROM measured
  LEFT JOIN modes ON recurring = 1 AND days < 30 AND modes.moved_in = measured.moved_in AND modes.moved_out = measured.moved_out
  JOIN share ON share.pending = ("Status Ordem" = 'BM PENDENTE') AND share.partial = (modes.mode IS NOT NULL)),
base_final AS (
  SELECT "N. Ordem", "Item Ord", "Item Ctr", "Status Ordem", "Tipo de Material", "Ini_Prog_Linha" AS "Inicio Item",
         "Fim_Prog_Linha" AS "Fim Item", days AS "Dias Utilização", ['Única', 'Recorrente'][recurring + 1] AS "Freq. Cobrança",
         mode AS "Tipo Cobrança",
         if(rental = 1, greatest("Preco", 0), 0) / divisor * times AS "Locação",
         if("Seguro" >= 0, if(insured = 1, "Preco" + "Seguro", "Seguro"), 0) / divisor * times AS "Seguro",
         if(freight = 1, "Preco" + "Frete", greatest("Frete", 0)) AS "Frete",
         if(damage = 1 AND "Avaria" = 0, greatest("Preco", 0), greatest("Avaria", 0)) AS "Avaria",
         "Total_H_Exc" AS "Horas Exc.",
         coalesce(list_filter([{'seen': "Preco", 'pays': "Preco" + "Desconto"}, {'seen': "Frete", 'pays': "Frete" + "Desconto"},
                               {'seen': "Seguro", 'pays': "Seguro" + "Desconto"}, {'seen': "Desconto", 'pays': "Desconto"}],
                              lambda x: x.seen < 0)[1].pays, 0) AS "Desconto",
         coalesce(list_filter([if(other = 1, "Preco", 0), "Desconto", "Total_H_Var", "Total_H_Extra"],
                              lambda x: x > 0)[1], 0) AS "Outros",
         ['Não', 'Sim'][least(holds, 1) + 1] AS "Bloq. Geral",
         ['Não', 'Sim'][("Doc. Contabil Dev." IS NOT NULL)::INT + 1] AS "Devolução"
  FROM shared),
priced AS (
  SELECT *, if("Bloq. Geral" = 'Sim', 0, "Locação" + "Seguro" + "Frete" + "Avaria" + "Horas Exc." + "Desconto" + "Outros") AS "Preço Final"
  FROM base_final)
"""

_IDS = ["N. Ordem", "Item Ord", "Item Ctr"]


def _priced(spark, sf):
    return priced_flow(driver_flow(spark, sf))


def _money(c):
    # not rounded: both engines evaluate the same IEEE operations in the same order,
    # while rounding a quotient to 2 places is where engines differ on ties
    return F.col(f"`{c}`").cast("double").alias(c)


def _sel(cols_text=(), cols_money=()):
    def build(spark, sf):
        p = _priced(spark, sf)
        return p.select(*[F.col(f"`{c}`") for c in _IDS],
                        *[(dtext(F.col(f"`{c}`")).alias(c) if c in ("Inicio Item", "Fim Item") else F.col(f"`{c}`"))
                          for c in cols_text],
                        *[_money(c) for c in cols_money])
    return build


def _sql(cols_text=(), cols_money=()):
    parts = [f'"{c}"' for c in _IDS]
    for c in cols_text:
        parts.append(f"strftime(\"{c}\", '%Y-%m-%d') AS \"{c}\"" if c in ("Inicio Item", "Fim Item") else f'"{c}"')
    parts += [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols_money]
    return _FLOW_SQL + f"SELECT {', '.join(parts)} FROM priced"


_KEYS = {
    "inclusive_days": (["Inicio Item", "Fim Item", "Dias Utilização"], []),
    "charge_frequency": (["Tipo de Material", "Freq. Cobrança"], []),
    "prorate_class": (["Tipo de Material", "Status Ordem", "Dias Utilização", "Tipo Cobrança"], []),
    "prorate_price": (["Tipo Cobrança"], ["Locação"]),
    "prorate_insurance": (["Tipo Cobrança"], ["Seguro"]),
    "freight_damage": ([], ["Frete", "Avaria"]),
    "discount_rule": ([], ["Desconto"]),
    "other_amounts": ([], ["Outros"]),
    "price_total": (["Bloq. Geral", "Devolução"], ["Preço Final"]),
}

for _key, (_txt, _mon) in _KEYS.items():
    query(_key, sql=_sql(_txt, _mon))(_sel(_txt, _mon))
