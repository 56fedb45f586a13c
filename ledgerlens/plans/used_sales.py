"""V4 — used-equipment sales and returns, with asset data and sale prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import codes as K
from ledgerlens.functions import rules
from ledgerlens.functions.dates import month_start, parse_date
from ledgerlens.functions.text import join_words, party_name, tax_id_pick
from ledgerlens.operators import lookup_join, text_lookup, pivot_by_key, semi_filter


def _sale_items(vbrp: DataFrame) -> DataFrame:
    return vbrp.filter(F.col("pstyv").isin(K.USED_SALES_CATEGORIES) & (F.col("draft") == ""))


def _live_headers(vbrk: DataFrame) -> DataFrame:
    return vbrk.filter(~F.col("fkart").isin(K.CANCELLATION_INVOICE_TYPES) & (F.col("fksto") == ""))


def sold_serials(vbrp: DataFrame, vbrk: DataFrame) -> DataFrame:
    """Serial numbers on live sale lines: the machines whose register rows the view needs."""
    return semi_filter(_sale_items(vbrp), _live_headers(vbrk).select("vbeln"), "vbeln").select("charg").distinct()


def sale_prices(prcd_elements: DataFrame, vbrp: DataFrame, vbrk: DataFrame) -> DataFrame:
    """Interest / net price per (condition doc, item), only for conditions of a live sale line.

    The correlated EXISTS is a left-semi join (no duplication), applied
    before the pivot so only qualifying condition rows are aggregated.
    """
    items = _sale_items(vbrp)
    heads = _live_headers(vbrk).select(F.col("vbeln").alias("h_vbeln"))
    qualifying = items.join(heads, items["vbeln"] == heads["h_vbeln"], "left_semi").select(
        F.col("knumv_ana").alias("knumv"))
    pe = semi_filter(prcd_elements, qualifying, "knumv")
    return pivot_by_key(pe, ["knumv", "kposn"], "kschl", K.USED_SALES_MEASURES, agg="sum", value_col="kwert")


def used_sales(vbrp: DataFrame, vbrk: DataFrame, kna1: DataFrame, tvzbt: DataFrame, t001w: DataFrame,
               cepct: DataFrame, bseg: DataFrame, asset_register: DataFrame, pm_documentos_medicao: DataFrame,
               prcd_elements: DataFrame, vbpa: DataFrame, but000: DataFrame, vbkd: DataFrame, parts=None) -> DataFrame:
    """V4. With ``parts`` (``plans.stages.Parts``) the rows are written after the lookups of each key instead of
    running as one job, so the exchanges of one key alone are on disk at once."""
    def step(df, name, *drops):
        return df if parts is None else parts.step(df, name, drops=drops)

    items = _sale_items(vbrp)
    heads = _live_headers(vbrk).select(F.col("vbeln").alias("h_vbeln"), F.col("xblnr").alias("h_xblnr"),
                                       F.col("erdat").alias("h_erdat"), F.col("fkdat").alias("h_fkdat"),
                                       F.col("zterm").alias("h_zterm"))
    # lookups by one key follow each other (one exchange of the rows serves them), those that add little come
    # first, the register's many columns last, where the rows need not move on
    j = items.join(heads, items["vbeln"] == heads["h_vbeln"], "inner")
    acc = bseg.filter((F.col("vorgn") == K.ACCOUNTING_PROCESS) & (F.col("buzei") == K.ACCOUNTING_FIRST_ITEM))
    j = lookup_join(j, acc, on=[("vbeln", "vbeln")], select={"doc_contabil": "belnr"})
    j = step(j, "billed")
    cond = sale_prices(prcd_elements, vbrp, vbrk)
    j = lookup_join(j, cond, on=[("knumv_ana", "knumv"), ("posnr", "kposn")],
                    select={"preco_c_juros": "preco_c_juros", "preco_liquido": "preco_liquido"})
    j = step(j, "priced", "billed")
    # a seller's names are joined to the sellers, and both meet the rows at once
    names = {"s_org1": "name_org1", "s_org2": "name_org2", "s_first": "name_first", "s_last": "name_last"}
    seller = lookup_join(vbpa.filter(F.col("parvw") == K.PARTNER_SELLER).select("vbeln", "posnr", "lifnr"), but000,
                         on=[("lifnr", "partner")], select=names)
    j = lookup_join(j, seller, on=[("aubel", "vbeln"), ("posnr", "posnr")], select={x: x for x in names})
    j = step(j, "sellers", "priced")
    ref = vbkd.filter(F.col("posnr") == K.HEADER_ITEM)
    j = lookup_join(j, ref, on=[("aubel", "vbeln")], select={"referencia": "bstkd"})
    j = step(j, "referred", "sellers")
    j = lookup_join(j, kna1, on=[("kunag_ana", "kunnr")],
                    select={"c_kunnr": "kunnr", "stcd1": "stcd1", "stcd2": "stcd2", "name1": "name1",
                            "name2": "name2", "name3": "name3"})
    j = step(j, "named", "referred")
    fag = asset_register.select(F.col("numero_armac").alias("f_key"), "chassi", "implemento", "bu", "grupo", "tipo",
                                "marca", "modelo", "ano_fabricacao", "valor_aquisicao", "saldo_residual",
                                "valor_aquisicao_implemento", "saldo_residual_implemento")
    j = j.join(fag, j["charg"] == fag["f_key"], "left")
    meter = pm_documentos_medicao.filter((F.col("rank_doc_medicao") == K.FIRST_RANK)
                                         & (F.col("descr_ponto_medicao") == K.HOUR_METER_POINT))
    j = lookup_join(j, meter, on=[("charg", "n_equipamento")], select={"horimetro": "valor_doc_medicao"})
    j = text_lookup(j, tvzbt, on=[("h_zterm", "zterm")], select={"cond_pag": "vtext"}, lang=K.TEXT_LANGUAGE)
    j = lookup_join(j, t001w, on=[("werks", "werks")], select={"nome_centro": "name1"})
    # last: a centre with two texts doubles its rows
    j = lookup_join(j, cepct, on=[("prctr", "prctr")], select={"nome_cl": "ktext"})
    billed = parse_date("h_fkdat")
    out = j.select(
        F.col("c_kunnr").alias("Cód. Cliente"),
        tax_id_pick("stcd1", "stcd2", "blank_only").alias("CNPJ_CPF"),
        join_words("name1", "name2", "name3").alias("Nome do Cliente"),
        rules.sale_or_return("pstyv").alias("Status"),
        F.col("aubel").alias("N.Ordem"), F.col("vbeln").alias("N. Fatura SAP"), F.col("h_xblnr").alias("N. NF de Venda"),
        F.col("doc_contabil").alias("N. Doc Contabil"),
        parse_date("h_erdat").alias("Data Criação"), billed.alias("Data Faturamento"),
        month_start(billed).alias("Mês Contábil"),
        F.col("posnr").alias("N. Item"), F.col("matnr").alias("N. Material"), F.col("arktx").alias("Descrição do Material"),
        F.col("charg").alias("Lote"), F.col("chassi").alias("Chassi"), "implemento", F.col("bu").alias("Classe"),
        F.col("grupo").alias("Grupo"), F.col("tipo").alias("Tipo"), F.col("marca").alias("Fabricante"),
        F.col("modelo").alias("Modelo"), "ano_fabricacao", F.col("horimetro").alias("Horimetro"),
        rules.signed_amount("pstyv", "kzwi1").alias("Valor Faturado"),
        F.coalesce("preco_c_juros", F.lit(0)).alias("Preco c/ Juros"),
        F.coalesce("preco_liquido", F.lit(0)).alias("Preco Liquido"),
        F.col("valor_aquisicao").alias("Valor de Compra"), F.col("saldo_residual").alias("Saldo Residual"),
        F.col("valor_aquisicao_implemento").alias("Valor de Compra Implemento"),
        F.col("saldo_residual_implemento").alias("Saldo Residual Implemento"),
        F.col("cond_pag").alias("Cond. Pagamento"), F.col("werks").alias("Centro"),
        F.col("nome_centro").alias("Nome Centro"), F.col("prctr").alias("Centro de Lucro"),
        F.col("nome_cl").alias("Nome Centro de Lucro"),
        party_name("s_org1", "s_org2", "s_first", "s_last").alias("Vendedor"),
        F.col("referencia").alias("Referencia"),
    )
    return out if parts is None else parts.result([out])
