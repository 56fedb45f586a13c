"""V1 — rental service invoices: one row per invoice item of a rental category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import codes as K
from ledgerlens.functions import rules
from ledgerlens.functions.text import join_words, tax_id_pick
from ledgerlens.operators import lookup_join, text_lookup


def rental_invoices(vbrp: DataFrame, vbrk: DataFrame, vbak: DataFrame, kna1: DataFrame, tvakt: DataFrame,
                    cepct: DataFrame) -> DataFrame:
    """Invoice items in the rental categories, not drafts, of non-cancelled invoices.

    The header join is written as inner: the WHERE tests on the header
    (type not a cancellation, not cancelled) reject the rows a left join
    would have kept without a header. Item and header filters are applied
    before the join, so they reach both scans.
    """
    items = vbrp.filter(F.col("pstyv").isin(K.RENTAL_INVOICE_CATEGORIES) & (F.col("draft") == ""))
    head = (vbrk.filter(~F.col("fkart").isin(K.CANCELLATION_INVOICE_TYPES) & (F.col("fksto") == ""))
            .select(F.col("vbeln").alias("h_vbeln"), "xblnr", F.col("fkdat").alias("h_fkdat")))
    j = items.join(head, items["vbeln"] == head["h_vbeln"], "inner")
    j = lookup_join(j, kna1, on=[("kunrg_ana", "kunnr")],
                    select={"c_kunnr": "kunnr", "stcd1": "stcd1", "stcd2": "stcd2", "name1": "name1",
                            "name2": "name2", "name3": "name3"})
    j = text_lookup(j, tvakt, on=[("pstyv", "auart")], select={"tipo_nfs": "bezei"}, lang=K.TEXT_LANGUAGE)
    j = lookup_join(j, vbak, on=[("aubel", "vbeln")], select={"n_contrato": "vgbel"})
    # profit-centre texts have no language key: a centre with several texts multiplies rows, as in SQL
    j = lookup_join(j, cepct, on=[("prctr", "prctr")], select={"ktext": "ktext"})
    return j.select(
        "tipo_nfs", "n_contrato", F.col("aubel").alias("n_ordem"), F.col("vbeln").alias("n_fat"),
        F.col("xblnr").alias("n_nfs"), F.col("h_fkdat").alias("data_emissao"), F.col("posnr").alias("n_item"),
        F.col("matnr").alias("n_material"), F.col("arktx").alias("descricao_item"), F.col("charg").alias("n_armac"),
        F.col("netwr").alias("valor_maq"), F.col("prctr").alias("centro_lucro"),
        rules.profit_centre_name("prctr", "ktext").alias("nome_centro_lucro"),
        F.col("c_kunnr").alias("Cód. Cliente"),
        tax_id_pick("stcd1", "stcd2", "blank_only").alias("CNPJ_CPF"),
        join_words("name1", "name2", "name3").alias("Nome do Cliente"),
    )
