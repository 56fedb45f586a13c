"""V2 — cash receipts: receivable clearing lines with the customer's name and tax id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import codes as K
from ledgerlens.functions.dates import parse_date
from ledgerlens.functions.text import join_words, tax_id_pick


def receipts(bseg: DataFrame, kna1: DataFrame) -> DataFrame:
    """One row per clearing line of a receipt document on the credit side.

    Filters reach the ``bseg`` scan; the reversal test ``xragl <> 'X'``
    drops rows whose flag is NULL as well (three-valued logic).
    """
    b = bseg.filter(F.col("h_blart").isin(K.RECEIPT_DOC_TYPES) & (F.col("shkzg") == K.RECEIPT_SIDE)
                    & (F.col("xragl") != K.INACTIVE_FLAG) & (F.col("nebtr") > 0))
    k = kna1.select(F.col("kunnr").alias("__k_kunnr"), "stcd1", "stcd2", "name1", "name2", "name3")
    j = b.join(k, b["kunnr"] == k["__k_kunnr"], "left")
    return j.select(
        F.col("kunnr").alias("cod_cliente"),
        tax_id_pick("stcd1", "stcd2", "blank_only").alias("CNPJ_CPF"),
        F.trim(join_words("name1", "name2", "name3")).alias("nome_cliente"),
        F.col("zuonr").alias("referencia"),
        F.col("belnr").alias("lancamento_contabil"),
        F.col("augbl").alias("lancamento_compensacao"),
        F.col("sgtxt").alias("texto_item"),
        F.col("dmbtr").alias("montante_fatura"),
        F.col("nebtr").alias("valor_pago"),
        F.col("h_blart").alias("tipo_lancamento"),
        parse_date("augdt").alias("data_compensacao"),
        parse_date("h_budat").alias("data_receb_caixa"),
    )
