"""V8 — priced billing flow: proration and price components per flow line.

Input: the flow view (one row per billing flow line, reference column
names). Output: the same grain with usage days, charge frequency and mode,
the seven amount components and the final price.

Everything is a projection (three ``select``s, no shuffle): each stage reads
the *input* columns of the previous stage, so the components that reuse an
input name (``Seguro``, ``Frete``, ``Avaria``, ``Desconto``) are computed
from the incoming values, never from a sibling that was just redefined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import codes as K
from ledgerlens.functions import rules
from ledgerlens.functions.dates import inclusive_days, shift_hours

# (input name, output name) of the pass-through columns, in output order.
_HEAD = [
    ("Codigo Cliente", "Cod. Cliente"), ("Nome Cliente", None), ("Ref. Cliente", None), ("Tipo Contrato", None),
    ("N. Contrato", None), ("N. Ordem", None), ("N. Fatura", None), ("Status Ordem", None),
    ("Dt. Faturamento", None), ("Dt. Criacao Fat", None), ("Mês Contabilidade", None),
    ("Compet_Cabe_Ordem", "Compet. Medição"), ("Ini_Prog_Cabe", "Inicio Medição"), ("Fim_Prog_Cabe", "Fim Medição"),
    ("Compet_Linha", "Compet. Item"), ("Ini_Prog_Linha", "Inicio Item"), ("Fim_Prog_Linha", "Fim Item"),
]
_ITEM = [
    ("Item Ctr", None), ("Item Ord", None), ("Tipo de Material", None), ("Material", "N. Material"),
    ("Denominacao do item", None), ("N. Armac", None), ("Preco Bruto Contrato", None), ("Preco", None),
    ("Total_H_Exc", "Horas Exc."), ("Total_H_Var", None), ("Total_H_Extra", None), ("Frete", None),
    ("Avaria", None), ("Desconto", None), ("Seguro", None), ("Bloqueio", None), ("Recusa", None),
]
_TAIL = [
    "Emissor Doc.", "Cond. Pagamento", "N. Doc Contabil", "Data Vencimento", "Centro", "Centro de Lucro", "Cidade",
    "Estado", "Repres. Faturam.", "Lider Faturam.", "Consultor Faturam.", "N. Doc. Dev.", "Data Emissao Doc. Dev.",
    "N. Fat. Dev.", "Data Criacao Fat. Dev.", "Data Faturamento Fat. Dev.", "Doc. Contabil Dev.", "Mes Contabil Dev.",
    "Emissor Dev.", "Prov Receita",
]
_RETURN_COLS = set(_TAIL[_TAIL.index("N. Doc. Dev."):])
# Columns the rules read: they must be present.
REQUIRED = ["Tipo de Material", "Status Ordem", "Ini_Prog_Linha", "Fim_Prog_Linha", "Ini_Prog_Cabe", "Fim_Prog_Cabe",
            "Preco", "Seguro", "Frete", "Avaria", "Desconto", "Total_H_Var", "Total_H_Extra", "Total_H_Exc",
            "Bloqueio", "Recusa", "Doc. Contabil Dev."]


def _q(name: str):
    return F.col(f"`{name}`")


def _present(flow: DataFrame, pairs):
    return [(i, o or i) for i, o in pairs if i in flow.columns]


def priced_flow(flow: DataFrame) -> DataFrame:
    missing = [c for c in REQUIRED if c not in flow.columns]
    if missing:
        raise ValueError(f"flow input lacks {missing}")
    head, item = _present(flow, _HEAD), _present(flow, _ITEM)
    tail = [c for c in _TAIL if c in flow.columns]
    stamp = ([shift_hours(_q("Data/hora Extração"), K.EXTRACTION_HOUR_SHIFT).alias("Data_Hora Extração")]
             if "Data/hora Extração" in flow.columns else [])
    t = _q("Tipo de Material")
    base = flow.select(
        *stamp,
        *[_q(i).alias(o) for i, o in head],
        inclusive_days(_q("Ini_Prog_Linha"), _q("Fim_Prog_Linha")).alias("Dias Utilização"),
        rules.charge_frequency(t).alias("Freq. Cobrança"),
        rules.charge_mode(t, _q("Ini_Prog_Linha"), _q("Fim_Prog_Linha"), _q("Ini_Prog_Cabe"),
                          _q("Fim_Prog_Cabe")).alias("Tipo Cobrança"),
        *[_q(i).alias(o) for i, o in item],
        rules.yes_if_any_present(_q("Recusa"), _q("Bloqueio")).alias("Bloq. Geral"),
        rules.yes_if_any_present(_q("Doc. Contabil Dev.")).alias("Devolução"),
        *[_q(c) for c in tail],
    )
    keep_head = [o for _, o in head]
    bt = _q("Tipo de Material")
    status, mode, days = _q("Status Ordem"), _q("Tipo Cobrança"), _q("Dias Utilização")
    price, ins, fr, dmg, disc = _q("Preco"), _q("Seguro"), _q("Frete"), _q("Avaria"), _q("Desconto")
    item_keep = [o for _, o in item if o in ("Item Ctr", "Item Ord", "Tipo de Material", "N. Material",
                                                "Denominacao do item", "N. Armac", "Preco Bruto Contrato")]
    final = base.select(
        *[_q(c) for c in ["Data_Hora Extração"] if stamp],
        *[_q(c) for c in keep_head], _q("Dias Utilização"), _q("Freq. Cobrança"), _q("Tipo Cobrança"),
        *[_q(c) for c in item_keep],
        rules.rental_amount(bt, status, mode, price, days).alias("Locação"),
        rules.insurance_amount(bt, status, mode, price, ins, days).alias("Seguro"),
        rules.freight_amount(bt, price, fr).alias("Frete"),
        rules.damage_amount(bt, price, dmg).alias("Avaria"),
        _q("Horas Exc."),
        rules.discount_amount(price, fr, ins, disc).alias("Desconto"),
        rules.other_amount(bt, price, disc, _q("Total_H_Var"), _q("Total_H_Extra")).alias("Outros"),
        _q("Bloq. Geral"),
        *[_q(c) for c in tail if c not in _RETURN_COLS], _q("Devolução"),
        *[_q(c) for c in tail if c in _RETURN_COLS],
    )
    return final.select("*", rules.final_price(_q("Bloq. Geral"), _q("Locação"), _q("Seguro"), _q("Frete"),
                                               _q("Avaria"), _q("Horas Exc."), _q("Desconto"), _q("Outros"))
                        .alias("Preço Final"))
