"""Declared schemas of the ERP-shaped inputs (no inference).

Dates that the source system stores as ISO text are declared as strings
here and parsed by ``ingest.normalise`` (``DATE_TEXT_COLUMNS``).
Money is ``decimal(38,10)``.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_DEC = "decimal(38,10)"


def _ddl(cols: str) -> str:
    return cols


def schema(name: str) -> StructType:
    """Parsed schema of one input (needs an active session)."""
    return StructType.fromDDL(ERP_SCHEMAS[name])


def _strings(*names: str) -> str:
    return ", ".join(f"`{n}` string" for n in names)


# DDL strings (accepted as is by spark.read.schema and createDataFrame).
ERP_SCHEMAS: dict[str, str] = {
    "vbak": _ddl(_strings("vbeln", "vbtyp", "vgbel", "erdat", "ernam", "faksk", "abstk", "kunnr", "auart")),
    "vbap": _ddl(_strings("vbeln", "posnr", "vgbel", "vbtyp_ana", "auart_ana", "pstyv", "kunnr_ana", "matnr", "matkl",
                          "arktx", "charg", "prctr", "werks", "abgru", "fksaa", "fplnr_ana", "knumv_ana")
                 + f", zmeng {_DEC}, netpr {_DEC}"),
    "vbkd": _ddl(_strings("vbeln", "posnr", "bstkd", "kdgrp", "zterm", "zlsch", "fplnr", "kdkg1", "kdkg2", "kdkg3",
                          "kdkg4", "kdkg5") + ", prsdt date"),
    "veda": _ddl(_strings("vbeln", "vposn", "vinsdat", "vuntdat", "vbegdat", "venddat", "vdemdat", "vabndat")),
    "vbpa": _ddl(_strings("vbeln", "posnr", "parvw", "lifnr")),
    "but000": _ddl(_strings("partner", "name_org1", "name_org2", "name_first", "name_last", "mc_name1", "mc_name2")),
    "vbfa": _ddl(_strings("vbeln", "posnv", "posnn", "ruuid", "vbtyp_n", "vbtyp_v")),
    "fpla": _ddl(_strings("fplnr")),
    "fplt": _ddl(_strings("fplnr", "nfdat", "fkdat")),
    "vbrk": _ddl(_strings("vbeln", "fkart", "fksto", "xblnr", "zterm", "erdat", "fkdat")),
    "vbrp": _ddl(_strings("vbeln", "posnr", "vgbel", "aubel", "aupos", "ernam", "draft", "pstyv", "kunag_ana",
                          "kunrg_ana", "matnr", "arktx", "charg", "werks", "prctr", "knumv_ana", "erdat", "fkdat_ana")
                 + f", netwr {_DEC}, kzwi1 {_DEC}"),
    "bseg": _ddl(_strings("vbeln", "belnr", "buzei", "vorgn", "kunnr", "zuonr", "augbl", "sgtxt", "h_blart", "shkzg",
                          "xragl", "fdtag", "augdt", "h_budat") + f", dmbtr {_DEC}, nebtr {_DEC}"),
    "prcd_elements": _ddl(_strings("knumv", "kposn", "kschl", "kinak", "zaehk") + f", kwert {_DEC}, kbetr {_DEC}"),
    "cdhdr": _ddl(_strings("objectid", "username", "udate", "utime")),
    "kna1": _ddl(_strings("kunnr", "stcd1", "stcd2", "name1", "name2", "name3", "ort01", "regio")),
    "zsdt0001": _ddl(_strings("vbeln", "posnr", "charg", "flag_dev")),
    "zsdt001": _ddl(_strings("vbeln", "posnr", "status_maq_cliente")),
    "tvfst": _ddl(_strings("faksp", "spras", "vtext")),
    "tvagt": _ddl(_strings("abgru", "spras", "bezei")),
    "t052u": _ddl(_strings("zterm", "spras", "text1")),
    "t042zt": _ddl(_strings("zlsch", "spras", "text2")),
    "tvzbt": _ddl(_strings("zterm", "spras", "vtext")),
    "tvakt": _ddl(_strings("auart", "spras", "bezei")),
    "cepct": _ddl(_strings("prctr", "ktext")),
    "t001w": _ddl(_strings("werks", "name1")),
    "anla": _ddl(_strings("anln1", "anln2", "herst", "gdlgrp", "txt50", "invnr", "typbz", "ord41", "ord42", "ord43",
                          "ord44", "aktiv", "deakt") + f", urwrt {_DEC}"),
    "anlc": _ddl(_strings("anln1", "afabe", "gjahr") + f", kansw {_DEC}, knafa {_DEC}, nafag {_DEC}, answl {_DEC}"),
    "v_equi": _ddl(_strings("equnr", "matnr", "baujj", "tplnr", "objnr") + ", datbi date"),
    "jcds": _ddl(_strings("objnr", "stat", "inact", "udate", "utime")),
    "tj30t": _ddl(_strings("estat", "stsma", "spras", "txt30", "txt04")),
    "iflos": _ddl(_strings("tplnr", "strno")),
    "t087t": _ddl(_strings("ord4x", "ordtx")),
    # manual dimensions
    "ztfi_prov_receita": _ddl("centro_lucro string, numero_contrato string, tipo_contrato string, nome_cliente string, "
                              f"data_inicio date, data_fim date, ordem string, total {_DEC}, prov_receita string"),
    "ztfi_tp_ctr_real": _ddl(_strings("codigo_cliente", "cnpj_cpf", "nome_cliente", "mercado_atual",
                                      "numero_contrato", "mercado_real")),
    "ztfi_clientes_tp_ctr": _ddl(_strings("codigo_cliente", "cnpj_cpf", "nome_cliente", "tipo_contrato")),
    "ztfi_mat_tp_cobranca": _ddl(_strings("nr_material", "descr_grupo_material", "especif_tecnica", "tipo_cobranca")),
    # upstream views consumed as inputs
    "fi_contrato_por_repres_fatur": _ddl(_strings("N. Contrato", "Tipo Contrato", "Resp. Faturamento",
                                                  "Lider Faturam.", "Consultor Faturam.")),
    "pm_documentos_medicao": _ddl(_strings("n_equipamento", "rank_doc_medicao", "descr_ponto_medicao")
                                  + f", valor_doc_medicao {_DEC}"),
}

# ISO date text columns parsed at ingest (sentinel '0000-00-00' -> NULL).
DATE_TEXT_COLUMNS: dict[str, list[str]] = {
    "vbak": ["erdat"],
    "veda": ["vuntdat", "vbegdat", "venddat", "vdemdat"],
    "fplt": ["nfdat", "fkdat"],
    "vbrk": ["erdat", "fkdat"],
    "vbrp": ["erdat", "fkdat_ana"],
    "bseg": ["fdtag", "augdt", "h_budat"],
    "anla": ["aktiv", "deakt"],
}

# Text keys trimmed at ingest so joins are plain equi joins (the asset view
# compares TRIM(a) = TRIM(b)).
TRIMMED_KEYS: dict[str, list[str]] = {
    "anla": ["anln1", "invnr"],
    "anlc": ["anln1"],
    "v_equi": ["equnr", "objnr", "tplnr"],
    "jcds": ["objnr", "stat"],
    "tj30t": ["estat", "stsma"],
    "iflos": ["tplnr"],
}
