"""Reporting views over small synthetic ERP tables, golden rows written by hand."""

import datetime as dt
from decimal import Decimal as D

from ledgerlens.plans.assets import assets
from ledgerlens.plans.contract_items import contract_item_status, contract_items
from ledgerlens.plans.receipts import receipts
from ledgerlens.plans.rental_invoices import rental_invoices
from ledgerlens.plans.used_sales import used_sales
from tests.fixtures import mk


def test_receipts_filters_and_tax_id(spark):
    bseg = mk(spark, "bseg", [
        dict(kunnr="C1", belnr="B1", h_blart="DZ", shkzg="H", xragl="", nebtr=D(10), augdt="2024-01-05",
             h_budat="2024-01-06"),
        dict(kunnr="C2", belnr="B2", h_blart="ZB", shkzg="H", xragl="", nebtr=D(5), augdt="bad", h_budat=None),
        dict(kunnr="C1", belnr="B3", h_blart="ZR", shkzg="S", xragl="", nebtr=D(10)),  # wrong side
        dict(kunnr="C1", belnr="B4", h_blart="DZ", shkzg="H", xragl="X", nebtr=D(10)),  # reversed
        dict(kunnr="C1", belnr="B5", h_blart="DZ", shkzg="H", xragl=None, nebtr=D(10)),  # NULL flag -> dropped
        dict(kunnr="C1", belnr="B6", h_blart="DZ", shkzg="H", xragl="", nebtr=D(0)),  # zero amount
        dict(kunnr="C1", belnr="B7", h_blart="XX", shkzg="H", xragl="", nebtr=D(10)),  # other type
    ])
    kna1 = mk(spark, "kna1", [dict(kunnr="C1", stcd1="", stcd2="P1", name1="Ana", name2=None, name3="Silva"),
                              dict(kunnr="C2", stcd1=None, stcd2="P2", name1="Beto", name2="", name3="")])
    out = {r["lancamento_contabil"]: r for r in receipts(bseg, kna1).collect()}
    assert set(out) == {"B1", "B2"}
    assert out["B1"]["CNPJ_CPF"] == "P1" and out["B1"]["nome_cliente"] == "Ana  Silva"
    assert out["B2"]["CNPJ_CPF"] is None  # '=' only: NULL company id stays NULL
    assert out["B2"]["nome_cliente"] == "Beto"
    assert out["B1"]["data_compensacao"] == dt.date(2024, 1, 5) and out["B2"]["data_compensacao"] is None


def test_rental_invoices(spark):
    vbrp = mk(spark, "vbrp", [
        dict(vbeln="F1", posnr="10", aubel="O1", pstyv="ZSIM", draft="", kunrg_ana="C1", prctr="ARM3", netwr=D(100)),
        dict(vbeln="F1", posnr="20", aubel="O1", pstyv="ZSIM", draft="X", kunrg_ana="C1", prctr="P1"),  # draft
        dict(vbeln="F2", posnr="10", aubel="O2", pstyv="ZDSR", draft="", kunrg_ana="C9", prctr="P1"),  # cancelled
        dict(vbeln="F3", posnr="10", aubel="O2", pstyv="ZVAT", draft="", kunrg_ana="C1", prctr="P1"),  # category
        dict(vbeln="F4", posnr="10", aubel="O3", pstyv="ZROB", draft="", kunrg_ana="C9", prctr="P1"),  # no header
        dict(vbeln="F5", posnr="10", aubel="O3", pstyv="ZREB", draft="", kunrg_ana="C9", prctr="P1"),
    ])
    vbrk = mk(spark, "vbrk", [dict(vbeln="F1", fkart="ZLOC", fksto="", xblnr="NF1", fkdat="2024-02-01"),
                              dict(vbeln="F2", fkart="S1", fksto=""),
                              dict(vbeln="F3", fkart="ZLOC", fksto=""),
                              dict(vbeln="F5", fkart="ZLOC", fksto="")])
    vbak = mk(spark, "vbak", [dict(vbeln="O1", vgbel="K1")])
    kna1 = mk(spark, "kna1", [dict(kunnr="C1", stcd1="S1", stcd2="P1", name1="A", name2="B", name3=None)])
    tvakt = mk(spark, "tvakt", [dict(auart="ZSIM", spras="P", bezei="Simples"), dict(auart="ZSIM", spras="E", bezei="x")])
    cepct = mk(spark, "cepct", [dict(prctr="P1", ktext="one"), dict(prctr="P1", ktext="two")])
    out = sorted(rental_invoices(vbrp, vbrk, vbak, kna1, tvakt, cepct).collect(), key=lambda r: (r["n_fat"], r["nome_centro_lucro"] or ""))
    from ledgerlens.functions.codes import DUMMY_PROFIT_CENTRE_NAME
    assert [(r["n_fat"], r["nome_centro_lucro"]) for r in out] == [("F1", DUMMY_PROFIT_CENTRE_NAME), ("F5", "one"),
                                                                     ("F5", "two")]
    f1 = out[0]
    assert (f1["tipo_nfs"], f1["n_contrato"], f1["CNPJ_CPF"], f1["Nome do Cliente"]) == ("Simples", "K1", "S1", "A B ")
    assert out[1]["Nome do Cliente"] == "  " and out[1]["Cód. Cliente"] is None


def _asset_tables(spark):
    anla = mk(spark, "anla", [
        dict(anln1="IM01 ", anln2="0000", herst=" ", invnr="CM02", urwrt=D(100), aktiv="2020-01-02", deakt="0000-00-00",
             ord41="B1", ord42="G1"),
        dict(anln1="CM02", anln2="0000", herst="H2", invnr=None, urwrt=D(50), aktiv="0000-00-00", deakt="2023-05-01"),
        dict(anln1="CM02", anln2="0001", herst="H2", urwrt=D(7)),  # sub-number, not main
        dict(anln1="PÇ03", anln2="0000", herst="H3", urwrt=D(1)),  # excluded prefix (non-ASCII)
        dict(anln1="VS04", anln2="0000", herst=None, urwrt=D(9), aktiv=None, deakt=None),
    ])
    anlc = mk(spark, "anlc", [
        dict(anln1="IM01", afabe="01", gjahr="2024", kansw=D(10), knafa=D(-2), nafag=D(-1), answl=D(0)),
        dict(anln1=" IM01", afabe="01", gjahr="2024", kansw=D(5), knafa=D(0), nafag=D(0), answl=D(1)),
        dict(anln1="CM02", afabe="01", gjahr="2024", kansw=D(20), knafa=None, nafag=D(0), answl=D(0)),  # all-NULL term
        dict(anln1="IM01", afabe="02", gjahr="2024", kansw=D(999), knafa=D(0), nafag=D(0), answl=D(0)),
        dict(anln1="IM01", afabe="01", gjahr="2023", kansw=D(999), knafa=D(0), nafag=D(0), answl=D(0)),
    ])
    v_equi = mk(spark, "v_equi", [dict(equnr="IM01", matnr="M1", baujj="2019", tplnr="L1", objnr="OB1",
                                       datbi=dt.date(9999, 12, 31))])
    jcds = mk(spark, "jcds", [
        dict(objnr="OB1", stat="E1", inact="", udate="2024-01-01", utime="10:00:00"),
        dict(objnr="OB1", stat="E2", inact="", udate="2024-03-01", utime="09:00:00"),
        dict(objnr="OB1", stat="E3", inact="X", udate="2024-05-01", utime="09:00:00"),  # inactive
        dict(objnr="OB1", stat="E4", inact=None, udate="2024-06-01", utime="09:00:00"),  # NULL inactive -> dropped
    ])
    tj30t = mk(spark, "tj30t", [dict(estat=e, stsma="ZPM_M_V", spras="P", txt30=f"status {e}", txt04=e)
                                for e in ("E1", "E2", "E3", "E4")])
    iflos = mk(spark, "iflos", [dict(tplnr="L1", strno="Patio 1")])
    t087t = mk(spark, "t087t", [dict(ord4x="B1", ordtx="BU one"), dict(ord4x="G1", ordtx="Group one")])
    return anla, anlc, v_equi, jcds, tj30t, iflos, t087t


def test_assets(spark):
    out = {r["numero_armac"]: r for r in assets(*_asset_tables(spark), as_of="2024-07-01").collect()}
    assert set(out) == {"IM01", "CM02", "VS04"}
    im = out["IM01"]
    assert im["chassi"] == "IM01"  # blank chassis on a fallback prefix -> asset number
    assert im["saldo_residual"] == D(13) and im["valor"] == D(150)  # implement CM02 -> composite value
    assert im["saldo_residual_implemento"] == D(0)  # CM02's sum has an all-NULL term -> NULL -> 0
    assert im["status_equipamento"] == "status E2" and im["local_instalacao"] == "Patio 1"
    assert im["bu"] == "BU one" and im["grupo"] == "Group one" and im["status_ativo"] == "Ativo"
    assert im["data_compra"] == dt.date(2020, 1, 2) and im["data_baixa"] is None
    cm = out["CM02"]
    assert cm["status_ativo"] == "Inativo" and cm["data_baixa"] == dt.date(2023, 5, 1) and cm["data_compra"] is None
    assert cm["valor"] == D(50) and cm["saldo_residual"] == D(0)
    assert out["VS04"]["chassi"] == "VS04"


def test_used_sales(spark):
    anla, anlc, v_equi, jcds, tj30t, iflos, t087t = _asset_tables(spark)
    fag = assets(anla, anlc, v_equi, jcds, tj30t, iflos, t087t, as_of="2024-07-01")
    vbrp = mk(spark, "vbrp", [
        dict(vbeln="F1", posnr="10", aubel="O1", pstyv="ZVAT", draft="", kunag_ana="C1", charg="IM01",
             knumv_ana="K1", kzwi1=D(1000), werks="W1", prctr="P1"),
        dict(vbeln="F2", posnr="10", aubel="O2", pstyv="ZDAT", draft="", kunag_ana="C1", charg="CM02",
             knumv_ana="K2", kzwi1=D(300)),
        dict(vbeln="F3", posnr="10", aubel="O3", pstyv="ZVAT", draft="", knumv_ana="K3", kzwi1=D(1)),  # cancelled
    ])
    vbrk = mk(spark, "vbrk", [dict(vbeln="F1", fkart="ZVEN", fksto="", xblnr="NF1", erdat="2024-02-03",
                                   fkdat="2024-02-10", zterm="Z1"),
                              dict(vbeln="F2", fkart="ZVEN", fksto="", fkdat="2024-03-15"),
                              dict(vbeln="F3", fkart="ZVEN", fksto="X")])
    kna1 = mk(spark, "kna1", [dict(kunnr="C1", stcd1="", stcd2="P1", name1="A")])
    tvzbt = mk(spark, "tvzbt", [dict(zterm="Z1", spras="P", vtext="30 dias")])
    t001w = mk(spark, "t001w", [dict(werks="W1", name1="Plant")])
    cepct = mk(spark, "cepct", [dict(prctr="P1", ktext="PC one")])
    bseg = mk(spark, "bseg", [dict(vbeln="F1", belnr="D1", vorgn="SD00", buzei="001"),
                              dict(vbeln="F1", belnr="D9", vorgn="SD00", buzei="002")])
    pdm = mk(spark, "pm_documentos_medicao", [
        dict(n_equipamento="IM01", rank_doc_medicao="1", descr_ponto_medicao="HORIMETRO ACUMULADO",
             valor_doc_medicao=D(1234)),
        dict(n_equipamento="IM01", rank_doc_medicao="2", descr_ponto_medicao="HORIMETRO ACUMULADO",
             valor_doc_medicao=D(1))])
    prcd = mk(spark, "prcd_elements", [dict(knumv="K1", kposn="10", kschl="ZPRJ", kwert=D(1100)),
                                       dict(knumv="K1", kposn="10", kschl="ZPRL", kwert=D(900)),
                                       dict(knumv="K1", kposn="10", kschl="ZPRL", kwert=D(50)),
                                       dict(knumv="K3", kposn="10", kschl="ZPRL", kwert=D(5))])
    vbpa = mk(spark, "vbpa", [dict(vbeln="O1", posnr="10", parvw="ZV", lifnr="S1")])
    but000 = mk(spark, "but000", [dict(partner="S1", name_org1=None, name_org2=None, name_first="Rui", name_last="Lima")])
    vbkd = mk(spark, "vbkd", [dict(vbeln="O1", posnr="000000", bstkd="REF1")])
    out = {r["N. Fatura SAP"]: r for r in used_sales(vbrp, vbrk, kna1, tvzbt, t001w, cepct, bseg, fag, pdm, prcd,
                                                      vbpa, but000, vbkd).collect()}
    assert set(out) == {"F1", "F2"}
    f1, f2 = out["F1"], out["F2"]
    assert (f1["Status"], f1["Valor Faturado"], f2["Status"], f2["Valor Faturado"]) == ("FATURADO", D(1000), "DEVOLVIDO", D(-300))
    assert f1["Preco c/ Juros"] == D(1100) and f1["Preco Liquido"] == D(950) and f2["Preco Liquido"] == D(0)
    assert f1["Mês Contábil"] == dt.date(2024, 2, 1) and f1["N. Doc Contabil"] == "D1"
    assert f1["Horimetro"] == D(1234) and f1["Vendedor"] == "Rui Lima" and f1["Referencia"] == "REF1"
    assert f1["Chassi"] == "IM01" and f2["Saldo Residual"] == D(0) and f1["Cond. Pagamento"] == "30 dias"


def _contract_tables(spark):
    vbap = mk(spark, "vbap", [
        dict(vbeln="0040000001", posnr="10", vbtyp_ana="G", auart_ana="ZVA", kunnr_ana="C1", matnr="M1",
             arktx="Escavadeira", charg="A1", knumv_ana="K1", abgru=None, zmeng=D(1)),
        dict(vbeln="0040000001", posnr="20", vbtyp_ana="G", auart_ana="ZVA", kunnr_ana="C1", matnr="M2",
             arktx="Taxa de MOBILIZACAO", charg=None, knumv_ana="K1"),
        dict(vbeln="0040000002", posnr="10", vbtyp_ana="G", auart_ana="ZLP", kunnr_ana="C1", matnr="M1",
             arktx="Seguro e avaria", charg="A2", knumv_ana="K2", abgru="01"),
        dict(vbeln="0000000003", posnr="10", vbtyp_ana="C", kunnr_ana="C1"),  # not a contract
        dict(vbeln="0040000002", posnr="20", vbtyp_ana="G", auart_ana="ZLP", kunnr_ana="C1", matnr="M1",
             arktx="Trator", charg="A9", knumv_ana="K2"),  # the one active item
    ])
    kna1 = mk(spark, "kna1", [dict(kunnr="C1", stcd1=None, stcd2="P1", name1="Cli", name2="", name3=None,
                                   ort01="Cidade", regio="SP")])
    vbak = mk(spark, "vbak", [dict(vbeln="0040000001", vbtyp="G", ernam="u1", erdat="2024-01-01", faksk="B1"),
                              dict(vbeln="0040000002", vbtyp="G", ernam="u2", erdat="2024-01-02")])
    vbkd = mk(spark, "vbkd", [dict(vbeln="0040000001", posnr="000000", kdgrp="ZG", zterm="T1", bstkd="R1"),
                              dict(vbeln="0040000002", posnr="000000", kdgrp="ZZ")])
    zsdt0001 = mk(spark, "zsdt0001", [dict(vbeln="0040000001", posnr="10", charg="A1", flag_dev="X")])
    cdhdr = mk(spark, "cdhdr", [dict(objectid="0040000001AB", username="ana", udate="2024-02-01", utime="08:00:00"),
                                dict(objectid="0040000001CD", username="bia", udate="2024-02-01", utime="09:00:00")])
    veda = mk(spark, "veda", [dict(vbeln="0040000001", vposn="000000", vbegdat="2024-01-01", venddat="2024-12-31",
                                   vabndat="2024-01-15"),
                              dict(vbeln="0040000001", vposn="20", vbegdat="2024-03-01"),
                              dict(vbeln="0040000002", vposn="000000", vbegdat="2024-01-01", venddat="2024-12-31")])
    tvfst = mk(spark, "tvfst", [dict(faksp="B1", spras="P", vtext="Bloqueado")])
    tvagt = mk(spark, "tvagt", [dict(abgru="01", spras="P", bezei="Recusa cliente")])
    t052u = mk(spark, "t052u", [dict(zterm="T1", spras="P", text1="30 dias")])
    t042zt = mk(spark, "t042zt", [])
    vbpa = mk(spark, "vbpa", [dict(vbeln="0040000001", posnr="000000", parvw="ZF", lifnr="R1"),
                              dict(vbeln="0040000001", posnr="000000", parvw="ZV", lifnr="V1")])
    but000 = mk(spark, "but000", [dict(partner="R1", name_org1="", name_org2=None, mc_name1="Souza", mc_name2="Ana"),
                                  dict(partner="V1", name_org1="Loja", name_org2="SA")])
    prcd = mk(spark, "prcd_elements", [dict(knumv="K1", kposn="10", kschl="PR00", kwert=D(3000)),
                                       dict(knumv="K1", kposn="10", kschl="ZEXQ", kwert=D(7)),
                                       dict(knumv="K1", kposn="10", kschl="XXXX", kwert=D(1))])
    ztcr = mk(spark, "ztfi_tp_ctr_real", [dict(numero_contrato="0040000002", mercado_real="SPOT - GRANDES CONTAS")])
    zmtc = mk(spark, "ztfi_mat_tp_cobranca", [dict(nr_material="M1", tipo_cobranca="Máquina")])
    zsdt001 = mk(spark, "zsdt001", [dict(vbeln="0040000001", posnr="10", status_maq_cliente="6")])
    return (vbap, kna1, vbak, vbkd, zsdt0001, cdhdr, veda, tvfst, tvagt, t052u, t042zt, vbpa, but000, prcd, ztcr,
            zmtc, zsdt001)


def test_contract_items_and_status(spark):
    items = contract_items(*_contract_tables(spark), extracted_at="2024-06-01 12:00:00")
    out = {(r["N. Contrato"], r["Item"]): r for r in items.collect()}
    assert set(out) == {("0040000001", "10"), ("0040000001", "20"), ("0040000002", "10"), ("0040000002", "20")}
    a, b, c = out[("0040000001", "10")], out[("0040000001", "20")], out[("0040000002", "10")]
    assert a["Tipo Cobranca"] == "Máquina" and b["Tipo Cobranca"] == "Fretes" and c["Tipo Cobranca"] == "Avarias"
    assert a["Status Ativo UCA"] == "Devolvido" and b["Status Ativo UCA"] == "Não Encontrado"
    assert a["Status_Cocpit"] == "Em Clientes" and b["Status_Cocpit"] is None
    assert a["Preco"] == D(3000) and a["Qtd. Hr Exced"] == D(7) and a["R$ Total Hr Exced"] == D(7)
    assert a["Preço Bruto"] is None and b["Preco"] == D(0)
    assert a["Tipo Contrato"] == "SPOT - VAREJO" and c["Tipo Contrato"] == "SPOT - GRANDES CONTAS"
    assert a["Vetor"] == "Mineração" and c["Vetor"] == ""
    assert a["CNPJ_CPF"] == "P1" and a["Nome Cliente"] == "Cli"
    assert a["Representante Faturamento"] == "Ana Souza" and a["Vendedor"] == "Loja SA"
    assert a["Lider Faturamento"] == " "  # no partner row: CONCAT of NULLs is ' '
    assert a["Data_Hora Modificacao"] == "2024-02-01 09:00:00" and a["Usuário Modificacao"] == "bia"
    assert a["Data Inicio Item"] == dt.date(2024, 1, 1) and b["Data Inicio Item"] == dt.date(2024, 3, 1)
    assert a["Dia Fat."] == "15" and a["Bloq. Doc. Faturamento"] == "Bloqueado" and c["Motivo de Recusa"] == "Recusa cliente"
    st = {(r["N. Contrato"], r["Item"]): r["Status_Item"] for r in contract_item_status(items, as_of="2024-06-01").collect()}
    # blocked header / freight item / refused item are inactive; the unblocked machine with a serial is active
    assert st == {("0040000001", "10"): "Inativo", ("0040000001", "20"): "Inativo", ("0040000002", "10"): "Inativo",
                  ("0040000002", "20"): "Ativo"}


def test_priced_flow_golden_rows(spark):
    from ledgerlens.plans.priced_flow import priced_flow
    d = dt.date
    cols = ("`N. Ordem` string, `Tipo de Material` string, `Status Ordem` string, Ini_Prog_Linha date, "
            "Fim_Prog_Linha date, Ini_Prog_Cabe date, Fim_Prog_Cabe date, Preco double, Seguro double, "
            "Frete double, Avaria double, Desconto double, Total_H_Var double, Total_H_Extra double, "
            "Total_H_Exc double, Bloqueio string, Recusa string, `Doc. Contabil Dev.` string")
    data = [
        ("r1", "Máquina", "BM PENDENTE", d(2024, 1, 5), d(2024, 1, 31), d(2024, 1, 1), d(2024, 1, 31),
         300.0, 10.0, 5.0, 0.0, -4.0, 3.0, 0.0, 2.0, None, None, None),
        ("r2", "Implementos", "FATURADO", d(2024, 2, 1), d(2024, 2, 29), d(2024, 2, 1), d(2024, 2, 29),
         100.0, -2.0, -7.0, None, 1.0, 0.0, 0.0, 0.0, "B1", None, None),
        ("r3", "Seguro", "BM PENDENTE", None, d(2024, 3, 31), d(2024, 3, 1), d(2024, 3, 31),
         60.0, 15.0, 0.0, -1.0, 0.0, -1.0, 4.0, None, None, None, "D9"),
        ("r4", "Avarias", "FAT. PENDENTE", d(2024, 1, 1), d(2024, 1, 31), d(2024, 1, 1), d(2024, 1, 31),
         50.0, None, None, 0.0, -3.0, 0.0, 0.0, 0.0, None, None, None),
        ("r5", "Fretes", "BM PENDENTE", d(2024, 1, 1), d(2024, 1, 10), d(2024, 1, 1), d(2024, 1, 31),
         -20.0, 0.0, 8.0, 0.0, 2.0, 0.0, 0.0, 1.0, None, None, None),
    ]
    out = {r["N. Ordem"]: r for r in priced_flow(spark.createDataFrame(data, cols)).collect()}
    r1, r2, r3, r4, r5 = (out[k] for k in ("r1", "r2", "r3", "r4", "r5"))
    assert (r1["Dias Utilização"], r1["Tipo Cobrança"], r1["Freq. Cobrança"]) == (27, "Proporcional Mobilização", "Recorrente")
    assert (r1["Locação"], r1["Seguro"], r1["Desconto"], r1["Outros"], r1["Preço Final"]) == (270.0, 9.0, -4.0, 3.0, 285.0)
    assert (r2["Tipo Cobrança"], r2["Locação"], r2["Seguro"], r2["Frete"], r2["Avaria"]) == ("Integral", 100.0, 0.0, 0.0, None)
    assert (r2["Desconto"], r2["Outros"], r2["Bloq. Geral"], r2["Preço Final"]) == (-6.0, 1.0, "Sim", 0.0)
    assert (r3["Dias Utilização"], r3["Tipo Cobrança"], r3["Seguro"], r3["Avaria"]) == (0, "Integral", 75.0, 0.0)
    assert (r3["Outros"], r3["Devolução"], r3["Preço Final"]) == (4.0, "Sim", 79.0)
    assert (r4["Freq. Cobrança"], r4["Avaria"], r4["Seguro"], r4["Frete"], r4["Desconto"]) == ("Única", 50.0, 0.0, None, -3.0)
    assert r4["Preço Final"] == 47.0
    assert (r5["Frete"], r5["Desconto"], r5["Outros"], r5["Preço Final"]) == (-12.0, -18.0, 2.0, -27.0)
