"""V3 — fixed-asset register: residual value, attached implement, latest equipment status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import codes as K
from ledgerlens.functions import rules
from ledgerlens.functions.dates import is_real_date_text, parse_date_sentinel, year_text
from ledgerlens.functions.text import prefix_not_in
from ledgerlens.operators import desc_nulls_first, latest_per_key, lookup_join, sum_of_sums


def residual_values(anlc: DataFrame, as_of=None) -> DataFrame:
    """Per trimmed asset number: sum of the four yearly value columns (area 01, run year).

    ``SUM(a)+SUM(b)+SUM(c)+SUM(d)``: NULL when any of the four is NULL for the
    whole asset. The asset and the implement lookups read the same result.
    """
    year = year_text(as_of) if as_of is not None else F.date_format(F.current_date(), "yyyy")
    vals = anlc.filter((F.col("afabe") == K.ASSET_VALUE_AREA) & (F.col("gjahr") == year)) \
        .withColumn("anln1", F.trim("anln1"))
    return sum_of_sums(vals, ["anln1"], ["kansw", "knafa", "nafag", "answl"], "saldo_residual")


def latest_equipment_status(v_equi: DataFrame, jcds: DataFrame, tj30t: DataFrame) -> DataFrame:
    """Latest active status per equipment (date, time, validity end — newest first, NULL first).

    The status and text joins are written as inner: the WHERE tests on their
    columns reject the rows a left join would add. Ties on the three order
    keys are broken by the status code and text so reruns agree.
    """
    st = jcds.filter(F.col("inact") != K.INACTIVE_FLAG).select(
        F.trim("objnr").alias("s_objnr"), F.trim("stat").alias("s_stat"), "udate", "utime")
    tx = tj30t.filter((F.col("spras") == K.TEXT_LANGUAGE) & (F.trim("stsma") == K.EQUIPMENT_STATUS_PROFILE)).select(
        F.trim("estat").alias("t_estat"), F.col("txt30").alias("status_equipamento"), F.col("txt04").alias("cod_status"))
    eq = v_equi.select("equnr", "matnr", "baujj", "tplnr", "objnr", "datbi", F.trim("objnr").alias("e_objnr"),
                       F.trim("equnr").alias("equnr_key"))
    j = eq.join(st, eq["e_objnr"] == st["s_objnr"], "inner").join(tx, F.col("s_stat") == tx["t_estat"], "inner")
    order = [desc_nulls_first("udate"), desc_nulls_first("utime"), desc_nulls_first("datbi"),
             F.col("cod_status").asc_nulls_last(), F.col("status_equipamento").asc_nulls_last(),
             F.col("tplnr").asc_nulls_last(), F.col("matnr").asc_nulls_last(), F.col("baujj").asc_nulls_last()]
    last = latest_per_key(j, ["equnr_key"], order)
    return last.select("equnr_key", "matnr", "baujj", "tplnr", "status_equipamento", "cod_status",
                       F.col("udate").alias("dt_modificacao"), F.col("utime").alias("hr_modificacao"))


def only_serials(serials: DataFrame, anla: DataFrame, v_equi: DataFrame, jcds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The asset, equipment and status rows that the register rows of ``serials`` (one column) are made of.

    Semi joins on what the register joins on: the asset and its attached implement, the
    equipment, its status history. Every other input hangs on these.
    """
    s = serials.select(F.trim(serials.columns[0]).alias("__serial")).distinct()
    main = anla.join(s, F.trim(anla["anln1"]) == s["__serial"], "left_semi")
    attached = main.select(F.trim("invnr").alias("__serial"))
    both = s.unionByName(attached).distinct()
    machines = anla.join(both, F.trim(anla["anln1"]) == both["__serial"], "left_semi")
    equipment = v_equi.join(s, F.trim(v_equi["equnr"]) == s["__serial"], "left_semi")
    objects = equipment.select(F.trim("objnr").alias("__object")).distinct()
    return machines, equipment, jcds.join(objects, F.trim(jcds["objnr"]) == objects["__object"], "left_semi")


def assets(anla: DataFrame, anlc: DataFrame, v_equi: DataFrame, jcds: DataFrame, tj30t: DataFrame,
           iflos: DataFrame, t087t: DataFrame, as_of=None, serials: DataFrame | None = None) -> DataFrame:
    """V3. With ``serials`` (one column) only the register rows of these machines, and only they are ranked."""
    if serials is not None:
        anla, v_equi, jcds = only_serials(serials, anla, v_equi, jcds)
        asked = serials.select(F.trim(serials.columns[0]).alias("__asked")).distinct()
        return assets(anla, anlc, v_equi, jcds, tj30t, iflos, t087t, as_of).join(
            asked, F.col("numero_armac") == F.col("__asked"), "left_semi")
    main = anla.filter((F.col("anln2") == K.MAIN_ASSET_SUBNUMBER)
                       & prefix_not_in("anln1", 2, K.ASSET_EXCLUDED_PREFIXES))
    main = main.withColumn("k_anln1", F.trim("anln1")).withColumn("k_invnr", F.trim("invnr"))
    calc = residual_values(anlc, as_of)
    j = main.join(calc.select(F.col("anln1").alias("c_anln1"), F.col("saldo_residual").alias("c_saldo")),
                  F.col("k_anln1") == F.col("c_anln1"), "left")
    implement = anla.filter(F.col("anln2") == K.MAIN_ASSET_SUBNUMBER).select(
        F.trim("anln1").alias("i_anln1"), F.col("urwrt").alias("i_urwrt"))
    j = j.join(implement, F.col("k_invnr") == F.col("i_anln1"), "left")
    j = j.join(calc.select(F.col("anln1").alias("ci_anln1"), F.col("saldo_residual").alias("ci_saldo")),
               F.col("k_invnr") == F.col("ci_anln1"), "left")
    stt = latest_equipment_status(v_equi, jcds, tj30t)
    j = j.join(stt, F.col("k_anln1") == stt["equnr_key"], "left")
    loc = iflos.select(F.trim("tplnr").alias("l_tplnr"), "strno")
    j = j.join(loc, F.trim(F.col("tplnr")) == F.col("l_tplnr"), "left")
    # evaluation-group texts are joined without a language key (four roles)
    for src, out in (("ord41", "bu"), ("ord42", "grupo"), ("ord44", "tipo"), ("ord43", "marca")):
        j = lookup_join(j, t087t, on=[(src, "ord4x")], select={out: "ordtx"})
    return j.select(
        F.col("k_anln1").alias("numero_armac"),
        rules.chassis_fallback("anln1", "herst").alias("chassi"),
        F.col("matnr").alias("material"), "bu", "grupo", "tipo", "marca",
        F.col("gdlgrp").alias("modelo"), F.col("baujj").alias("ano_fabricacao"), F.col("txt50").alias("nome_item"),
        F.col("invnr").alias("implemento"), F.col("typbz").alias("nfe_compra"),
        parse_date_sentinel("aktiv").alias("data_compra"),
        rules.composite_value("anln1", "invnr", "urwrt", "i_urwrt").alias("valor"),
        F.col("urwrt").alias("valor_aquisicao"),
        F.coalesce("c_saldo", F.lit(0)).alias("saldo_residual"),
        F.coalesce("i_urwrt", F.lit(0)).alias("valor_aquisicao_implemento"),
        F.coalesce("ci_saldo", F.lit(0)).alias("saldo_residual_implemento"),
        parse_date_sentinel("deakt").alias("data_baixa"),
        F.when(is_real_date_text("deakt"), F.lit(K.ITEM_INACTIVE)).otherwise(F.lit(K.ITEM_ACTIVE)).alias("status_ativo"),
        F.col("strno").alias("local_instalacao"), "cod_status", "status_equipamento",
    ).distinct()
