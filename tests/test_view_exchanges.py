"""What the views move between tasks: disk at size is their exchanges."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import lookup_join
from ledgerlens.operators.audit import FanoutAudit
from ledgerlens.plans.catalog import views
from ledgerlens.plans.used_sales import used_sales
from ledgerlens.sources.driver_erp import erp_tables
from tests.conftest import SMOKE, rows


@pytest.fixture
def shuffled(spark):
    """No join is a broadcast, as with large tables."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]


def test_used_sales_exchanges_its_rows_once_a_key(spark, shuffled):
    t = erp_tables(spark, SMOKE)
    register = spark.createDataFrame([], "numero_armac string, chassi string, implemento string, bu string, grupo string, tipo string, marca string, "
                                         "modelo string, ano_fabricacao string, valor_aquisicao double, saldo_residual double, "
                                         "valor_aquisicao_implemento double, saldo_residual_implemento double")
    df = used_sales(t["vbrp"], t["vbrk"], t["kna1"], t["tvzbt"], t["t001w"], t["cepct"], t["bseg"], register, t["pm_documentos_medicao"],
                    t["prcd_elements"], t["vbpa"], t["but000"], t["vbkd"])
    found = exchanges(df)
    assert len(found) <= 85, len(found)


def test_contract_conditions_are_pivoted_before_they_move(spark):
    plan = views._contract_items(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join LeftSemi" in line and "knumv" in line]


def test_contract_items_do_not_move_for_the_machine_or_with_their_headers(spark, shuffled):
    plan = views._contract_items(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not [line for line in moved if "charg" in line]
    # the one join of items and headers is the topmost: no exchange of the items holds a header column
    top = next(line for line in plan.splitlines() if "Join" in line)
    assert "vbeln" in top and "h_vbeln" in top


def test_a_residual_key_gives_the_rows_of_an_equal_key(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), (None, 1), ("b", 1)], "k string, m int")
    dim = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("a", None, "n"), (None, 1, "n"), ("b", 3, "w")], "k string, m int, t string")
    on = [("k", "k"), ("m", "m")]
    got = lookup_join(facts, dim, on, {"t": "t"}, residual=["m"])
    assert rows(got) == rows(lookup_join(facts, dim, on, {"t": "t"})) and got.count() == 6


def test_the_audit_counts_the_same_with_written_headers(spark, tmp_path):
    def run(stage):
        audit = FanoutAudit()
        df = views._contract_items(spark, SMOKE, audit=audit, with_plan=True, stage=stage)
        return rows(df.drop("Data/hora Extração")), audit.rows()

    def written(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    assert run(written) == run(None)


def test_invoice_kinds_are_told_before_texts_are_made(spark):
    vbrp = erp_tables(spark, SMOKE)["vbrp"]
    plan = vbrp.filter("pstyv = 'ZDAT'").select("vbeln", "netwr")._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan and "named_struct" not in plan
    assert vbrp.filter("pstyv = 'ZDAT'").count() > 0


def test_written_lines_hold_no_id_text(spark):
    lines = erp_tables(spark, SMOKE)._lines
    assert len(set(lines.columns)) == len(lines.columns)
    assert not {"line_id", "p_partkey", "s_suppkey", "o_orderkey"} & set(lines.columns)
