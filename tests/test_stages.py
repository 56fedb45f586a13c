"""Stage graph, audits by observe, quarantine, null-preserving top-1, serials pushed into the register."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.dates import parse_date, parse_iso_date
from ledgerlens.operators import dedupe_keep_null
from ledgerlens.operators.audit import FanoutAudit
from ledgerlens.plans.assets import assets
from ledgerlens.plans.catalog import QUERIES, views
from ledgerlens.plans.stages import Relation, StageGraph, resolve
from ledgerlens.sources import quarantine
from ledgerlens.sources.driver_erp import RUN_DATE, erp_tables
from tests.conftest import SMOKE, rows


def graph(spark, tmp_path, run="2025-01-01", **how):
    out = StageGraph(spark, SMOKE, ["nation"], run, **how)
    out.root = f"file://{tmp_path}/stages"
    out.folder = f"{out.root}/{out.folder.rsplit('/', 1)[1]}"
    return out


def test_relations_read_twice_are_shared_once(spark):
    built, shared = [], []

    def build(name, n):
        def run(*inputs):
            built.append(name)
            return inputs[0].withColumn(name, F.lit(n))
        return run

    relations = [Relation("b", ["a"], build("b", 1)), Relation("c", ["b"], build("c", 2)), Relation("d", ["b"], build("d", 3)),
                 Relation("e", ["c", "d"], lambda x, y: x.join(y, "id")), Relation("unused", ["a"], build("unused", 4))]
    out = resolve(relations, {"a": spark.range(3)}, "e", lambda df, name: shared.append(name) or df)
    assert out.count() == 3 and built == ["b", "c", "d"] and shared == ["b"]
    with pytest.raises(KeyError):
        resolve(relations, {}, "e")
    with pytest.raises(ValueError, match="read each other"):
        resolve([Relation("x", ["y"], lambda y: y), Relation("y", ["x"], lambda x: x)], {}, "x")


def test_a_stage_is_written_once_and_never_replaced(spark, tmp_path):
    g = graph(spark, tmp_path)
    first = g.share(spark.range(5), "s")
    again = graph(spark, tmp_path).share(spark.range(9), "s")  # published already: what is given now is not run
    assert first.count() == again.count() == 5
    other = graph(spark, tmp_path, run="2025-01-02").share(spark.range(9), "s")
    assert other.count() == 9 and first.count() == 5
    g.release()
    assert graph(spark, tmp_path).share(spark.range(2), "s").count() == 2


def test_two_writers_publish_one_stage(spark, tmp_path):
    graphs = [graph(spark, tmp_path) for _ in range(3)]
    got = [None] * 3
    gate = threading.Barrier(3)
    for g in graphs:  # all see it missing, then all write
        g._published = lambda final, own=g, seen=[]: seen.append(final) or (gate.wait(timeout=60) and False if len(seen) == 1 else StageGraph._published(own, final))

    def run(i):
        got[i] = sorted(r["id"] for r in graphs[i].share(spark.range(4), "s").collect())

    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert got == [[0, 1, 2, 3]] * 3
    assert [p.name for p in (tmp_path / "stages").glob("*/*") if not p.name.startswith((".", "_"))] == ["s"]


def test_stages_nobody_uses_are_removed(spark, tmp_path):
    old = graph(spark, tmp_path, run="2024-01-01")
    old.share(spark.range(1), "s")
    graph(spark, tmp_path).share(spark.range(1), "s")
    assert len(list((tmp_path / "stages").iterdir())) == 2
    graph(spark, tmp_path, run="2025-01-03", keep_hours=-1).share(spark.range(1), "s")
    assert len(list((tmp_path / "stages").iterdir())) == 1


SCANS = {"rental_invoices": 0, "contract_items": 0, "used_sales": 0, "contract_status": 0}


@pytest.mark.parametrize("key", sorted(SCANS))
def test_views_read_the_order_lines_from_their_stage(spark, key):
    """``lineitem`` itself is read when the stage is written, by no view's plan; the stage is the only thing written."""
    plan = QUERIES[key](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") > 0
    files = QUERIES[key](spark, SMOKE).inputFiles()
    assert not any("lineitem" in f for f in files) and any("/stages/" in f and "/lines/" in f for f in files)


def test_dedupe_of_a_stored_table_limits_groups_and_leaves_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [("a", 2), ("a", 1), (None, 1), (None, 1), (None, 3), ("b", 5)]
    spark.createDataFrame(data, "k string, v int").write.parquet(path)
    out = dedupe_keep_null(spark.read.parquet(path), "k", [F.col("v").asc()], stored=True)
    plan = out._jdf.queryExecution().executedPlan().toString()  # before it runs: one plan, not the first and the final one
    assert rows(out) == [(None, 1), (None, 1), (None, 3), ("a", 1), ("b", 5)]
    assert plan.count("WindowGroupLimit") >= 2 and plan.count("Exchange hash") == 1  # rows without a key meet no exchange


@pytest.mark.parametrize("key", ["period_minmax", "wide_group"])
def test_periods_are_hash_aggregates(spark, key):
    plan = QUERIES[key](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_fanout_is_reported_by_the_query_itself(spark):
    audit = FanoutAudit()
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, code string")
    unique = spark.createDataFrame([("a", "A", "P"), ("a", "X", "E"), ("b", "B", "P")], "code string, text string, spras string")
    twice = spark.createDataFrame([("a", "1"), ("a", "2"), ("z", "3")], "code string, other string")
    j = audit.lookup("text", facts, unique, on=[("code", "code")], select={"text": "text"}, lang="P")
    j = audit.lookup("other", j, twice, on=[("code", "code")], select={"other": "other"})
    assert len(j.collect()) == 4
    assert audit.rows() == [("text", 3, 3, 2, 2), ("other", 3, 4, 3, 2)] and audit.fanned_out() == ["other"]
    assert audit.report(spark).columns == ["lookup", "rows_before", "rows_after", "dim_rows", "dim_keys"]


def test_quarantine_takes_rows_that_do_not_parse(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "2024-01-31", "1.5"), (2, "2024-02-30", "x"), (3, "0000-00-00", ""), (4, None, "7"), (5, " 2024-03-01 ", "1,5")],
                               "id int, d string, v string")
    kinds = {"d": "date", "v": "decimal(18,2)"}
    counts = quarantine.ingest(df, kinds, path, "r1")
    assert counts == (5, 2, {"d": 1, "v": 2})
    quarantine.ingest(df.limit(0), kinds, path, "r0")
    quarantine.ingest(df, kinds, path, "r1")  # a rerun replaces its own run
    clean = quarantine.clean_rows(spark, path, "r1")
    assert [(r["id"], str(r["d"]), r["v"] and float(r["v"])) for r in clean.orderBy("id").collect()] == [
        (1, "2024-01-31", 1.5), (3, "None", None), (4, "None", 7.0)]
    assert sorted((r["id"], r["column"], r["text"]) for r in quarantine.quarantined_rows(spark, path, "r1").collect()) == [
        (2, "d", "2024-02-30"), (2, "v", "x"), (5, "v", "1,5")]
    assert clean.dtypes == [("id", "int"), ("d", "date"), ("v", "decimal(18,2)")]


def test_quarantine_parses_each_text_once(spark):
    df = spark.createDataFrame([(1, "2024-01-31", "1.5")], "id int, d string, v string")
    out = quarantine.parse_columns(df, {"d": "date", "v": "decimal(18,2)"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 1 and plan.count("as decimal(18,2))") == 1


def test_quarantine_is_written_without_a_sort(spark, tmp_path):
    """The side of a row is known when it is written: no task sorts its rows by it. The session keeps its own setting."""
    df = spark.range(40).select("id", F.when(F.col("id") % 4 == 0, F.lit("bad")).otherwise(F.lit("2024-01-31")).alias("d"))
    seen, conf = [], "spark.sql.maxConcurrentOutputFileWriters"
    write = type(df.write).parquet

    def spy(self, *args, **kw):
        seen.append(int(spark.conf.get(conf)))
        return write(self, *args, **kw)

    before = spark.conf.get(conf)
    type(df.write).parquet = spy
    try:
        assert quarantine.ingest(df, {"d": "date"}, str(tmp_path / "in"), "r") == (40, 10, {"d": 10})
    finally:
        type(df.write).parquet = write
    assert seen and seen[0] >= 2 and spark.conf.get(conf) == before


def test_iso_dates_are_the_formatter_s(spark):
    texts = ["2024-01-01", "2024-02-30", "2024-02-29", "2023-02-29", "2024-2-3", "bad-date", "0000-00-00", "0000-01-01", "0001-01-01", "+12024-01-01",
             "12024-01-01", "-0001-01-01", "-2024-01-01", "+2024-01-01", "2024-01-01 ", " 2024-01-01", "2024-01-01T00:00", "2024/01/01", "20240101",
             "", None, "9999-12-31", "1582-10-10", "1500-02-29", "2024-13-01", "2024-00-10", "٢٠٢٤-٠١-٠١", "2024-01-0x", "2024-01-01\n", "99999-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse_date("t").cast("string").alias("a"), parse_iso_date(F.col("t")).cast("string").alias("b")).collect()
    assert [(r.t, r.a) for r in got] == [(r.t, r.b) for r in got] and sum(r.a is not None for r in got) > 5


def test_register_of_asked_serials_equals_the_filtered_register(spark):
    t = erp_tables(spark, SMOKE)
    parts = [t[x] for x in ("anla", "anlc", "v_equi", "jcds", "tj30t", "iflos", "t087t")]
    whole = assets(*parts, as_of=RUN_DATE)
    asked = whole.select("numero_armac").orderBy("numero_armac").limit(3)
    asked = spark.createDataFrame(asked.collect() + [("nothing",)], "charg string")
    want = rows(whole.join(asked, F.col("numero_armac") == F.col("charg"), "left_semi"))
    out = assets(*parts, as_of=RUN_DATE, serials=asked)
    assert rows(out) == want and want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("Window "):]
    assert "LeftSemi" in ranked  # the status history is cut before it is ranked


def test_contract_items_join_partners_once(spark):
    """Role map: the partner table is read once for all three roles, the name table once."""
    t = erp_tables(spark, SMOKE)
    plan = views._contract_items(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("mc_name1") > 0
    partners = [x for x in plan.splitlines() if "parvw" in x and "Filter" in x]
    assert len(partners) <= 2 and t["vbpa"].filter("parvw = 'ZV'").count() > 0


def test_partner_roles_fan_out_like_three_joins(spark):
    from ledgerlens.plans.contract_items import _ROLES, partner_roles
    vbpa = spark.createDataFrame([("c1", "ZF", "p1"), ("c1", "ZV", "p1"), ("c1", "ZV", "p2"), ("c1", "ZV", "none"), ("c2", "ES", "p2"), ("c9", "ZF", "p1"),
                                  ("c1", "XX", "p1")], "vbeln string, parvw string, lifnr string")
    names = spark.createDataFrame([("p1", "o1"), ("p2", "o2"), ("p2", "o2b")], "partner string, name_org1 string")
    for n in ("name_org2", "name_first", "name_last", "mc_name1", "mc_name2"):
        names = names.withColumn(n, F.lit(None).cast("string"))
    docs = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "vbeln string")
    j = docs.join(partner_roles(vbpa, names, docs), F.col("vbeln") == F.col("p_vbeln"), "left")
    for _, tag in _ROLES:
        j = j.select(*[x for x in j.columns if x != tag], F.explode_outer(tag).alias(tag))
    got = j.select("vbeln", *[F.col(f"{tag}.name_org1").alias(tag) for _, tag in _ROLES])
    want = docs
    for role, tag in _ROLES:
        p = vbpa.filter(F.col("parvw") == role).select(F.col("vbeln").alias("v"), F.col("lifnr").alias(f"{tag}_id"))
        b = names.select(F.col("partner").alias("q"), F.col("name_org1").alias(tag))
        want = want.join(p, F.col("vbeln") == F.col("v"), "left").drop("v").join(b, F.col(f"{tag}_id") == F.col("q"), "left").drop("q", f"{tag}_id")
    assert rows(got) == rows(want) and got.count() > 4


def test_every_rule_of_the_derived_tables_fires(spark):
    """No column that a rule fills is the same on every row of the views over the driver tables."""
    items = QUERIES["contract_items"](spark, SMOKE)
    varied = ["Tipo Cobranca", "Status Ativo UCA", "Motivo de Recusa", "Status_Cocpit", "Franquia", "Vlr. Hr Exced", "Vlr. Hr Variavel", "Desconto",
              "Tipo Contrato", "Vetor", "Representante Faturamento", "Lider Faturamento", "Vendedor", "Data Desmont. Item", "Bloq. Doc. Faturamento"]
    sales = QUERIES["used_sales"](spark, SMOKE)
    varied_sales = ["Status", "Preco c/ Juros", "Preco Liquido", "Vendedor", "Referencia", "Horimetro"]
    for df, cols in ((items, varied), (sales, varied_sales)):
        counts = df.agg(*[F.count_distinct(F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("-"))).alias(str(i)) for i, x in enumerate(cols)]).collect()[0]
        assert [x for i, x in enumerate(cols) if counts[str(i)] < 2] == []
