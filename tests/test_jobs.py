import datetime as dt
import os
import re
import tempfile

import pytest

from lakestrata.plans import analytics as qa
from lakestrata.plans import catalog, jobs
from lakestrata.plans.frames import Layers, PublishedLayers
from lakestrata.sources import layers as io
from lakestrata.sources.adapter import raw_tables
from lakestrata.sources.landing import NoLandingPartitionError

from small_data import SMALL_SF


@pytest.fixture(scope="module")
def landing_root(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="lakestrata-test-landing-"), "landing")
    jobs.land_tables(raw_tables(spark, SMALL_SF), root, "2024-01-01", max_parallel=3)
    return root


@pytest.fixture()
def landed(landing_root, scratch):
    """The shared (read-only) landing drop and a fresh lake per test."""
    return jobs.LakePaths(landing_root, os.path.join(scratch, "lake"))


def test_end_to_end_and_stable_checksums(spark, landed, monkeypatch):
    out1 = jobs.run_all(spark, landed, run_ts=dt.datetime(2024, 1, 2), max_parallel=3, log=None)
    assert all(o.passed and o.published for v in out1.values() for o in v)
    assert sum(len(v) for v in out1.values()) == 25
    # analytics over the published lake equal the ones derived directly from the driver tables
    pub, der = PublishedLayers(spark, landed.lake), Layers(spark, SMALL_SF)
    a = qa.revenue_by_state(pub.order_totals(), pub.gold("dim_cliente"), k=None)
    b = qa.revenue_by_state(der.order_totals(), der.gold("dim_cliente"), k=None)
    assert sorted(a.collect()) == sorted(b.collect())
    fact = io.read_layer(spark, landed.lake, "gold", "fato_pedidos_itens")
    assert "dt_criacao_gold" in fact.columns
    assert fact.count() == io.read_layer(spark, landed.lake, "silver", "items").count()
    # the dated facts are published by month; a filter on the month column prunes directories
    fact_dir = io.version_path(landed.lake, "gold", "fato_pedidos_itens", io.current_version(spark, landed.lake, "gold", "fato_pedidos_itens"))
    assert any(d.startswith("data_pedido_mes=") for d in os.listdir(fact_dir))
    assert dict(fact.dtypes)["data_pedido"] == "date" and dict(fact.dtypes)["data_pedido_mes"] == "date"
    assert fact.where("data_pedido_mes <> trunc(data_pedido, 'month')").count() == 0
    plan = fact.where("data_pedido_mes >= DATE'1995-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*data_pedido_mes", plan), plan
    window = pub.gold_between("fato_pedidos_itens", "1995-03-10", "1995-06-20")
    wplan = window._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*data_pedido_mes", wplan), wplan
    assert window.count() == fact.where("data_pedido BETWEEN DATE'1995-03-10' AND DATE'1995-06-20'").count() > 0
    p = qa.revenue_by_period(pub.gold("fato_pedidos_itens"), pub.gold("dim_tempo"))
    d = qa.revenue_by_period(der.gold("fato_pedidos_itens"), der.gold("dim_tempo"))
    assert sorted(p.collect()) == sorted(d.collect())
    reviews = pub.gold("fato_avaliacoes")
    assert reviews.count() == der.gold("fato_avaliacoes").count()
    assert dict(reviews.dtypes)["data_avaliacao"] == "date"
    # every business query gives the same rows over the published lake (CSV round trip, stamps, monthly
    # layout column) as over the frames derived straight from the driver tables
    derived = {k: sorted(q(spark, SMALL_SF).collect(), key=str) for k, q in catalog.QUERIES.items() if k.startswith("q_")}
    for module in (catalog, catalog.catalog_time):
        monkeypatch.setattr(module, "Layers", lambda sp, _sf: PublishedLayers(sp, landed.lake))
    for k, rows in derived.items():
        assert sorted(catalog.QUERIES[k](spark, SMALL_SF).collect(), key=str) == rows, k
    monkeypatch.undo()
    jobs.run_all(spark, landed, run_ts=dt.datetime(2024, 1, 3), log=None)
    cmp = io.compare_runs(io.read_audit(spark, landed.lake)).where("previous_checksum IS NOT NULL")
    assert cmp.count() == 25 and cmp.where("NOT unchanged").count() == 0


def test_failed_checks_block_publish_and_are_audited(spark, landed):
    jobs.run_layer(spark, landed, "bronze", log=None)
    # corrupt the bronze orders: a duplicated order id must fail silver's unique check
    bronze_orders = io.read_layer(spark, landed.lake, "bronze", "orders")
    dup = bronze_orders.unionByName(bronze_orders.limit(1))
    out = jobs.stage_validate_publish(spark, landed, "bronze", "orders", dup, "bad-run", log=None)
    assert out.passed  # bronze only checks the row count
    res = jobs.silver_job(spark, landed, "orders", run_id="silver-bad", log=None)
    assert not res.passed and not res.published
    assert [f.check for f in res.failures] == ["unique:order_id"]
    with pytest.raises(FileNotFoundError):
        io.read_layer(spark, landed.lake, "silver", "orders")
    audit = io.read_audit(spark, landed.lake).where("run_id = 'silver-bad'").collect()
    assert len(audit) == 1 and audit[0].passed is False and audit[0].published is False
    assert any(c.check == "unique:order_id" and not c.passed for c in audit[0].checks)


def test_layer_gate_stops_next_layer(spark, landed):
    with pytest.raises(NoLandingPartitionError):
        jobs.run_all(spark, jobs.LakePaths(landed.landing + "-missing", landed.lake), log=None)
    assert not os.path.exists(os.path.join(landed.lake, "silver"))


def test_unknown_names(spark, landed):
    out = jobs.run_layer(spark, landed, "silver", tables=["nope"], log=None)
    assert not out[0].passed and "ValueError" in out[0].error
    with pytest.raises(ValueError):
        jobs.run_layer(spark, landed, "platinum", log=None)


def test_bronze_reads_only_the_newest_drop(spark, scratch):
    landed = jobs.LakePaths(os.path.join(scratch, "landing"), os.path.join(scratch, "lake"))
    customers = raw_tables(spark, SMALL_SF)["customers"]
    jobs.land_tables({"customers": customers}, landed.landing, "2024-01-01")
    jobs.land_tables({"customers": customers.limit(7)}, landed.landing, "2024-02-01")
    jobs.land_tables({"customers": customers.limit(3)}, landed.landing, "2023-12-31")
    out = jobs.bronze_job(spark, landed, "customers", log=None)
    assert out.passed and out.rows == 7 and out.source_partition == "2024-02-01"
    audit = io.read_audit(spark, landed.lake).where("table_name = 'customers'").collect()
    assert audit[0].source_partition == "2024-02-01" and audit[0].rows == 7


def test_command_line_runs_one_layer(spark, landed):
    assert jobs.main(["--landing", landed.landing, "--lake", landed.lake, "--layer", "bronze",
                      "--table", "sellers"]) == 0
    assert io.read_layer(spark, landed.lake, "bronze", "sellers").count() > 0


STATUS = "order_id string, customer_id string, order_status string"


def _lake(scratch):
    return jobs.LakePaths(os.path.join(scratch, "landing"), os.path.join(scratch, "lake"))


def test_repeated_run_leaves_no_old_partition(spark, scratch):
    """Whatever the session's overwrite mode, a second try of a run id replaces the first one whole."""
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, month string")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        io.write_staged(df, scratch, "gold", "t", "run1", ["month"])
        path = io.write_staged(df.where("x = 1"), scratch, "gold", "t", "run1", ["month"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert spark.read.parquet(path).count() == 1


def test_audit_tells_what_publishing_did(spark, scratch, monkeypatch):
    paths = _lake(scratch)

    def broken(*a, **k):
        raise OSError("store is away")

    monkeypatch.setattr(io, "publish", broken)
    with pytest.raises(OSError):
        jobs.stage_validate_publish(spark, paths, "silver", "sellers", spark.createDataFrame([("s",)], "seller_id string"), "r1", log=None)
    row = io.read_audit(spark, paths.lake).collect()[0]
    assert (row["passed"], row["published"]) == (True, False) and "store is away" in row["error"]
    with pytest.raises(FileNotFoundError):
        io.read_layer(spark, paths.lake, "silver", "sellers")


def test_readers_keep_the_old_version_until_the_marker(spark, scratch):
    paths, schema = _lake(scratch), "seller_id string"
    jobs.stage_validate_publish(spark, paths, "silver", "sellers", spark.createDataFrame([("s1",)], schema), "r1", log=None)
    first = io.read_layer(spark, paths.lake, "silver", "sellers")
    io.write_staged(spark.createDataFrame([("s2",), ("s3",)], schema), paths.lake, "silver", "sellers", "r2")
    assert io.read_layer(spark, paths.lake, "silver", "sellers").count() == 1
    io.publish(spark, paths.lake, "silver", "sellers", "r2")
    assert io.read_layer(spark, paths.lake, "silver", "sellers").count() == 2 and first.count() == 1
    io.publish(spark, paths.lake, "silver", "sellers", "r1")  # back to a version that is still there
    assert io.read_layer(spark, paths.lake, "silver", "sellers").count() == 1
    assert io.remove_old_versions(spark, paths.lake, "silver", "sellers", keep=1) == ["r2"]
    assert io.read_layer(spark, paths.lake, "silver", "sellers").count() == 1


def test_failed_runs_are_no_predecessors(spark, scratch):
    paths, schema = _lake(scratch), "seller_id string"
    good, bad = spark.createDataFrame([("s1",)], schema), spark.createDataFrame([("s1",), (None,)], schema)
    for i, df in enumerate((good, bad, good)):
        jobs.stage_validate_publish(spark, paths, "silver", "sellers", df, f"r{i}", log=None)
    got = {r["run_id"]: r["unchanged"] for r in io.compare_runs(io.read_audit(spark, paths.lake)).collect()}
    assert got == {"r0": None, "r1": False, "r2": True}


def test_rejected_values_are_kept_with_the_audit(spark, scratch):
    paths = _lake(scratch)
    rows = [(f"q{i}", "k", f"odd{i % 33}") for i in range(99)]
    out = jobs.stage_validate_publish(spark, paths, "silver", "orders", spark.createDataFrame(rows, STATUS), "r1", log=None)
    assert not out.published
    kept = io.read_offenders(spark, paths.lake).where("run_id = 'r1'").collect()
    assert {(r["value"], r["rows"]) for r in kept} == {(f"odd{i}", 3) for i in range(33)}


def test_extra_checks_read_finished_layers_only():
    from lakestrata.specs import EXTRA_CHECKS
    assert all(c.ref_layer == "silver" for layer in EXTRA_CHECKS.values() for checks in layer.values() for c in checks if c.ref_table)


def test_versions_are_written_with_zstd(spark, scratch):
    import pyarrow.parquet as pq

    path = io.write_staged(spark.range(100), scratch, "bronze", "customers", "r")
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert files and all(pq.ParquetFile(os.path.join(path, f)).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)


def test_every_query_over_a_lake_makes_its_own_run(spark, monkeypatch):
    """A query's rows are those of the tables as they are now, not those of an earlier query's run."""
    runs = []
    monkeypatch.setattr(jobs, "land_tables", lambda *a, **k: None)
    monkeypatch.setattr(jobs, "run_all", lambda _spark, paths, **k: runs.append(paths.lake))
    lakes = [catalog._run_layers(spark, SMALL_SF).lake for _ in range(2)]
    assert lakes == runs and len(set(runs)) == 2
