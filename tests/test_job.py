"""Files in, tables and report out."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from builders import formatted_plan
from salestax_spark import Inputs, run
from salestax_spark.__main__ import parse
from salestax_spark.operators import checks, issues, unify
from salestax_spark.operators.checks import CHECKS
from salestax_spark.plans import job
from salestax_spark.sources import readers
from salestax_spark.sources.tables import CatalogStore, FolderStore
from testbed import projection
from testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """The test documents as JSON lines, order money as text."""
    root = tmp_path_factory.mktemp("delivered")
    orders = projection.order_documents(spark, SF)
    money = {c: F.format_string("%.2f", c) for c in ("total_price", "subtotal_price", "total_tax")}
    for name, df in {
        "charges": projection.charge_documents(spark, SF),
        "orders": orders.withColumns(money),
        "refunds": projection.raw_refunds(spark, SF),
    }.items():
        df.write.json(str(root / name))
    formats = dict.fromkeys(("charges", "orders", "refunds"), "json_lines")
    return Inputs(*(str(root / n) for n in ("charges", "orders", "refunds")), formats=formats)


def _same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def _report(spark, location):
    folder = Path(FolderStore(spark, str(location)).path(job.REPORT))
    return json.loads("".join(p.read_text() for p in sorted(folder.glob("part-*"))))


def test_full_run(spark, delivered, tmp_path):
    tables = run(spark, delivered, str(tmp_path), as_of=projection.AS_OF)
    _same(tables[job.ISSUES_MART], QUERIES["data_issues"](spark, SF))
    _same(tables[job.NEXUS_MART], QUERIES["nexus_exposure"](spark, SF))
    _same(tables[job.CHECKS], QUERIES["check_results"](spark, SF))
    _same(tables[job.COUNTS], QUERIES["transaction_counts"](spark, SF))
    assert tables[job.UNIFIED].count() == 1522
    assert tables[job.UNIFIED].select("txn_key").distinct().count() == 1522

    document = _report(spark, tmp_path)
    assert len(document["nexus_exposure"]) == tables[job.NEXUS_MART].count() == 49
    assert [t["test_name"] for t in document["dbt_test_results"]] == sorted(CHECKS)
    assert sum(r["total_transactions"] for r in document["transaction_counts"]) == 1522

    again = run(spark, delivered, str(tmp_path), as_of=projection.AS_OF, views=True)
    assert again[job.UNIFIED].count() == 1522
    counted = spark.sql(
        "SELECT (SELECT count(*) FROM stg_stripe_refunds WHERE is_orphan_refund) AS orphans,"
        " (SELECT sum(issue_count) FROM fct_data_issues WHERE issue_type = 'orphan_refund') AS counted"
    ).first()
    assert counted.orphans == counted.counted == 94
    for name in (*job.staged(again), *again):
        spark.catalog.dropTempView(name)


def test_a_check_that_errors_fails_alone(spark, delivered, tmp_path, monkeypatch):
    monkeypatch.setattr(checks, "_tax_without_state", lambda: F.raise_error(F.lit("broken")).isNull())
    tables = run(spark, delivered, str(tmp_path), as_of=projection.AS_OF)
    got = {r.test_name: (r.violations, r.status) for r in tables[job.CHECKS].collect()}
    monkeypatch.undo()
    want = {r.test_name: (r.violations, r.status) for r in QUERIES["check_results"](spark, SF).collect()}
    assert got.pop(checks.CHECK_TAX_NO_STATE) == (None, "failed")
    want.pop(checks.CHECK_TAX_NO_STATE)
    assert got == want
    document = _report(spark, tmp_path)
    assert {t["test_name"]: t["status"] for t in document["dbt_test_results"]}[checks.CHECK_TAX_NO_STATE] == "failed"


def test_counts_come_from_the_profile(spark, delivered, tmp_path):
    tables = run(spark, delivered, str(tmp_path), as_of=projection.AS_OF)
    _same(tables[job.COUNTS], issues.transaction_counts(tables[job.UNIFIED]))
    _same(tables[job.ISSUES_MART], issues.data_issues(tables[job.UNIFIED], tables[job.MERCHANTS], tables[job.ORPHANS]))


def test_catalog_run(spark, delivered, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS taxdb")
    store = CatalogStore(spark, "taxdb")
    run(spark, delivered, str(tmp_path), as_of=projection.AS_OF, null_link="keep", store=store)
    assert store.read(job.UNIFIED).count() == 1529
    spark.sql("DROP DATABASE taxdb CASCADE")


def test_nexus_scan_of_the_written_table_is_pruned_and_filtered(spark, delivered, tmp_path):
    from salestax_spark.operators import nexus
    from salestax_spark.sources import reference_data

    tables = run(spark, delivered, str(tmp_path), as_of=projection.AS_OF)
    mart = nexus.nexus_exposure(tables[job.UNIFIED], reference_data.threshold_table(spark), projection.AS_OF)
    plan = formatted_plan(spark, mart)
    assert "GreaterThanOrEqual(occurred_at,2000-08-01" in plan
    assert "txn_key" not in plan


def test_a_run_that_ends_in_the_middle_leaves_the_former_set(spark, delivered, tmp_path, monkeypatch):
    store = FolderStore(spark, str(tmp_path))
    run(spark, delivered, str(tmp_path), as_of=projection.AS_OF)
    before = {name: sorted(map(str, store.read(name).collect())) for name in (job.RAW_CHARGES, job.UNIFIED, job.ISSUES_MART, job.KPIS)}
    document = _report(spark, tmp_path)
    other = Inputs(delivered.charges, delivered.orders, delivered.orders, formats=delivered.formats)  # refunds that are orders
    monkeypatch.setattr(job.report, "merchant_kpis", lambda *_: spark.sql("SELECT raise_error('stop') AS x"))
    with pytest.raises(job.StepsFailed, match="merchant_kpis") as failure:
        run(spark, other, str(tmp_path), as_of="1995-01-01")
    assert list(failure.value.errors) == [job.KPIS] and failure.value.left_out == []
    assert {name: sorted(map(str, store.read(name).collect())) for name in before} == before
    assert _report(spark, tmp_path) == document
    assert len(list((tmp_path / "generations").iterdir())) == 1


def test_steps_fail_apart(spark):
    done = []

    def fail(*_):
        raise KeyError("broken")

    steps = [
        ("a", (), lambda: done.append("a") or spark.range(1)),
        ("b", ("a",), fail),
        ("c", ("a",), lambda a: done.append("c") or a),
        ("d", ("b", "c"), lambda b, c: done.append("d") or b),
        ("e", ("d",), lambda d: d),
        ("f", ("c",), lambda c: done.append("f") or c),
    ]
    with pytest.raises(job.StepsFailed, match="b: 'broken'; not run: d, e") as failure:
        job.side_by_side(spark, steps, {})
    assert list(failure.value.errors) == ["b"] and failure.value.left_out == ["d", "e"]
    assert sorted(done) == ["a", "c", "f"]


def test_more_waiting_steps_than_threads(spark):
    chain = [("s0", (), lambda: spark.range(3))] + [(f"s{i}", (f"s{i - 1}",), lambda df: df.where("id > -1")) for i in range(1, 3 * job.THREADS)]
    assert job.side_by_side(spark, chain, {})[f"s{3 * job.THREADS - 1}"].count() == 3


def test_staged_layer_starts_no_job(spark, delivered, tmp_path):
    raw = job.load_raw(spark, delivered, FolderStore(spark, str(tmp_path)))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("staged", "staged")
    try:
        tables = job.staged(raw)
        assert not tracker.getJobIdsForGroup("staged")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = tables[job.STG_REFUNDS]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # refunds once, charges once


def test_bad_records_are_listed(spark, delivered, tmp_path):
    charges = tmp_path / "charges.jsonl"
    good = [p.read_text() for p in Path(delivered.charges).glob("part-*")]
    charges.write_text("".join(good) + '{"id": "x", "amount": "lots"}\n{"id": "y"\n')
    limits = tmp_path / "limits.csv"
    header = "state_code,state_name,has_sales_tax,sales_threshold_usd,transaction_threshold,threshold_logic,notes"
    limits.write_text(f"{header}\nCA,California,true,500000,,,\nNY,New York,true\nTX,Texas,true,500000,,,,,\n")
    inputs = Inputs(str(charges), delivered.orders, delivered.refunds, str(limits), formats=delivered.formats)
    with pytest.raises(job.StepsFailed, match=f"{job.RAW_CHARGES}.*{job.THRESHOLDS}"):
        run(spark, inputs, str(tmp_path / "out"), as_of=projection.AS_OF)
    inputs = Inputs(str(charges), delivered.orders, delivered.refunds, str(limits), formats=delivered.formats, on_bad=readers.SKIP)
    tables = run(spark, inputs, str(tmp_path / "out"), as_of=projection.AS_OF)
    listed = sorted((r.source, r.record[:10]) for r in tables[job.REJECTED].collect())
    assert listed == [("charges", '{"id": "x"'), ("charges", '{"id": "y"'), ("thresholds", "NY,New Yor"), ("thresholds", "TX,Texas,t")]
    assert tables[job.UNIFIED].count() == 1522
    assert {r.state_code for r in tables[job.NEXUS_MART].select("state_code").collect()} == {"CA"}


def test_month_folders_are_pruned(spark, delivered, tmp_path):
    from salestax_spark.operators import nexus
    from salestax_spark.sources import reference_data

    plain = run(spark, delivered, str(tmp_path / "a"), as_of=projection.AS_OF)
    tables = run(spark, delivered, str(tmp_path / "b"), as_of=projection.AS_OF, month_folders=True)
    _same(tables[job.NEXUS_MART], plain[job.NEXUS_MART])
    _same(tables[job.UNIFIED].drop(nexus.MONTH), plain[job.UNIFIED])
    rows = nexus.trailing(FolderStore(spark, str(tmp_path / "b")).read(job.UNIFIED), projection.AS_OF)
    plan = formatted_plan(spark, rows)
    assert "PartitionFilters" in plan and "occurred_month" in plan.split("PartitionFilters")[1].splitlines()[0]
    read = rows.select(F.input_file_name().alias("f")).distinct().collect()
    months = {r.f.split("occurred_month=")[1][:7] for r in read}
    assert min(months) >= "2000-08"
    # The window cuts a month in no place here, so pruning alone gives its rows.
    assert rows.count() == tables[job.UNIFIED].where("occurred_month >= '2000-08'").count()
    mart = nexus.nexus_exposure(FolderStore(spark, str(tmp_path / "b")).read(job.UNIFIED), reference_data.threshold_table(spark), projection.AS_OF)
    _same(mart, plain[job.NEXUS_MART])


def test_bucketed_tables_meet_without_a_shuffle(spark, delivered, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    try:
        store = CatalogStore(spark, "bucketed", buckets=job.link_buckets(8))
        tables = run(spark, delivered, str(tmp_path), as_of=projection.AS_OF, store=store)
        layer = job.staged({name: store.read(name) for name in (job.RAW_CHARGES, job.RAW_ORDERS, job.RAW_REFUNDS)})
        unified = unify.unified_transactions(layer[job.STG_CHARGES], layer[job.STG_ORDERS])
        plan = unified._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        _same(unified, tables[job.UNIFIED])
    finally:
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_command_line():
    args = parse(["--charges", "c", "--orders", "o", "--refunds", "r", "--out", "x", "--as-of", "2024-01-01", "--format", "parquet"])
    assert (args.charges, args.format, args.months, args.null_link) == ("c", "parquet", 12, "collapse")
