import json

import pytest
from pyspark.sql import functions as F

from salestax_spark.functions import text
from salestax_spark.operators import report
from salestax_spark.sources import reference_data as ref

ISSUE = "merchant_id string, issue_type string, issue_count bigint, severity string, recommended_action string"
NEXUS = """merchant_id string, state_code string, state_name string, trailing_12m_sales_usd double,
    trailing_12m_transactions bigint, sales_threshold_usd double, has_crossed_nexus_threshold boolean, exposure_tier string"""


def _issues(spark, *rows):
    return spark.createDataFrame([(m, t, n, s, "do it") for m, t, n, s in rows], ISSUE)


def _nexus(spark, *rows):
    return spark.createDataFrame(list(rows), NEXUS)


@pytest.mark.parametrize(
    "issues,transactions,score",
    [(0, 10, 100), (1, 8, 88), (3, 8, 63), (5, 1000, 100), (6, 1000, 99), (10, 10, 0), (20, 10, 0), (1, 0, 0), (0, 0, 100)],
)
def test_quality_score(spark, issues, transactions, score):
    row = spark.range(1).select(report.quality_score(F.lit(issues), F.lit(transactions)).alias("s")).first()
    assert row.s == score


def test_merchant_kpis(spark):
    issues = _issues(spark, ("merch_acme_foods", "a", 3, "high"), ("merch_acme_foods", "b", 1, "low"), ("merch_surf_co", "a", 2, "high"))
    states = _nexus(
        spark,
        ("merch_acme_foods", "CA", "California", 9.0, 1, 1.0, True, "high_exposure"),
        ("merch_acme_foods", "TX", "Texas", 9.0, 1, 1.0, False, "below_threshold"),
        ("merch_acme_foods", "NY", "New York", 9.0, 1, 1.0, None, "at_threshold"),
    )
    counts = spark.createDataFrame([("merch_acme_foods", 8)], "merchant_id string, total_transactions bigint")
    rows = {r.merchant_id: r for r in report.merchant_kpis(ref.merchant_table(spark), issues, states, counts).collect()}
    assert len(rows) == 5
    acme, surf, graze = rows["merch_acme_foods"], rows["merch_surf_co"], rows["merch_graze_box"]
    assert tuple(acme) == ("merch_acme_foods", "Acme Foods Co", 8, 4, 1, 50)
    assert tuple(surf)[2:] == (0, 2, 0, 0)
    assert tuple(graze)[2:] == (0, 0, 0, 100)


def test_ranked_issues(spark):
    issues = _issues(
        spark, ("m", "orphan_refund", 5, "high"), ("m", "currency_mismatch", 50, "medium"), ("m", "some_new_type", 99, "odd"),
        ("m", "missing_billing_address", 7, "HIGH"), ("m", "b2b_missing_exemption_cert", 50, "medium"), ("m", "x", 1, None),
    )
    got = sorted((r.issue_rank, r.issue_label, r.severity) for r in report.ranked_issues(issues).collect())
    assert got == [
        (1, "Missing billing address", "high"),
        (2, "Orphan refund", "high"),
        (3, "B2B missing exemption certificate", "medium"),
        (3, "Currency mismatch", "medium"),
        (5, "Some New Type", "odd"),
        (6, "X", "medium"),
    ]


@pytest.mark.parametrize("blank", ["", None])
def test_ranked_issues_fill_gaps(spark, blank):
    issues = spark.createDataFrame([("m", "x", 1, blank, blank)], ISSUE)
    row = report.ranked_issues(issues).first()
    assert (row.severity, row.recommended_action) == ("medium", "—")


def test_ranked_nexus(spark):
    states = _nexus(
        spark,
        ("m", "CA", "California", 5.0, 1, 1.0, True, "high_exposure"),
        ("m", "TX", None, 9.0, 1, 1.0, True, "at_threshold"),
        ("m", "NY", "", None, 1, 1.0, True, None),
        ("m", "OR", "Oregon", 99.0, 1, None, False, "no_sales_tax"),
        ("m", "ID", "Idaho", 99.0, 1, None, None, "at_threshold"),
    )
    got = sorted((r.sales_rank, r.state_label, r.tier_label) for r in report.ranked_nexus(states).collect())
    assert got == [(1, "TX", "at threshold"), (2, "California (CA)", "high exposure"), (3, "NY", "—")]


def test_truthy(spark):
    df = spark.sql("SELECT * FROM VALUES ('true'), ('1'), ('TRUE'), ('yes'), (CAST(NULL AS string)) AS t(v)")
    assert [r.t for r in df.select(text.truthy(F.col("v")).alias("t")).collect()] == [True, True, False, False, False]
    row = spark.range(1).select(text.truthy(F.lit(1)).alias("a"), text.truthy(F.lit(2)).alias("b"), text.truthy(F.lit(True)).alias("c"))
    assert tuple(row.first()) == (True, False, True)


def _document(spark, tmp_path, **replaced):
    parts = {
        "merchants": ref.merchant_table(spark),
        "issues": _issues(spark, ("m\"q", "orphan_refund", 5, "high"), ("a", "x", 1, None), ("a", "x", 1, None)),
        "nexus": _nexus(spark, ("m", "CA", "California", 1.5e7, 3, None, None, "at_threshold")),
        "counts": spark.createDataFrame([("m", 3)], "merchant_id string, total_transactions bigint"),
        "checks": spark.createDataFrame([("t1", "passed", 0), ("t2", "failed", 4)], "test_name string, status string, violations int"),
        **replaced,
    }
    path = str(tmp_path / "report")
    report.write_report(report.report_lines(*parts.values(), generated_at="2024-01-01T00:00:00+00:00"), path)
    files = sorted((tmp_path / "report").glob("part-*"))
    return json.loads("".join(f.read_text() for f in files)), files


def test_report_is_one_json_document(spark, tmp_path):
    doc, files = _document(spark, tmp_path)
    assert len(files) == 1
    assert list(doc) == list(report.REPORT_KEYS)
    assert doc["generated_at"] == "2024-01-01T00:00:00+00:00"
    assert doc["merchants"][0] == {"id": "merch_acme_foods", "name": "Acme Foods Co"} and len(doc["merchants"]) == 5
    assert [i["merchant_id"] for i in doc["data_issues"]] == ["a", "a", 'm"q']
    assert doc["data_issues"][0]["severity"] is None
    assert doc["nexus_exposure"][0]["trailing_12m_sales_usd"] == 1.5e7
    assert doc["nexus_exposure"][0]["sales_threshold_usd"] is None
    assert doc["transaction_counts"] == [{"merchant_id": "m", "total_transactions": 3}]
    assert doc["dbt_test_results"] == [{"test_name": "t1", "status": "passed"}, {"test_name": "t2", "status": "failed"}]


def test_report_in_several_parts_is_the_same_document(spark, tmp_path):
    many = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("merchant_id"), F.col("id").alias("total_transactions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        doc, files = _document(spark, tmp_path, counts=many)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) > 1
    assert sorted(r["total_transactions"] for r in doc["transaction_counts"]) == list(range(5000))


def test_empty_report(spark, tmp_path):
    empty = _issues(spark, ("a", "x", 1, None)).where("false")
    doc, _ = _document(spark, tmp_path, issues=empty)
    assert doc["data_issues"] == [] and len(doc["merchants"]) == 5
