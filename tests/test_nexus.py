import datetime as dt

import pytest
from pyspark.sql import functions as F

from salestax_spark.functions.dates import as_date, months_before
from salestax_spark.operators import nexus
from salestax_spark.sources import reference_data

SALES = """merchant_id string, state_code string, trailing_12m_sales_usd double, trailing_12m_transactions bigint"""
THRESHOLD = """state_code string, state_name string, has_sales_tax string, sales_threshold_usd double,
    transaction_threshold bigint, threshold_logic string"""


def _classified(spark, sales, transactions, threshold):
    left = spark.createDataFrame([("m", "S", sales, transactions)], SALES)
    right = spark.createDataFrame([("S", "Name", *threshold)], THRESHOLD)
    row = nexus.classify(nexus.attach_thresholds(left, right)).first()
    return row.has_crossed_nexus_threshold, row.exposure_tier


OR = ("true", 100000.0, 200, "OR")
AND = ("true", 500000.0, 100, "AND")
SALES_ONLY = ("true", 500000.0, None, None)


@pytest.mark.parametrize(
    "sales,count,threshold,expected",
    [
        (100000.0, 1, OR, (True, "at_threshold")),
        (99999.99, 199, OR, (False, "below_threshold")),
        (10.0, 200, OR, (True, "at_threshold")),
        (200000.0, 1, OR, (True, "high_exposure")),
        (199999.99, 1, OR, (True, "at_threshold")),
        (500000.0, 99, AND, (False, "below_threshold")),
        (500000.0, 100, AND, (True, "at_threshold")),
        (499999.99, 100, AND, (False, "below_threshold")),
        (1000000.0, 100, ("true", 500000.0, 100, "and"), (True, "high_exposure")),
        (10.0, 10000, SALES_ONLY, (False, "below_threshold")),
        (500000.0, 1, SALES_ONLY, (True, "at_threshold")),
        (10.0, 10, ("true", None, None, None), (None, "at_threshold")),
        (10.0, 200, ("true", None, 200, "OR"), (True, "at_threshold")),
        (10.0, 10, ("true", None, 200, "OR"), (None, "at_threshold")),
        (10.0, 10, ("true", None, 100, "AND"), (False, "below_threshold")),
        (10.0, 100, ("true", None, 100, "AND"), (None, "at_threshold")),
        (None, 10, OR, (None, "at_threshold")),
        (9e9, 10**6, ("false", None, None, None), (False, "no_sales_tax")),
        (9e9, 10**6, ("false", 1.0, 1, "OR"), (False, "no_sales_tax")),
        (10.0, 10, (None, 5.0, 200, "OR"), (True, "high_exposure")),
    ],
)
def test_crossing_and_tier(spark, sales, count, threshold, expected):
    assert _classified(spark, sales, count, threshold) == expected


@pytest.mark.parametrize(
    "day,months,expected",
    [
        ("2001-08-01", 12, "2000-08-01"),
        ("2024-02-29", 12, "2023-02-28"),
        ("2024-03-31", 1, "2024-02-29"),
        ("2024-01-31", 13, "2022-12-31"),
        ("2024-12-31", 0, "2024-12-31"),
    ],
)
def test_months_before(day, months, expected):
    assert months_before(as_date(day), months) == dt.date.fromisoformat(expected)


def test_as_date():
    assert as_date(dt.datetime(2024, 5, 6, 7)) == dt.date(2024, 5, 6) == as_date(dt.date(2024, 5, 6))
    assert as_date(None) == dt.datetime.now(dt.timezone.utc).date()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_window_starts_at_utc_midnight_and_has_no_end(spark, zone):
    start = int(dt.datetime(2023, 2, 28, tzinfo=dt.timezone.utc).timestamp())
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(start,), (start - 1,), (start + 10**8,), (None,)], "e bigint")
        kept = nexus.trailing(rows.withColumn("occurred_at", F.timestamp_seconds("e")), "2024-02-29")
        assert sorted(r.e for r in kept.collect()) == [start, start + 10**8]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _unified(spark, *rows):
    ddl = """merchant_id string, billing_state string, billing_country string, subtotal_usd double,
        tax_collected_usd double, is_refund boolean, e bigint"""
    start = int(dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(*row, start) for row in rows], ddl)
    return df.withColumn("occurred_at", F.timestamp_seconds("e"))


def test_state_sales_filters(spark):
    unified = _unified(
        spark,
        ("m", "CA", "US", 10.0, 1.0, False),
        ("m", "CA", "usa ", 20.0, 2.5, False),
        ("m", "CA", "FR", 99.0, 0.0, False),
        ("m", "CA", None, 99.0, 0.0, False),
        ("m", " ", "US", 99.0, 0.0, False),
        ("m", None, "US", 99.0, 0.0, False),
        ("m", "CA", "US", 99.0, 0.0, True),
        ("m", "TX", "US", None, None, False),
        (None, "TX", "US", 1.0, 0.0, False),
    )
    got = {(r.merchant_id, r.state_code): r[2:] for r in nexus.state_sales(unified, "2024-06-01").collect()}
    assert got == {("m", "CA"): (33.5, 2), ("m", "TX"): (None, 1), (None, "TX"): (1.0, 1)}


def test_totals_do_not_depend_on_partitioning(spark):
    rows = spark.range(20000).select(
        F.lit("m").alias("merchant_id"),
        F.lit("CA").alias("billing_state"),
        F.lit("US").alias("billing_country"),
        (F.pmod(F.xxhash64("id"), F.lit(10**7)) / 100.0).alias("subtotal_usd"),
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 100.0).alias("tax_collected_usd"),
        F.lit(False).alias("is_refund"),
        F.timestamp_seconds(F.lit(1717200000)).alias("occurred_at"),
    )
    want = sum(round(r.subtotal_usd * 100) + round(r.tax_collected_usd * 100) for r in rows.collect()) / 100
    for n in (1, 3, 16):
        assert nexus.state_sales(rows.repartition(n), "2024-06-01").first().trailing_12m_sales_usd == want


def test_sub_cent_amounts_are_kept(spark):
    unified = _unified(spark, *[("m", "CA", "US", 0.0025, 0.0, False)] * 4)
    assert nexus.state_sales(unified, "2024-06-01").first().trailing_12m_sales_usd == 0.01


def test_jurisdiction_without_threshold_is_left_out(spark):
    unified = _unified(spark, ("m", "PR", "US", 1.0, 0.0, False), ("m", "OR", "US", 1.0, 0.0, False))
    rows = nexus.nexus_exposure(unified, reference_data.threshold_table(spark), "2024-06-01").collect()
    assert [(r.state_code, r.state_name, r.has_sales_tax, r.exposure_tier) for r in rows] == [
        ("OR", "Oregon", "false", "no_sales_tax")
    ]


def test_clean_thresholds_reads_untidy_text(spark):
    ddl = "state_code string, state_name string, has_sales_tax string, sales_threshold_usd string, transaction_threshold string, threshold_logic string"
    untidy = [
        ("AA", "A", " TRUE ", " 100000 ", " 200 ", " OR "),
        ("BB", "B", "False", "", "", ""),
        ("CC", "C", None, "n/a", "many", None),
        ("DD", "D", "true", "1.5e5", "10.5", "AND"),
    ]
    got = [tuple(r) for r in nexus.clean_thresholds(spark.createDataFrame(untidy, ddl)).orderBy("state_code").collect()]
    assert got == [
        ("AA", "A", "true", 100000.0, 200, "OR"),
        ("BB", "B", "false", None, None, None),
        ("CC", "C", None, None, None, None),
        ("DD", "D", "true", 150000.0, 11, "AND"),
    ]


def test_threshold_table_is_broadcast(spark):
    unified = _unified(spark, ("m", "OR", "US", 1.0, 0.0, False))
    df = nexus.nexus_exposure(unified, reference_data.threshold_table(spark), "2024-06-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [state_code" in plan and plan.count("Exchange hashpartitioning") == 1
