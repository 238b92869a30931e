import datetime as dt

import pytest
from pyspark.sql import functions as F

from builders import by, raw_charges, raw_orders, raw_refunds
from salestax_spark.operators import staging

UTC = dt.timezone.utc


def test_only_succeeded_charges_are_counted(spark):
    raw = raw_charges(spark, {"id": "a"}, {"id": "b", "status": "failed"}, {"id": "c", "status": None})
    assert [r.id for r in staging.stage_charges(raw).collect()] == ["a"]


def test_charge_projection(spark):
    raw = raw_charges(spark, {"id": "a", "currency": "EUR", "billing_state": " ca ", "billing_country": " usa"})
    row = staging.stage_charges(raw).select("*", F.unix_seconds("created_at").alias("e")).first()
    assert (row.currency, row.billing_state, row.billing_country) == ("eur", "CA", "USA")
    assert (row.amount_cents, row.tax_amount_collected_cents, row.e) == (10000, 800, raw.first().created)


@pytest.mark.parametrize("value,missing", [(None, True), ("", True), ("   ", True), ("\t", False), (" CA ", False)])
def test_missing_means_null_or_spaces(spark, value, missing):
    raw = raw_charges(spark, {"id": "a", "billing_state": value, "billing_zip": value})
    row = staging.stage_charges(raw).first()
    assert (row.is_missing_state, row.is_missing_zip) == (missing, missing)


@pytest.mark.parametrize(
    "b2b,cert,flag",
    [(True, None, True), (True, "  ", True), (True, "C-1", False), (False, None, False), (None, None, None), (None, "C", False)],
)
def test_missing_certificate_is_three_valued(spark, b2b, cert, flag):
    raw = raw_charges(spark, {"id": "a", "is_b2b": b2b, "exemption_cert_id": cert})
    assert staging.stage_charges(raw).first().is_b2b_missing_cert is flag


@pytest.mark.parametrize(
    "tax,state,flag",
    [
        (0, "CA", True), (None, " ca ", True), (1, "CA", False), (0, "OR", False), (0, "DC", False), (0, "XX", False),
        (0, None, None), (5, None, False), (0, "", False),
    ],
)
def test_zero_tax_charge(spark, tax, state, flag):
    raw = raw_charges(spark, {"id": "a", "tax_amount_collected": tax, "billing_state": state})
    assert staging.stage_charges(raw).first().is_zero_tax_taxable_state is flag


@pytest.mark.parametrize("status,flag", [("paid", True), ("partially_refunded", True), ("pending", False), (None, None)])
def test_zero_tax_order_needs_a_settled_status(spark, status, flag):
    orders = staging.stage_orders(raw_orders(spark, {"id": 1, "total_tax": "0.00", "financial_status": status}))
    expr = staging.zero_tax_order(F.col("total_tax"), "billing_state", F.col("financial_status"))
    assert orders.select(expr.alias("f")).first().f is flag


def test_order_times(spark):
    raw = raw_orders(spark, {"id": 1}, {"id": 2, "created_at": "not a date"}, {"id": 3, "created_at": None})
    got = by(staging.stage_orders(raw).withColumn("e", F.unix_seconds("created_at")), "id", "e")
    assert got == {1: int(dt.datetime(2024, 1, 15, 12, tzinfo=UTC).timestamp()), 2: None, 3: None}


def test_order_of_every_status_stays_and_money_is_typed(spark):
    raw = raw_orders(spark, {"id": 1, "financial_status": "pending"}, {"id": 2})
    rows = staging.stage_orders(raw).collect()
    assert len(rows) == 2
    assert (rows[0].total_price, rows[0].subtotal_price, rows[0].total_tax) == (100.0, 92.0, 8.0)


def test_unreadable_money_stops_the_run(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_orders(raw_orders(spark, {"id": 1, "total_tax": "abc"})).collect()


def test_orphans_are_refunds_without_a_succeeded_charge(spark):
    charges = staging.stage_charges(raw_charges(spark, {"id": "live"}, {"id": "dead", "status": "failed"}))
    refunds = raw_refunds(
        spark,
        {"id": "r1", "charge_id": "live"},
        {"id": "r2", "charge_id": "dead"},
        {"id": "r3", "charge_id": None},
        {"id": "r4", "charge_id": "never seen"},
    )
    got = by(staging.stage_refunds(refunds, charges), "id", "is_orphan_refund")
    assert got == {"r1": False, "r2": True, "r3": True, "r4": True}
