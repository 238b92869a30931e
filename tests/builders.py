"""Hand-made rows with defaults, so that a test only spells out what it is about."""

from __future__ import annotations

import datetime as dt

from salestax_spark.sources import schemas

RAW_CHARGE = """id string, object string, merchant_id string, amount bigint, currency string, status string, created bigint,
    tax_amount_collected bigint, source_store string, billing_state string, billing_zip string, billing_country string,
    is_b2b boolean, exemption_cert_id string, shopify_order_id string"""
RAW_ORDER = """id bigint, name string, merchant_id string, source_store string, created_at string, currency string,
    total_price string, subtotal_price string, total_tax string, taxes_included boolean, financial_status string,
    stripe_charge_id string, billing_state string, billing_zip string, billing_country string"""

NOON = int(dt.datetime(2024, 1, 15, 12, tzinfo=dt.timezone.utc).timestamp())


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _frame(spark, ddl, defaults, rows):
    unknown = {key for row in rows for key in row} - set(_names(ddl))
    assert not unknown, unknown
    return spark.createDataFrame([tuple({**defaults, **row}.get(n) for n in _names(ddl)) for row in rows], ddl)


def raw_charges(spark, *rows):
    defaults = {
        "object": "charge", "merchant_id": "merch_acme_foods", "amount": 10000, "currency": "usd",
        "status": "succeeded", "created": NOON, "tax_amount_collected": 800, "source_store": "acme-foods-main",
        "billing_state": "CA", "billing_zip": "90001", "billing_country": "US", "is_b2b": False, "shopify_order_id": "1",
    }
    return _frame(spark, RAW_CHARGE, defaults, rows)


def raw_orders(spark, *rows):
    defaults = {
        "name": "#1", "merchant_id": "merch_acme_foods", "source_store": "acme-foods-main",
        "created_at": "2024-01-15T12:00:00+0000", "currency": "usd", "total_price": "100.00",
        "subtotal_price": "92.00", "total_tax": "8.00", "taxes_included": False, "financial_status": "paid",
        "billing_state": "CA", "billing_zip": "90001", "billing_country": "US",
    }
    return _frame(spark, RAW_ORDER, defaults, rows)


def raw_refunds(spark, *rows):
    defaults = {
        "object": "refund", "merchant_id": "merch_acme_foods", "amount": 500, "currency": "usd",
        "status": "succeeded", "created": NOON,
    }
    return _frame(spark, schemas.REFUND_DOCUMENT, defaults, rows)


def by(df, key, value):
    return {row[key]: row[value] for row in df.collect()}


def formatted_plan(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
