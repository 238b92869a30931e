"""Typed, normalised and flagged rows of each source. One input row gives at most one output row.

Flags keep three-valued logic: a flag is NULL where its inputs leave the answer open, and filters on it
drop the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestax_spark.functions.dates import from_epoch
from salestax_spark.functions.text import code, is_blank, lower_text
from salestax_spark.operators.existence import mark_existing
from salestax_spark.sources.inline import sql_literal
from salestax_spark.sources.reference_data import ZERO_TAX_STATES

# Fixed values.
COUNTED_CHARGE_STATUS = "succeeded"
SETTLED_ORDER_STATUSES = ("paid", "partially_refunded")


def missing_certificate(is_b2b: Column, certificate: Column) -> Column:
    return is_b2b.cast("boolean") & is_blank(certificate)


def in_taxable_state(state_column: str) -> Column:
    """As SQL text, because each literal of a long list costs a round trip to the JVM."""
    listed = ", ".join(map(sql_literal, ZERO_TAX_STATES))
    return F.expr(f"upper(trim({state_column})) IN ({listed})")


def zero_tax_in_taxable_state(tax: Column, state_column: str) -> Column:
    return (F.coalesce(tax, F.lit(0)) == 0) & in_taxable_state(state_column)


def zero_tax_order(tax: Column, state_column: str, financial_status: Column) -> Column:
    """An order that was never settled is not expected to carry tax."""
    return zero_tax_in_taxable_state(tax, state_column) & financial_status.isin(*SETTLED_ORDER_STATUSES)


def succeeded(charges: DataFrame) -> DataFrame:
    return charges.where(F.col("status") == COUNTED_CHARGE_STATUS)


def stage_charges(raw: DataFrame) -> DataFrame:
    tax = F.col("tax_amount_collected").cast("bigint")
    return succeeded(raw).select(
        "id",
        "object",
        "merchant_id",
        F.col("amount").cast("bigint").alias("amount_cents"),
        lower_text(F.col("currency")).alias("currency"),
        "status",
        from_epoch(F.col("created")).alias("created_at"),
        code(F.col("billing_state")).alias("billing_state"),
        "billing_zip",
        code(F.col("billing_country")).alias("billing_country"),
        F.col("is_b2b").cast("boolean").alias("is_b2b"),
        "exemption_cert_id",
        F.col("shopify_order_id").cast("string").alias("shopify_order_id"),
        tax.alias("tax_amount_collected_cents"),
        "source_store",
        is_blank(F.col("billing_state")).alias("is_missing_state"),
        is_blank(F.col("billing_zip")).alias("is_missing_zip"),
        missing_certificate(F.col("is_b2b"), F.col("exemption_cert_id")).alias("is_b2b_missing_cert"),
        zero_tax_in_taxable_state(tax, "billing_state").alias("is_zero_tax_taxable_state"),
    )


def order_time(text: Column) -> Column:
    """A time with a full date in front, its parts divided by ``-`` or ``/``; anything less (``12:30``, ``2024-05``) is NULL, not a guess.

    An offset is kept: ``12:00+02:00`` is 10:00 UTC.
    """
    plain = text.cast("string")
    dashed = F.regexp_replace(plain, r"^(\s*\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    dated = dashed.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}.*)?$")
    return F.when(dated, dashed.try_cast("timestamp"))


def stage_orders(raw: DataFrame) -> DataFrame:
    """Orders of every status. An unreadable creation time is NULL; unreadable money stops the run."""
    return raw.select(
        F.col("id").cast("bigint").alias("id"),
        "name",
        "merchant_id",
        "source_store",
        order_time(F.col("created_at")).alias("created_at"),
        lower_text(F.col("currency")).alias("currency"),
        *[F.col(money).cast("double").alias(money) for money in ("total_price", "subtotal_price", "total_tax")],
        "taxes_included",
        F.col("financial_status").cast("string").alias("financial_status"),
        code(F.col("billing_state")).alias("billing_state"),
        "billing_zip",
        code(F.col("billing_country")).alias("billing_country"),
        "stripe_charge_id",
        is_blank(F.col("billing_state")).alias("is_missing_state"),
        is_blank(F.col("billing_zip")).alias("is_missing_zip"),
    )


def type_refunds(raw: DataFrame) -> DataFrame:
    """Refund columns without the lookup that needs the charges."""
    return raw.select(
        "id",
        "object",
        "merchant_id",
        F.col("amount").cast("bigint").alias("amount_cents"),
        lower_text(F.col("currency")).alias("currency"),
        "status",
        from_epoch(F.col("created")).alias("created_at"),
        "charge_id",
    )


def stage_refunds(raw: DataFrame, charges: DataFrame) -> DataFrame:
    """``charges`` are the staged ones, so a refund of a failed charge is an orphan."""
    known = mark_existing(type_refunds(raw), "charge_id", charges.select("id"), "has_charge")
    return known.withColumn("is_orphan_refund", ~F.col("has_charge")).drop("has_charge")
