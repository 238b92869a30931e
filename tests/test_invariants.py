"""Properties that hold whatever the data, on the sf0.01 tables."""

import pytest
from pyspark.sql import functions as F

from salestax_spark.operators import issues, nexus, staging, unify
from salestax_spark.sources import reference_data
from testbed import projection

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def layers(spark):
    charges = staging.stage_charges(projection.raw_charges(spark, SF)).cache()
    orders = staging.stage_orders(projection.raw_orders(spark, SF)).cache()
    unified = unify.unified_transactions(charges, orders).cache()
    yield charges, orders, unified
    for df in (charges, orders, unified):
        df.unpersist()


def test_every_succeeded_charge_appears_once(layers):
    charges, _, unified = layers
    from_charges = unified.where("source_system = 'stripe'").select("source_txn_id")
    assert from_charges.exceptAll(charges.select("id")).isEmpty()
    assert charges.select("id").exceptAll(from_charges).isEmpty()


def test_no_link_has_two_rows(layers):
    charges, orders, unified = layers
    links = orders.select(F.col("id").cast("string").alias("source_txn_id"), "stripe_charge_id")
    from_orders = unified.where("source_system = 'shopify'").join(links, "source_txn_id")
    assert from_orders.count() == from_orders.select("stripe_charge_id").distinct().count() == 453
    assert from_orders.join(charges, F.col("stripe_charge_id") == charges.id, "left_semi").isEmpty()


def test_keys_are_unique(layers):
    unified = layers[2]
    assert unified.select("txn_key").distinct().count() == unified.count()


def test_keep_adds_exactly_the_other_unlinked_orders(layers):
    charges, orders, unified = layers
    kept = unify.unified_transactions(charges, orders, null_link="keep")
    unlinked = orders.where("stripe_charge_id IS NULL").count()
    assert kept.count() - unified.count() == unlinked - 1 == 74
    assert unified.exceptAll(kept).isEmpty()


def test_issue_counts_are_row_counts(spark, layers):
    unified = layers[2]
    profile = issues.merchant_profile(unified, reference_data.merchant_table(spark))
    totals = profile.agg(*[F.sum(c).alias(c) for c in profile.columns if c != "merchant_id"]).first()
    assert totals.missing_billing_address == issues.missing_billing_rows(unified).count()
    assert totals.zero_tax_in_taxable_state == unified.where("is_zero_tax_taxable_state").count()
    assert totals.b2b_missing_exemption_cert == unified.where("is_b2b_missing_cert").count()


def test_sales_add_up(layers):
    unified = layers[2]
    rows = nexus.us_known_state(nexus.trailing(unified, projection.AS_OF))
    cents = rows.agg(F.sum(F.round((F.col("subtotal_usd") + F.col("tax_collected_usd")) * 100).cast("bigint")).alias("c")).first().c
    sales = nexus.state_sales(unified, projection.AS_OF).collect()
    assert sum(round(r.trailing_12m_sales_usd * 100) for r in sales) == cents
    assert sum(r.trailing_12m_transactions for r in sales) == rows.count()


def test_totals_of_the_fixture(layers):
    unified = layers[2]
    assert unified.count() == 15238
    total = unified.agg(F.sum(F.round((F.col("subtotal_usd") + F.col("tax_collected_usd")) * 100).cast("bigint")).alias("c"))
    assert total.first().c == 381847769
