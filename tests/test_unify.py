import hashlib

import pytest
from pyspark.sql import functions as F

from builders import formatted_plan, raw_charges, raw_orders
from salestax_spark.operators import nexus, staging, unify


def _unified(spark, charges, orders, **options):
    return unify.unified_transactions(
        staging.stage_charges(raw_charges(spark, *charges)), staging.stage_orders(raw_orders(spark, *orders)), **options
    )


def _ids(df):
    return sorted((r.source_system, r.source_txn_id) for r in df.collect())


def test_charge_wins_over_its_order(spark):
    df = _unified(spark, [{"id": "c1"}], [{"id": 1, "stripe_charge_id": "c1"}, {"id": 2, "stripe_charge_id": "c9"}])
    assert _ids(df) == [("shopify", "2"), ("stripe", "c1")]


def test_order_of_a_failed_charge_enters(spark):
    orders = [{"id": 1, "stripe_charge_id": "c1", "financial_status": "pending"}]
    assert _ids(_unified(spark, [{"id": "c1", "status": "failed"}], orders)) == [("shopify", "1")]


def test_of_two_orders_the_lower_id_as_text_stays(spark):
    orders = [{"id": 9, "stripe_charge_id": "x"}, {"id": 10, "stripe_charge_id": "x"}]
    assert _ids(_unified(spark, [{"id": "c1"}], orders)) == [("shopify", "10"), ("stripe", "c1")]


def test_orders_without_link(spark):
    orders = [{"id": 3}, {"id": 20}, {"id": 4, "stripe_charge_id": "z"}]
    assert _ids(_unified(spark, [{"id": "c1"}], orders)) == [("shopify", "20"), ("shopify", "4"), ("stripe", "c1")]
    kept = _unified(spark, [{"id": "c1"}], orders, null_link="keep")
    assert _ids(kept) == [("shopify", "20"), ("shopify", "3"), ("shopify", "4"), ("stripe", "c1")]
    with pytest.raises(ValueError, match="null_link"):
        _unified(spark, [{"id": "c1"}], orders, null_link="drop")


def test_clone_with_its_own_id_is_not_removed(spark):
    charges = [{"id": "c1"}, {"id": "c2", "source_store": "other"}]
    assert len(_ids(_unified(spark, charges, [{"id": 1, "stripe_charge_id": "c1"}]))) == 2


def test_repeated_charge_id_leaves_one_row(spark):
    charges, orders = [{"id": "c1", "amount": 500}, {"id": "c1", "amount": 400}], [{"id": 1, "stripe_charge_id": "c1"}]
    one, other = (_unified(spark, order, orders).collect() for order in (charges, charges[::-1]))
    assert one == other and len(one) == 1 and one[0].source_txn_id == "c1" and one[0].subtotal_usd in (-3.0, -4.0)


def test_columns_of_both_systems(spark):
    df = _unified(
        spark,
        [{"id": "c1", "amount": 12345, "tax_amount_collected": 345, "is_b2b": True, "exemption_cert_id": "E"}],
        [{"id": 7, "stripe_charge_id": "c7", "total_tax": "0.00", "currency": "EUR"}],
    )
    assert tuple(df.columns) == unify.UNIFIED_COLUMNS
    charge, order = sorted(df.collect(), key=lambda r: r.source_system, reverse=True)
    assert (charge.subtotal_usd, charge.tax_collected_usd, charge.is_b2b, charge.exemption_cert_id) == (120.0, 3.45, True, "E")
    assert charge.txn_key == hashlib.md5(b"stripec1").hexdigest()
    assert order.txn_key == hashlib.md5(b"shopify7").hexdigest()
    assert (order.subtotal_usd, order.tax_collected_usd, order.currency) == (92.0, 0.0, "eur")
    assert (order.is_b2b, order.exemption_cert_id, order.is_b2b_missing_cert) == (False, None, False)
    assert order.is_zero_tax_taxable_state is True
    assert {r.is_refund for r in (charge, order)} == {False} and {r.parent_txn_id for r in (charge, order)} == {None}


def test_unknown_tax_gives_null_money(spark):
    charge = [{"id": "c1", "tax_amount_collected": None}]
    row = _unified(spark, charge, [{"id": 1, "stripe_charge_id": "c1"}]).first()
    assert (row.subtotal_usd, row.tax_collected_usd) == (None, None)


def test_hot_link_against_brute_force(spark):
    """A third of the orders share one link, a third have none."""
    orders = staging.stage_orders(
        raw_orders(spark, {"id": 0})
        .drop("id", "stripe_charge_id")
        .crossJoin(spark.range(3000))
        .withColumn(
            "stripe_charge_id",
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("c"), F.col("id"))),
        )
    )
    charges = staging.stage_charges(raw_charges(spark, {"id": "c1"}, {"id": "c4"}))
    best = {}
    for row in [(1, r.id, r.id) for r in charges.collect()] + [(2, str(r.id), r.stripe_charge_id) for r in orders.collect()]:
        link = row[2]
        best[link] = min(best.get(link, row[:2]), row[:2])
    got = unify.unified_transactions(charges, orders).collect()
    assert sorted((1 if r.source_system == "stripe" else 2, r.source_txn_id) for r in got) == sorted(best.values())


def test_links_are_cut_to_one_row_in_front_of_the_single_shuffle(spark):
    df = _unified(spark, [{"id": "c1"}], [{"id": 1}])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(link_id") == 1 == plan.count("Exchange")
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_unused_columns_do_not_travel(spark):
    df = _unified(spark, [{"id": "c1"}], [{"id": 1}]).groupBy("merchant_id").count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Union")[0]
    assert "is_missing_zip" not in above and "order_name" not in above and "is_b2b#" not in above


def test_of_equal_records_but_for_one_column_the_same_stays(spark):
    """Two deliveries of a charge that differ in a column no mart reads: the winner does not depend on the order of arrival."""
    for column, values in {"exemption_cert_id": ["C1", "C2", None], "is_b2b": [True, False, None], "billing_zip": ["1", "", None]}.items():
        rows = [{"id": "c1", column: v} for v in values]
        winners = {
            tuple(_unified(spark, order, [{"id": 1, "stripe_charge_id": "c1"}]).first())
            for order in (rows, rows[::-1], rows[1:] + rows[:1])
        }
        assert len(winners) == 1, column


def test_a_mart_shuffles_its_own_columns_and_the_hash(spark):
    charges, orders = staging.stage_charges(raw_charges(spark, {"id": "c1"})), staging.stage_orders(raw_orders(spark, {"id": 1}))
    sales = nexus.state_sales(unify.unified_transactions(charges, orders), "2024-06-01")
    exchanged = formatted_plan(spark, sales).split("Exchange\nInput", 1)[1].splitlines()[0]
    names = {part.split("#")[0].strip(" [") for part in exchanged.split(": ", 1)[1].split(", ")}
    assert names == {
        "link_id", "source_rank", "order_id", unify.RECORD_HASH,
        "merchant_id", "occurred_at", "subtotal_usd", "tax_collected_usd", "billing_state", "billing_country",
    }
