"""Data-quality checks. A check lists the rows that break it and passes when there are none."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestax_spark.functions.text import check_label, is_blank, lower_text
from salestax_spark.operators.issues import currency_mismatch_rows, with_currency_flag
from salestax_spark.sources.inline import inline_table
from salestax_spark.sources.reference_data import ORPHAN_REFUND

# Check names and statuses as they appear in the report.
CHECK_B2B = "assert_no_b2b_missing_exemption_cert"
CHECK_CURRENCY = "assert_no_currency_mismatch"
CHECK_DUPLICATES = "assert_no_duplicate_txn_ids"
CHECK_ORPHANS = "assert_no_refund_without_parent"
CHECK_TAX_NO_STATE = "assert_no_tax_collected_missing_state"
CHECK_ZERO_TAX = "assert_no_zero_tax_in_taxable_state"
CHECKS = (CHECK_B2B, CHECK_CURRENCY, CHECK_DUPLICATES, CHECK_ORPHANS, CHECK_TAX_NO_STATE, CHECK_ZERO_TAX)
PASSED, FAILED = "passed", "failed"

LOG = logging.getLogger(__name__)
#: What a query that fails raises.
ERRORS = (PySparkException, Py4JJavaError)


def b2b_without_certificate(charges: DataFrame) -> DataFrame:
    return charges.where("is_b2b_missing_cert")


def off_currency(charges: DataFrame, merchants: DataFrame) -> DataFrame:
    return currency_mismatch_rows(charges, merchants)


def cross_store_duplicates(charges: DataFrame) -> DataFrame:
    """Orders of a merchant charged in more than one store. The stores of an order are few; one shuffle."""
    return (
        charges.groupBy("merchant_id", "shopify_order_id")
        .agg(F.size(F.collect_set("source_store")).cast("bigint").alias("store_cnt"))
        .where(F.col("store_cnt") > 1)
    )


def orphan_refunds(staged_refunds: DataFrame) -> DataFrame:
    return staged_refunds.where("is_orphan_refund")


def _tax_without_state():
    return (F.coalesce("tax_amount_collected_cents", F.lit(0)) > 0) & is_blank(F.col("billing_state"))


def tax_without_state(charges: DataFrame) -> DataFrame:
    return charges.where(_tax_without_state())


def untaxed_in_taxable_state(charges: DataFrame) -> DataFrame:
    return charges.where("is_zero_tax_taxable_state")


def violating_rows(charges: DataFrame, merchants: DataFrame, staged_refunds: DataFrame) -> dict[str, DataFrame]:
    """The rows behind every check, for looking into a failure; lazy."""
    return {
        CHECK_B2B: b2b_without_certificate(charges),
        CHECK_CURRENCY: off_currency(charges, merchants),
        CHECK_DUPLICATES: cross_store_duplicates(charges),
        CHECK_ORPHANS: orphan_refunds(staged_refunds),
        CHECK_TAX_NO_STATE: tax_without_state(charges),
        CHECK_ZERO_TAX: untaxed_in_taxable_state(charges),
    }


def _one_row_checks(charges: DataFrame, merchants: DataFrame) -> DataFrame:
    """The four row-level checks in a single scan; the currency test runs on the aggregated rows."""
    by_currency = charges.groupBy("merchant_id", lower_text(F.col("currency")).alias("currency")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("is_b2b_missing_cert")).alias("b2b"),
        F.count_if(_tax_without_state()).alias("tax_no_state"),
        F.count_if(F.col("is_zero_tax_taxable_state")).alias("zero_tax"),
    )
    totals = with_currency_flag(by_currency, merchants).agg(
        F.sum("b2b").alias(CHECK_B2B),
        F.sum(F.when(F.col("is_currency_mismatch"), F.col("rows"))).alias(CHECK_CURRENCY),
        F.sum("tax_no_state").alias(CHECK_TAX_NO_STATE),
        F.sum("zero_tax").alias(CHECK_ZERO_TAX),
    )
    return totals.unpivot([], totals.columns, "test_name", "violations")


def violation_counts(charges: DataFrame, merchants: DataFrame, orphan_counts: DataFrame) -> DataFrame:
    """``test_name``, ``violations``: one row per check, from staged charges and counted orphan refunds."""
    duplicates = cross_store_duplicates(charges).agg(F.count("*").alias("violations"))
    orphans = orphan_counts.agg(F.sum(ORPHAN_REFUND.issue_type).alias("violations"))
    counted = (
        _one_row_checks(charges, merchants)
        .unionByName(duplicates.withColumn("test_name", F.lit(CHECK_DUPLICATES)))
        .unionByName(orphans.withColumn("test_name", F.lit(CHECK_ORPHANS)))
    )
    return counted.withColumn("violations", F.coalesce("violations", F.lit(0)).cast("bigint"))


def counted_one_by_one(charges: DataFrame, merchants: DataFrame, orphan_counts: DataFrame) -> DataFrame:
    """``violation_counts`` with a job per check, for when the single pass fails: a check that errors has a NULL count."""

    def number(rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*"))

    counts = {
        CHECK_B2B: lambda: number(b2b_without_certificate(charges)),
        CHECK_CURRENCY: lambda: number(off_currency(charges, merchants)),
        CHECK_DUPLICATES: lambda: number(cross_store_duplicates(charges)),
        CHECK_ORPHANS: lambda: orphan_counts.agg(F.coalesce(F.sum(ORPHAN_REFUND.issue_type), F.lit(0))),
        CHECK_TAX_NO_STATE: lambda: number(tax_without_state(charges)),
        CHECK_ZERO_TAX: lambda: number(untaxed_in_taxable_state(charges)),
    }
    rows = []
    for name, count in counts.items():
        try:
            rows.append((name, count().first()[0]))
        except ERRORS as error:
            LOG.warning("%s could not be counted and has failed: %s", name, error)
            rows.append((name, None))
    return inline_table(charges.sparkSession, {"test_name": "string", "violations": "bigint"}, rows)


def check_results(violations: DataFrame, expected: tuple[str, ...] = CHECKS) -> DataFrame:
    """Status of every expected check; one that has no count has failed. A failing check stops nothing."""
    names = inline_table(violations.sparkSession, {"test_name": "string"}, [(name,) for name in expected])
    return (
        names.join(violations, "test_name", "left")
        .withColumn("status", F.when(F.col("violations") == 0, F.lit(PASSED)).otherwise(F.lit(FAILED)))
        .withColumn("label", check_label(F.col("test_name")))
        .orderBy("test_name")
    )


def check_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == PASSED).alias("passed"),
        F.count_if(F.col("status") != PASSED).alias("failed"),
    )
