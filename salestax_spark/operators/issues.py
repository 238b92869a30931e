"""Data problems counted per merchant.

The four families that come from unified transactions are counted in one pass: one aggregation by merchant and
currency with conditional counts, combined in front of the shuffle. Only its few result rows are compared
with the merchant's default currency and turned into one row per family.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestax_spark.functions.text import lower_text
from salestax_spark.operators.existence import count_missing
from salestax_spark.sources.reference_data import (
    B2B_CERTIFICATE,
    CURRENCY,
    FALLBACK_CURRENCY,
    ISSUES,
    MISSING_BILLING,
    ORPHAN_REFUND,
    ZERO_TAX,
    Issue,
)


def missing_billing() -> Column:
    return F.col("is_missing_state") | F.col("is_missing_zip")


def default_currencies(merchants: DataFrame) -> DataFrame:
    """One row per merchant; of a repeated id the first currency by alphabet counts, so that no row is doubled."""
    return merchants.groupBy(F.col("id").alias("merchant_id")).agg(F.min(F.lower("currency")).alias("default_currency"))


def with_currency_flag(rows: DataFrame, merchants: DataFrame) -> DataFrame:
    """Adds ``is_currency_mismatch``; a NULL currency gives NULL, an unknown merchant uses the fallback."""
    expected = F.coalesce("default_currency", F.lit(FALLBACK_CURRENCY))
    return (
        rows.join(default_currencies(merchants), "merchant_id", "left")
        .withColumn("is_currency_mismatch", lower_text(F.col("currency")) != expected)
        .drop("default_currency")
    )


def currency_mismatch_rows(rows: DataFrame, merchants: DataFrame) -> DataFrame:
    return with_currency_flag(rows, merchants).where("is_currency_mismatch").select(*rows.columns)


def missing_billing_rows(unified: DataFrame) -> DataFrame:
    return unified.where(missing_billing())


#: Families counted on unified rows: the flag of a row that has the problem.
_ROW_FLAGS = {
    MISSING_BILLING.issue_type: missing_billing,
    ZERO_TAX.issue_type: lambda: F.col("is_zero_tax_taxable_state"),
    B2B_CERTIFICATE.issue_type: lambda: F.col("is_b2b_missing_cert"),
}


def merchant_profile(unified: DataFrame, merchants: DataFrame, families: tuple[Issue, ...] = ISSUES) -> DataFrame:
    """Per merchant: rows of each of the ``families``, and of all sales. One shuffle, of pre-aggregated rows.

    Only columns the families need are read; the currency is a key only where the currency family is among them.
    """
    types = [f.issue_type for f in families]
    flagged = [F.count_if(flag()).alias(t) for t, flag in _ROW_FLAGS.items() if t in types]
    sales = F.count_if(~F.col("is_refund")).alias("total_transactions")
    if CURRENCY.issue_type not in types:
        return unified.groupBy("merchant_id").agg(*flagged, sales)
    by_currency = unified.groupBy("merchant_id", lower_text(F.col("currency")).alias("currency")).agg(F.count("*").alias("rows"), *flagged, sales)
    return (
        with_currency_flag(by_currency, merchants)
        .groupBy("merchant_id")
        .agg(
            *[F.sum(t).alias(t) for t in _ROW_FLAGS if t in types],
            F.sum(F.when(F.col("is_currency_mismatch"), F.col("rows")).otherwise(0)).alias(CURRENCY.issue_type),
            F.sum("total_transactions").alias("total_transactions"),
        )
    )


def orphan_refund_counts(refunds: DataFrame, charges: DataFrame) -> DataFrame:
    """Raw refunds against staged charges, counted per merchant."""
    return count_missing(refunds, "merchant_id", "charge_id", charges.select("id"), ORPHAN_REFUND.issue_type)


def _issue_rows(counts: DataFrame, families: tuple[Issue, ...]) -> DataFrame:
    """One count column per family to one row per family; families without a row in the data are left out."""
    entries = [
        F.struct(
            F.lit(f.issue_type).alias("issue_type"),
            F.col(f.issue_type).cast("bigint").alias("issue_count"),
            F.lit(f.severity).alias("severity"),
            F.lit(f.recommended_action).alias("recommended_action"),
        )
        for f in families
    ]
    exploded = counts.select("merchant_id", F.explode(F.array(*entries)).alias("issue"))
    return exploded.select("merchant_id", "issue.*").where(F.col("issue_count") > 0)


def data_issues(
    unified: DataFrame,
    merchants: DataFrame,
    orphan_counts: DataFrame,
    catalogue: tuple[Issue, ...] = ISSUES,
) -> DataFrame:
    """``catalogue`` names the families to be counted and may carry another wording of the advice; others are not computed.

    ``orphan_counts`` comes from ``orphan_refund_counts``, which the check suite uses as well.
    """
    return issues_of_profile(merchant_profile(unified, merchants, catalogue), orphan_counts, catalogue)


def issues_of_profile(profile: DataFrame, orphan_counts: DataFrame, catalogue: tuple[Issue, ...] = ISSUES) -> DataFrame:
    """``data_issues`` from a merchant profile that is there already."""
    of_refunds = tuple(f for f in catalogue if f.issue_type == ORPHAN_REFUND.issue_type)
    of_transactions = tuple(f for f in catalogue if f.issue_type != ORPHAN_REFUND.issue_type)
    parts = [_issue_rows(counts, families) for counts, families in ((profile, of_transactions), (orphan_counts, of_refunds)) if families]
    return reduce(DataFrame.unionByName, parts)


def issue_family(issues: DataFrame, family: Issue) -> DataFrame:
    return issues.where(F.col("issue_type") == family.issue_type)


def transaction_counts(unified: DataFrame) -> DataFrame:
    return (
        unified.where(~F.col("is_refund")).groupBy("merchant_id").agg(F.count("*").alias("total_transactions"))
    )


def counts_of_profile(profile: DataFrame) -> DataFrame:
    """``transaction_counts`` from a merchant profile, without another scan of the transactions."""
    return profile.where(F.col("total_transactions") > 0).select("merchant_id", "total_transactions")
