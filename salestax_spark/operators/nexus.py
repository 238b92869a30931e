"""Economic nexus: trailing sales per merchant and state against the state's thresholds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestax_spark.functions.dates import as_date, months_before, utc_midnight
from salestax_spark.functions.money import exact_total
from salestax_spark.functions.text import as_text, code, is_blank, lower_text, null_if_blank

# Fixed values.
US_COUNTRY_CODES = ("US", "USA")
NO_SALES_TAX, BELOW, AT, HIGH = "no_sales_tax", "below_threshold", "at_threshold", "high_exposure"
HIGH_EXPOSURE_FACTOR = 2

NEXUS_COLUMNS = (
    "merchant_id",
    "state_code",
    "state_name",
    "trailing_12m_sales_usd",
    "trailing_12m_transactions",
    "sales_threshold_usd",
    "transaction_threshold",
    "threshold_logic",
    "has_sales_tax",
    "has_crossed_nexus_threshold",
    "exposure_tier",
)


#: Month of a transaction, YYYY-MM, where the unified table is kept in a folder per month.
MONTH = "occurred_month"


def with_month(unified: DataFrame) -> DataFrame:
    return unified.withColumn(MONTH, F.date_format(F.to_utc_timestamp("occurred_at", F.current_timezone()), "yyyy-MM"))


def not_refunds(unified: DataFrame) -> DataFrame:
    return unified.where(~F.col("is_refund"))


def trailing(unified: DataFrame, as_of: dt.date | str | None = None, months: int = 12) -> DataFrame:
    """Rows from midnight UTC of the day ``months`` before ``as_of`` (default today); no upper bound.

    Of a table kept by month only the folders from that month on are listed.
    """
    first_day = months_before(as_date(as_of), months)
    if MONTH in unified.columns:
        unified = unified.where(F.col(MONTH) >= first_day.strftime("%Y-%m"))
    return unified.where(F.col("occurred_at") >= utc_midnight(first_day))


def us_known_state(unified: DataFrame) -> DataFrame:
    in_us = code(F.col("billing_country")).isin(*US_COUNTRY_CODES)
    return unified.where(~is_blank(F.col("billing_state")) & in_us)


def state_sales(unified: DataFrame, as_of: dt.date | str | None = None, months: int = 12) -> DataFrame:
    """Sales and transactions per merchant and state. One row per pair, so everything after it is small."""
    eligible = us_known_state(trailing(not_refunds(unified), as_of, months))
    return eligible.groupBy("merchant_id", F.col("billing_state").alias("state_code")).agg(
        exact_total(F.col("subtotal_usd") + F.col("tax_collected_usd")).alias("trailing_12m_sales_usd"),
        F.count("*").alias("trailing_12m_transactions"),
    )


def _whole_number(value: Column) -> Column:
    return F.round(null_if_blank(value).try_cast("decimal(38,6)")).try_cast("bigint")


def clean_thresholds(thresholds: DataFrame) -> DataFrame:
    """Threshold file in any typing to fixed types; what cannot be read as a number is NULL."""
    return thresholds.select(
        "state_code",
        "state_name",
        F.trim(lower_text(F.col("has_sales_tax"))).alias("has_sales_tax"),
        null_if_blank(F.col("sales_threshold_usd")).try_cast("double").alias("sales_threshold_usd"),
        _whole_number(F.col("transaction_threshold")).alias("transaction_threshold"),
        null_if_blank(F.col("threshold_logic")).alias("threshold_logic"),
    )


def attach_thresholds(sales: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Sales in a jurisdiction without a threshold row are left out.

    No join hint: both sides are small, and Spark broadcasts the table if its size allows.
    """
    return sales.join(thresholds, "state_code")


def crossed() -> Column:
    """Both tests must hold for AND states; elsewhere one is enough, and a state may have only the sales test."""
    sales_hit = F.col("trailing_12m_sales_usd") >= F.col("sales_threshold_usd")
    count_hit = F.col("trailing_12m_transactions") >= F.col("transaction_threshold")
    return (
        F.when(F.col("has_sales_tax") == "false", F.lit(False))
        .when(F.upper("threshold_logic") == "AND", sales_hit & count_hit)
        .otherwise(sales_hit | F.coalesce(count_hit, F.lit(False)))
    )


def tier() -> Column:
    """An undecided crossing (NULL) counts as at the threshold."""
    is_high = F.col("trailing_12m_sales_usd") >= HIGH_EXPOSURE_FACTOR * F.col("sales_threshold_usd")
    return (
        F.when(F.col("has_sales_tax") == "false", F.lit(NO_SALES_TAX))
        .when(~F.col("has_crossed_nexus_threshold"), F.lit(BELOW))
        .when(is_high, F.lit(HIGH))
        .otherwise(F.lit(AT))
    )


def classify(joined: DataFrame) -> DataFrame:
    return (
        joined.withColumn("has_crossed_nexus_threshold", crossed())
        .withColumn("exposure_tier", tier())
        .select(*NEXUS_COLUMNS)
    )


def nexus_exposure(
    unified: DataFrame, thresholds: DataFrame, as_of: dt.date | str | None = None, months: int = 12
) -> DataFrame:
    sales = state_sales(unified, as_of, months)
    return classify(attach_thresholds(sales, clean_thresholds(thresholds)))
