"""Reference data the rules depend on: jurisdictions, nexus thresholds, merchants, issue catalogue.

All of it is small and fixed in code. Callers may pass their own DataFrames instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salestax_spark.sources import schemas
from salestax_spark.sources.inline import inline_table

# ---- Fixed values -------------------------------------------------------------------------------
# State code, name, whether it has a sales tax, threshold of sales in US dollars, of transactions, and how the two combine.
NEXUS_THRESHOLDS = (
    ("AL", "Alabama", True, 100000.0, 200, "OR"),
    ("AK", "Alaska", False, None, None, None),
    ("AZ", "Arizona", True, 100000.0, 200, "OR"),
    ("AR", "Arkansas", True, 100000.0, 200, "OR"),
    ("CA", "California", True, 500000.0, None, None),
    ("CO", "Colorado", True, 100000.0, 200, "OR"),
    ("CT", "Connecticut", True, 100000.0, 200, "OR"),
    ("DE", "Delaware", False, None, None, None),
    ("DC", "District of Columbia", True, 100000.0, 200, "OR"),
    ("FL", "Florida", True, 100000.0, 200, "OR"),
    ("GA", "Georgia", True, 100000.0, 200, "OR"),
    ("HI", "Hawaii", True, 100000.0, 200, "OR"),
    ("ID", "Idaho", True, 100000.0, 200, "OR"),
    ("IL", "Illinois", True, 100000.0, 200, "OR"),
    ("IN", "Indiana", True, 100000.0, 200, "OR"),
    ("IA", "Iowa", True, 100000.0, 200, "OR"),
    ("KS", "Kansas", True, 100000.0, 200, "OR"),
    ("KY", "Kentucky", True, 100000.0, 200, "OR"),
    ("LA", "Louisiana", True, 100000.0, 200, "OR"),
    ("ME", "Maine", True, 100000.0, 200, "OR"),
    ("MD", "Maryland", True, 100000.0, 200, "OR"),
    ("MA", "Massachusetts", True, 100000.0, 200, "OR"),
    ("MI", "Michigan", True, 100000.0, 200, "OR"),
    ("MN", "Minnesota", True, 100000.0, 200, "OR"),
    ("MS", "Mississippi", True, 100000.0, 200, "OR"),
    ("MO", "Missouri", True, 100000.0, 200, "OR"),
    ("MT", "Montana", False, None, None, None),
    ("NE", "Nebraska", True, 100000.0, 200, "OR"),
    ("NV", "Nevada", True, 100000.0, 200, "OR"),
    ("NH", "New Hampshire", False, None, None, None),
    ("NJ", "New Jersey", True, 100000.0, 200, "OR"),
    ("NM", "New Mexico", True, 100000.0, 200, "OR"),
    ("NY", "New York", True, 500000.0, 100, "AND"),
    ("NC", "North Carolina", True, 100000.0, 200, "OR"),
    ("ND", "North Dakota", True, 100000.0, 200, "OR"),
    ("OH", "Ohio", True, 100000.0, 200, "OR"),
    ("OK", "Oklahoma", True, 100000.0, 200, "OR"),
    ("OR", "Oregon", False, None, None, None),
    ("PA", "Pennsylvania", True, 100000.0, 200, "OR"),
    ("RI", "Rhode Island", True, 100000.0, 200, "OR"),
    ("SC", "South Carolina", True, 100000.0, 200, "OR"),
    ("SD", "South Dakota", True, 100000.0, 200, "OR"),
    ("TN", "Tennessee", True, 100000.0, 200, "OR"),
    ("TX", "Texas", True, 500000.0, None, None),
    ("UT", "Utah", True, 100000.0, 200, "OR"),
    ("VT", "Vermont", True, 100000.0, 200, "OR"),
    ("VA", "Virginia", True, 100000.0, 200, "OR"),
    ("WA", "Washington", True, 100000.0, 200, "OR"),
    ("WV", "West Virginia", True, 100000.0, 200, "OR"),
    ("WI", "Wisconsin", True, 100000.0, 200, "OR"),
    ("WY", "Wyoming", True, 100000.0, 200, "OR"),
)

# States in which a sale without tax is suspicious.
ZERO_TAX_STATES = (
    "AL", "AZ", "AR", "CA", "CO", "CT", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY",
    "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "NE", "NV", "NJ", "NM", "NY", "NC", "ND",
    "OH", "OK", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)

# Currency of a merchant that is not in the merchant table.
FALLBACK_CURRENCY = "usd"

# id, name, default currency, stores.
KNOWN_MERCHANTS = (
    ("merch_acme_foods", "Acme Foods Co", "usd", ["acme-foods-main"]),
    ("merch_ridge_gear", "Ridge Gear Inc", "usd", ["ridge-gear-us", "ridge-gear-ca"]),
    ("merch_nova_health", "Nova Health Supplies", "usd", ["nova-health-b2b"]),
    ("merch_surf_co", "Surf Co Collective", "eur", ["surf-co-eu"]),
    ("merch_graze_box", "Graze Box Snacks", "usd", ["graze-box-dtc"]),
)
# ---- End of fixed values ------------------------------------------------------------------------


@dataclass(frozen=True)
class Issue:
    """One family of data problems: its key, weight, label and the advice shown next to the count."""

    issue_type: str
    severity: str
    label: str
    recommended_action: str


# Types, severities and labels are fixed values; the advice is this library's own wording.
MISSING_BILLING = Issue(
    "missing_billing_address",
    "high",
    "Missing billing address",
    "Complete the billing state and postal code in the payment and storefront records, then rerun.",
)
ZERO_TAX = Issue(
    "zero_tax_in_taxable_state",
    "high",
    "Zero tax in taxable state",
    "Check why no tax was charged on these sales although the buyer's state levies sales tax.",
)
B2B_CERTIFICATE = Issue(
    "b2b_missing_exemption_cert",
    "medium",
    "B2B missing exemption certificate",
    "Collect the buyer's exemption or resale certificate, or treat these business sales as taxable.",
)
CURRENCY = Issue(
    "currency_mismatch",
    "medium",
    "Currency mismatch",
    "Bring the transaction currency in line with the merchant's default before totals are compared.",
)
ORPHAN_REFUND = Issue(
    "orphan_refund",
    "high",
    "Orphan refund",
    "Find the charge each refund belongs to, or leave the refund out of the load.",
)
ISSUES = (MISSING_BILLING, ZERO_TAX, B2B_CERTIFICATE, CURRENCY, ORPHAN_REFUND)


def threshold_rows() -> list[tuple]:
    """One row per jurisdiction in the shape of the threshold file, with an empty remark."""
    return [(*row, None) for row in NEXUS_THRESHOLDS]


def threshold_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.THRESHOLD_COLUMNS, threshold_rows())


def merchant_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.MERCHANT_COLUMNS, KNOWN_MERCHANTS)
