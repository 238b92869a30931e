"""One transaction set out of two systems, the payment record taking priority over the order.

All rows of both systems are shuffled once, by link key. What travels is kept narrow: the surrogate key,
the system name and the constant columns are added to the surviving rows afterwards.

Skew: ``row_number() = 1`` is planned with a group limit in front of the shuffle, so each map task passes on
one row per link key. A link key (or the NULL link) that owns a third of all rows reaches its reducer as one
row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestax_spark.functions.money import cents_to_units
from salestax_spark.functions.text import surrogate_key
from salestax_spark.operators.staging import zero_tax_order

# System names, also the first part of the surrogate key; a smaller rank wins.
PAYMENTS, PAYMENTS_RANK = "stripe", 1
STOREFRONT, STOREFRONT_RANK = "shopify", 2

_CARRIED = (
    "merchant_id",
    "source_store",
    "occurred_at",
    "subtotal_usd",
    "tax_collected_usd",
    "currency",
    "billing_state",
    "billing_zip",
    "billing_country",
    "is_b2b",
    "exemption_cert_id",
    "is_missing_state",
    "is_missing_zip",
    "is_b2b_missing_cert",
    "is_zero_tax_taxable_state",
)
_SLIM = ("source_rank", "order_id", "link_id", *_CARRIED)
#: Last key of the order within a link: names a record by all it carries, in one narrow column.
RECORD_HASH = "record_hash"

UNIFIED_COLUMNS = (
    "txn_key",
    "source_txn_id",
    "merchant_id",
    "source_store",
    "source_system",
    "occurred_at",
    "subtotal_usd",
    "tax_collected_usd",
    "currency",
    "is_refund",
    "parent_txn_id",
    "billing_state",
    "billing_zip",
    "billing_country",
    "is_b2b",
    "exemption_cert_id",
    "is_missing_state",
    "is_missing_zip",
    "is_b2b_missing_cert",
    "is_zero_tax_taxable_state",
)


def _slim(df: DataFrame, computed: dict[str, Column]) -> DataFrame:
    slim = df.select(*[computed[name].alias(name) if name in computed else name for name in _SLIM])
    carried = [F.col(name) for name in _CARRIED]
    # The hash skips NULLs, so which columns are NULL is hashed as well.
    return slim.withColumn(RECORD_HASH, F.xxhash64(*carried, *[column.isNull() for column in carried]))


def slim_charges(charges: DataFrame) -> DataFrame:
    """A charge is linked by its own id, so the id is not carried a second time."""
    tax = F.col("tax_amount_collected_cents")
    return _slim(
        charges,
        {
            "source_rank": F.lit(PAYMENTS_RANK),
            "order_id": F.lit(None).cast("string"),
            "link_id": F.col("id").cast("string"),
            "occurred_at": F.col("created_at"),
            "subtotal_usd": cents_to_units(F.col("amount_cents") - tax),
            "tax_collected_usd": cents_to_units(tax),
        },
    )


def slim_orders(orders: DataFrame) -> DataFrame:
    """Orders carry no business-customer information of their own."""
    tax = F.col("total_tax")
    return _slim(
        orders,
        {
            "source_rank": F.lit(STOREFRONT_RANK),
            "order_id": F.col("id").cast("string"),
            "link_id": F.col("stripe_charge_id").cast("string"),
            "occurred_at": F.col("created_at"),
            "subtotal_usd": F.col("subtotal_price"),
            "tax_collected_usd": tax,
            "is_b2b": F.lit(False),
            "exemption_cert_id": F.lit(None).cast("string"),
            "is_b2b_missing_cert": F.lit(False),
            "is_zero_tax_taxable_state": zero_tax_order(tax, "billing_state", F.col("financial_status")),
        },
    )


def slim_rows(charges: DataFrame, orders: DataFrame) -> DataFrame:
    return slim_charges(charges).unionByName(slim_orders(orders))


def widen(slim: DataFrame, *extra: str) -> DataFrame:
    """The full shape, plus ``extra`` columns; what is added can be computed from the row itself."""
    is_payment = F.col("source_rank") == PAYMENTS_RANK
    system = F.when(is_payment, F.lit(PAYMENTS)).otherwise(F.lit(STOREFRONT))
    identifier = F.when(is_payment, F.col("link_id")).otherwise(F.col("order_id"))
    computed = {
        "txn_key": surrogate_key(system, identifier),
        "source_txn_id": identifier,
        "source_system": system,
        "is_refund": F.lit(False),
        "parent_txn_id": F.lit(None).cast("string"),
    }
    names = (*UNIFIED_COLUMNS, *extra)
    return slim.select(*[computed[name].alias(name) if name in computed else name for name in names])


def canonical_rows(charges: DataFrame, orders: DataFrame) -> DataFrame:
    """Both systems in one shape, before duplicates are removed; ``link_id`` is still there."""
    return widen(slim_rows(charges, orders), "link_id")


def rank_links(slim: DataFrame) -> DataFrame:
    """Adds ``rn``, the position within the link key: payments first, then id as text.

    Records that repeat an id are ordered by a hash of all they carry, so that neither the order of arrival nor a task run twice changes
    which one stays. The hash is taken at the scan; of the columns themselves only those that a mart reads reach the shuffle.
    """
    preference = [F.col("source_rank"), F.col("order_id").asc_nulls_last(), F.col(RECORD_HASH)]
    return slim.withColumn("rn", F.row_number().over(Window.partitionBy("link_id").orderBy(*preference)))


def first_per_link(slim: DataFrame) -> DataFrame:
    return rank_links(slim).where(F.col("rn") == 1).drop("rn")


def unified_transactions(charges: DataFrame, orders: DataFrame, null_link: str = "collapse") -> DataFrame:
    """Staged charges and orders as one set.

    ``null_link`` says what happens to rows without a link: "collapse" treats them as one link, of which
    a single row stays; "keep" leaves all of them in, without shuffling them.
    """
    slim = slim_rows(charges, orders)
    if null_link == "collapse":
        kept = first_per_link(slim)
    elif null_link == "keep":
        unlinked = F.col("link_id").isNull()
        kept = first_per_link(slim.where(~unlinked)).unionByName(slim.where(unlinked))
    else:
        raise ValueError(f"null_link must be 'collapse' or 'keep', not {null_link!r}")
    return widen(kept)
