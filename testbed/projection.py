"""The generic order tables seen as charges, orders and refunds (rules in FIXTURES.md, section 2).

Every order gives one storefront order and one charge, some charges come twice, and every returned line
item gives a refund. Nothing is left out; defects are set by arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salestax_spark.sources import reference_data
from salestax_spark.sources.reference_data import ZERO_TAX_STATES

AS_OF = "2001-08-01"

# Raw billing state by nation key 0..24; nation 19 has none.
STATES = ["CA", "TX", "NY", "FL", "WA", "IL", "PA", "OH", "GA", "NC", "NJ", "VA", "AZ", "OR", "MT", "NH", "DE", "AK",
          "DC", None, "", " ca ", "PR", "XQ", "QC"]

# Only the columns the projection needs; with them declared, no job is spent on reading footers.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string",
}


def _texts(values: list) -> str:
    return ", ".join("NULL" if v is None else f"'{v}'" for v in values)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


ORDER_FACTS = [
    "k",
    "cust",
    "CASE WHEN u < 8 THEN 'merch_acme_foods' WHEN u < 12 THEN 'merch_ridge_gear' WHEN u < 14 THEN 'merch_nova_health'"
    " WHEN u = 14 THEN 'merch_surf_co' ELSE 'merch_graze_box' END AS merchant_id",
    "CASE WHEN u < 8 THEN 'acme-foods-main' WHEN u < 12 AND k % 100 < 72 THEN 'ridge-gear-us'"
    " WHEN u < 12 THEN 'ridge-gear-ca' WHEN u < 14 THEN 'nova-health-b2b' WHEN u = 14 THEN 'surf-co-eu'"
    " ELSE 'graze-box-dtc' END AS source_store",
    "CAST(round(o_totalprice / 10e0) AS bigint) AS amount",
    "unix_date(day) * 86400L + k % 86400 AS created",
    "CASE WHEN k % 50 = 7 OR k % 97 = 3 THEN 'failed' ELSE 'succeeded' END AS status",
    "CASE WHEN u = 14 AND k % 10 >= 3 THEN 'EUR' ELSE 'USD' END AS currency",
    "day",
]

BASE = [
    *["k", "merchant_id", "source_store", "amount", "created", "status", "currency", "day", "billing_state"],
    "CASE WHEN k % 61 = 11 THEN '' WHEN n <> 19 THEN CAST(10000 + k % 89999 AS string) END AS billing_zip",
    "CASE WHEN n = 23 THEN 'FR' WHEN n = 24 THEN 'CA' WHEN k % 2 = 0 THEN 'US' ELSE ' usa' END AS billing_country",
    "k % 10 = 1 AS is_b2b",
    "CASE WHEN k % 10 <> 1 OR k % 20 = 1 THEN NULL WHEN k % 40 = 31 THEN '  ' ELSE 'CERT-' || k END AS exemption_cert_id",
    f"CASE WHEN upper(trim(billing_state)) IN ({_texts(ZERO_TAX_STATES)}) AND k % 33 <> 0 AND k % 50 <> 7"
    " THEN amount * (475 + k % 556) div 10000 WHEN n = 19 AND k % 7 = 0 THEN amount div 20 ELSE 0L END AS tax",
]

CHARGE = [
    "copy.prefix || k AS id",
    "'charge' AS object",
    *["merchant_id", "amount", "currency", "status", "created", "tax AS tax_amount_collected"],
    "copy.store AS source_store",
    *["billing_state", "billing_zip", "billing_country", "is_b2b", "exemption_cert_id"],
    "CAST(k AS string) AS shopify_order_id",
]

ORDER = [
    "k AS id",
    "'#' || k % 100000 AS name",
    *["merchant_id", "source_store"],
    "day || 'T' || lpad(k % 86400 div 3600, 2, '0') || ':' || lpad(k % 3600 div 60, 2, '0') || ':'"
    " || lpad(k % 60, 2, '0') || '+0000' AS created_at",
    "currency",
    "amount / 100e0 AS total_price",
    "(amount - tax) / 100e0 AS subtotal_price",
    "tax / 100e0 AS total_tax",
    "false AS taxes_included",
    "CASE WHEN k % 50 = 7 THEN 'pending' WHEN k % 20 = 4 THEN 'partially_refunded' ELSE 'paid' END AS financial_status",
    "CASE WHEN k % 200 <> 9 THEN 'ch_' || k END AS stripe_charge_id",
    *["billing_state", "billing_zip", "billing_country"],
]

REFUND = [
    "'re_' || l_orderkey || '_' || l_partkey || '_' || l_linenumber AS id",
    "'refund' AS object",
    "merchant_id",
    "CAST(round(l_extendedprice) AS bigint) AS amount",
    *["currency", "status", "created"],
    "CASE WHEN l_orderkey % 331 = 0 THEN NULL WHEN l_orderkey % 50 = 0 THEN 'ch_FAKE_' || l_orderkey"
    " ELSE 'ch_' || l_orderkey END AS charge_id",
]


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What depends on the order alone."""
    keyed = _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey AS cust", "o_custkey % 16 AS u", "o_totalprice", "CAST(o_orderdate AS date) AS day"
    )
    return keyed.selectExpr(*ORDER_FACTS)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts with the buyer's address and the tax that follows from it."""
    customers = _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS cust", "c_nationkey AS n", f"element_at(array({_texts(STATES)}), c_nationkey + 1) AS billing_state"
    )
    return order_facts(spark, sf_dir).join(customers, "cust").selectExpr(*BASE)


def raw_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One charge per order; some orders of one store were also charged in the sister store."""
    own = "named_struct('prefix', 'ch_', 'store', source_store)"
    clone = "named_struct('prefix', 'ch_dup_', 'store', 'ridge-gear-ca')"
    copies = f"CASE WHEN source_store = 'ridge-gear-us' AND k % 12 = 5 THEN array({own}, {clone}) ELSE array({own}) END"
    return base(spark, sf_dir).selectExpr("*", f"explode({copies}) AS copy").selectExpr(*CHARGE)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).selectExpr(*ORDER)


def raw_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = _read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    facts = order_facts(spark, sf_dir).withColumnRenamed("k", "l_orderkey")
    return returned.join(facts, "l_orderkey").selectExpr(*REFUND)


def charge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw charges wrapped back into the nested form the payment system delivers."""
    return raw_charges(spark, sf_dir).selectExpr(
        *["id", "object", "merchant_id", "amount", "currency", "status", "created"],
        "named_struct('email', 'a@example.com', 'name', 'A', 'address', named_struct('city', 'Springfield', 'country',"
        " billing_country, 'line1', '1 Main St', 'postal_code', billing_zip, 'state', billing_state)) AS billing_details",
        "struct(shopify_order_id, is_b2b, exemption_cert_id) AS metadata",
        *["tax_amount_collected", "source_store"],
    )


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = raw_orders(spark, sf_dir)
    return flat.selectExpr(
        *[name for name in flat.columns if not name.startswith("billing_")],
        "named_struct('address1', '1 Main St', 'city', 'Springfield', 'province_code', billing_state,"
        " 'country_code', billing_country, 'zip', billing_zip) AS billing_address",
        "array(named_struct('name', 'is_b2b', 'value', 'false')) AS note_attributes",
    )


def scaled_thresholds(spark: SparkSession) -> DataFrame:
    """Lower thresholds, so that the test data reaches every exposure tier."""
    return reference_data.threshold_table(spark).selectExpr(
        *["state_code", "state_name", "has_sales_tax", "sales_threshold_usd / 50e0 AS sales_threshold_usd"],
        *["transaction_threshold / 20e0 AS transaction_threshold", "threshold_logic", "notes"],
    )
