"""DuckDB text for the oracles: the projection of FIXTURES.md as common table expressions.

Written by hand and, where possible, along another line of thought than the library: winners by anti join instead
of ranking, issue counts by UNPIVOT, rules as separate mode columns.
"""

from __future__ import annotations

from salestax_spark.sources.reference_data import ISSUES
from testbed.projection import AS_OF, STATES


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)


# The oracle's own statement of the reference tables, by rule and exception, so that the library's rows are compared with something else.
STATE_NAMES = """
AL Alabama
AK Alaska
AZ Arizona
AR Arkansas
CA California
CO Colorado
CT Connecticut
DE Delaware
DC District of Columbia
FL Florida
GA Georgia
HI Hawaii
ID Idaho
IL Illinois
IN Indiana
IA Iowa
KS Kansas
KY Kentucky
LA Louisiana
ME Maine
MD Maryland
MA Massachusetts
MI Michigan
MN Minnesota
MS Mississippi
MO Missouri
MT Montana
NE Nebraska
NV Nevada
NH New Hampshire
NJ New Jersey
NM New Mexico
NY New York
NC North Carolina
ND North Dakota
OH Ohio
OK Oklahoma
OR Oregon
PA Pennsylvania
RI Rhode Island
SC South Carolina
SD South Dakota
TN Tennessee
TX Texas
UT Utah
VT Vermont
VA Virginia
WA Washington
WV West Virginia
WI Wisconsin
WY Wyoming
"""

NAMES = [(line[:2], line[3:]) for line in STATE_NAMES.strip().split("\n")]
UNTAXED = ("AK", "DE", "MT", "NH", "OR")
TAXED = ", ".join(_literal(state) for state, _ in NAMES if state not in (*UNTAXED, "DC"))
THRESHOLD_FILE = f"""SELECT state_code, state_name, state_code NOT IN ({", ".join(map(_literal, UNTAXED))}) AS has_sales_tax,
    CASE WHEN NOT has_sales_tax THEN NULL WHEN state_code IN ('CA', 'NY', 'TX') THEN 500000.0 ELSE 100000.0 END::DOUBLE AS sales_threshold_usd,
    CASE WHEN state_code = 'NY' THEN 100 WHEN has_sales_tax AND state_code NOT IN ('CA', 'TX') THEN 200 END::BIGINT AS transaction_threshold,
    CASE WHEN state_code = 'NY' THEN 'AND' WHEN transaction_threshold IS NOT NULL THEN 'OR' END AS threshold_logic
  FROM (VALUES {_values(NAMES)}) names(state_code, state_name)"""
MERCHANT_ROWS = [
    ("merch_acme_foods", "Acme Foods Co", "usd", 1),
    ("merch_graze_box", "Graze Box Snacks", "usd", 1),
    ("merch_nova_health", "Nova Health Supplies", "usd", 1),
    ("merch_ridge_gear", "Ridge Gear Inc", "usd", 2),
    ("merch_surf_co", "Surf Co Collective", "eur", 1),
]

RAW = f"""
state_by_nation(n, raw_state) AS (VALUES {_values(enumerate(STATES))}),
merchants(id, name, currency, store_cnt) AS (VALUES {_values(MERCHANT_ROWS)}),
facts AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_custkey % 16 AS u,
    CASE WHEN o_custkey % 16 < 8 THEN 'merch_acme_foods' WHEN o_custkey % 16 < 12 THEN 'merch_ridge_gear'
         WHEN o_custkey % 16 < 14 THEN 'merch_nova_health' WHEN o_custkey % 16 = 14 THEN 'merch_surf_co'
         ELSE 'merch_graze_box' END AS merchant_id,
    CASE WHEN o_custkey % 16 < 8 THEN 'acme-foods-main'
         WHEN o_custkey % 16 < 12 THEN (CASE WHEN o_orderkey % 100 < 72 THEN 'ridge-gear-us' ELSE 'ridge-gear-ca' END)
         WHEN o_custkey % 16 < 14 THEN 'nova-health-b2b' WHEN o_custkey % 16 = 14 THEN 'surf-co-eu'
         ELSE 'graze-box-dtc' END AS source_store,
    CAST(round(o_totalprice / 10.0) AS BIGINT) AS amount,
    CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS created,
    CASE WHEN o_orderkey % 50 = 7 OR o_orderkey % 97 = 3 THEN 'failed' ELSE 'succeeded' END AS status,
    CASE WHEN o_custkey % 16 = 14 AND o_orderkey % 10 >= 3 THEN 'EUR' ELSE 'USD' END AS currency
  FROM orders
),
base AS (
  SELECT f.*, c_nationkey AS n, raw_state AS billing_state,
    CASE WHEN k % 61 = 11 THEN '' WHEN c_nationkey = 19 THEN NULL ELSE CAST(10000 + k % 89999 AS VARCHAR) END AS billing_zip,
    CASE c_nationkey WHEN 23 THEN 'FR' WHEN 24 THEN 'CA' ELSE (CASE WHEN k % 2 = 0 THEN 'US' ELSE ' usa' END) END AS billing_country,
    k % 10 = 1 AS is_b2b,
    CASE WHEN k % 10 <> 1 OR k % 20 = 1 THEN NULL WHEN k % 40 = 31 THEN '  ' ELSE 'CERT-' || k END AS exemption_cert_id,
    CASE WHEN upper(trim(raw_state)) IN ({TAXED}) AND k % 33 <> 0 AND k % 50 <> 7 THEN amount * (475 + k % 556) // 10000
         WHEN c_nationkey = 19 AND k % 7 = 0 THEN amount // 20 ELSE 0 END AS tax
  FROM facts f JOIN customer ON cust = c_custkey JOIN state_by_nation s ON s.n = c_nationkey
),
raw_charges AS (
  SELECT prefix || k AS id, 'charge' AS object, merchant_id, amount, currency, status, created,
    CAST(tax AS BIGINT) AS tax_amount_collected,
    CASE WHEN prefix = 'ch_' THEN source_store ELSE 'ridge-gear-ca' END AS source_store,
    billing_state, billing_zip, billing_country, is_b2b, exemption_cert_id, CAST(k AS VARCHAR) AS shopify_order_id
  FROM base, (VALUES ('ch_'), ('ch_dup_')) p(prefix)
  WHERE prefix = 'ch_' OR (source_store = 'ridge-gear-us' AND k % 12 = 5)
),
raw_orders AS (
  SELECT k AS id, '#' || (k % 100000) AS name, merchant_id, source_store, created, currency,
    amount / 100.0 AS total_price, (amount - tax) / 100.0 AS subtotal_price, tax / 100.0 AS total_tax,
    FALSE AS taxes_included,
    CASE WHEN k % 50 = 7 THEN 'pending' WHEN k % 20 = 4 THEN 'partially_refunded' ELSE 'paid' END AS financial_status,
    CASE WHEN k % 200 = 9 THEN NULL ELSE 'ch_' || k END AS stripe_charge_id,
    billing_state, billing_zip, billing_country
  FROM base
),
raw_refunds AS (
  SELECT 're_' || l_orderkey || '_' || l_partkey || '_' || l_linenumber AS id, 'refund' AS object, merchant_id,
    CAST(round(l_extendedprice) AS BIGINT) AS amount, currency, status, created,
    CASE WHEN l_orderkey % 331 = 0 THEN NULL WHEN l_orderkey % 50 = 0 THEN 'ch_FAKE_' || l_orderkey
         ELSE 'ch_' || l_orderkey END AS charge_id
  FROM lineitem JOIN facts ON l_orderkey = k WHERE l_returnflag = 'R'
)"""

STAGED = f"""
charges AS (
  SELECT id, object, merchant_id, amount AS amount_cents, lower(currency) AS currency, status, created AS created_epoch,
    upper(trim(billing_state)) AS billing_state, billing_zip, upper(trim(billing_country)) AS billing_country, is_b2b,
    exemption_cert_id, shopify_order_id, tax_amount_collected AS tax_amount_collected_cents, source_store,
    length(trim(coalesce(billing_state, ''))) = 0 AS is_missing_state,
    length(trim(coalesce(billing_zip, ''))) = 0 AS is_missing_zip,
    is_b2b AND length(trim(coalesce(exemption_cert_id, ''))) = 0 AS is_b2b_missing_cert,
    tax_amount_collected = 0 AND list_contains([{TAXED}], upper(trim(billing_state))) AS is_zero_tax_taxable_state
  FROM raw_charges WHERE status = 'succeeded'
),
shop AS (
  SELECT id, name, merchant_id, source_store, created AS created_epoch, lower(currency) AS currency, total_price,
    subtotal_price, total_tax, taxes_included, financial_status, upper(trim(billing_state)) AS billing_state,
    billing_zip, upper(trim(billing_country)) AS billing_country, stripe_charge_id,
    length(trim(coalesce(billing_state, ''))) = 0 AS is_missing_state,
    length(trim(coalesce(billing_zip, ''))) = 0 AS is_missing_zip
  FROM raw_orders
),
live_ids AS (SELECT DISTINCT id AS live_id FROM charges),
refunds AS (
  SELECT id, object, merchant_id, amount AS amount_cents, lower(currency) AS currency, status, created AS created_epoch,
    charge_id, live_id IS NULL AS is_orphan_refund
  FROM raw_refunds LEFT JOIN live_ids ON live_id = charge_id
)"""

# The charge ids of the fixture are unique, and each order has its own link.
UNIFIED = f"""
canonical AS (
  SELECT md5('stripe' || id) AS txn_key, id AS source_txn_id, merchant_id, source_store, 'stripe' AS source_system,
    created_epoch, (amount_cents - tax_amount_collected_cents) / 100.0 AS subtotal_usd,
    tax_amount_collected_cents / 100.0 AS tax_collected_usd, currency, FALSE AS is_refund,
    CAST(NULL AS VARCHAR) AS parent_txn_id, billing_state, billing_zip, billing_country, is_b2b, exemption_cert_id,
    is_missing_state, is_missing_zip, is_b2b_missing_cert, is_zero_tax_taxable_state, id AS link_id,
    amount_cents AS sales_cents
  FROM charges
  UNION ALL BY NAME
  SELECT md5('shopify' || id) AS txn_key, CAST(id AS VARCHAR) AS source_txn_id, merchant_id, source_store,
    'shopify' AS source_system, created_epoch, subtotal_price AS subtotal_usd, total_tax AS tax_collected_usd,
    currency, FALSE AS is_refund, CAST(NULL AS VARCHAR) AS parent_txn_id, billing_state, billing_zip, billing_country,
    FALSE AS is_b2b, CAST(NULL AS VARCHAR) AS exemption_cert_id, is_missing_state, is_missing_zip,
    FALSE AS is_b2b_missing_cert,
    round(total_tax * 100) = 0 AND list_contains([{TAXED}], billing_state) AND financial_status <> 'pending'
      AS is_zero_tax_taxable_state,
    stripe_charge_id AS link_id, CAST(round(total_price * 100) AS BIGINT) AS sales_cents
  FROM shop
),
linked AS (
  SELECT * FROM canonical c
  WHERE source_system = 'stripe' OR (link_id IS NOT NULL AND NOT EXISTS (FROM live_ids WHERE live_id = c.link_id))
),
unlinked AS (SELECT * FROM canonical WHERE source_system = 'shopify' AND link_id IS NULL),
unified AS (
  SELECT * FROM linked
  UNION ALL
  SELECT * FROM unlinked WHERE source_txn_id = (SELECT min(source_txn_id) FROM unlinked)
)"""

MARTS = f"""
catalogue(issue_type, severity, recommended_action) AS (
  VALUES {_values((i.issue_type, i.severity, i.recommended_action) for i in ISSUES)}
),
off_currency AS (
  SELECT u.* FROM unified u LEFT JOIN merchants m ON m.id = u.merchant_id WHERE u.currency <> coalesce(m.currency, 'usd')
),
issue_counts AS (
  UNPIVOT (
    SELECT merchant_id,
      count(*) FILTER (is_missing_state OR is_missing_zip) AS missing_billing_address,
      count(*) FILTER (is_zero_tax_taxable_state) AS zero_tax_in_taxable_state,
      count(*) FILTER (is_b2b_missing_cert) AS b2b_missing_exemption_cert
    FROM unified GROUP BY ALL
  ) ON missing_billing_address, zero_tax_in_taxable_state, b2b_missing_exemption_cert
  INTO NAME issue_type VALUE issue_count
  UNION ALL
  SELECT merchant_id, 'currency_mismatch', count(*) FROM off_currency GROUP BY merchant_id
  UNION ALL
  SELECT merchant_id, 'orphan_refund', count(*) FROM refunds WHERE is_orphan_refund GROUP BY merchant_id
),
issues AS (
  SELECT merchant_id, issue_type, CAST(issue_count AS BIGINT) AS issue_count, severity, recommended_action
  FROM issue_counts JOIN catalogue USING (issue_type) WHERE issue_count > 0
),
txn_counts AS (SELECT merchant_id, count(*) AS total_transactions FROM unified WHERE NOT is_refund GROUP BY merchant_id),
threshold_file AS (
  {THRESHOLD_FILE}
),
eligible AS (
  SELECT * FROM unified
  WHERE created_epoch >= epoch(TIMESTAMP '{AS_OF}' - INTERVAL 1 YEAR) AND NOT is_missing_state
    AND billing_country IN ('US', 'USA')
),
sales AS (
  SELECT merchant_id, billing_state AS state_code, CAST(sum(sales_cents) AS BIGINT) / 100.0 AS trailing_12m_sales_usd,
    count(*) AS trailing_12m_transactions
  FROM eligible GROUP BY merchant_id, billing_state
)"""


def nexus(divide_sales: int, divide_count: int) -> str:
    """Nexus mart on thresholds that are divided by the given numbers."""
    return f"""
nexus_in AS (
  SELECT sales.*, state_name, CASE WHEN has_sales_tax THEN 'true' ELSE 'false' END AS has_sales_tax,
    sales_threshold_usd / {divide_sales} AS sales_threshold_usd,
    transaction_threshold // {divide_count} AS transaction_threshold, threshold_logic,
    CASE WHEN threshold_logic = 'AND' THEN 'both' WHEN transaction_threshold IS NULL THEN 'sales' ELSE 'either' END AS mode
  FROM sales JOIN threshold_file USING (state_code)
),
nexus_crossed AS (
  SELECT *, has_sales_tax = 'true' AND CASE mode
      WHEN 'both' THEN least(trailing_12m_sales_usd / sales_threshold_usd, trailing_12m_transactions / transaction_threshold) >= 1
      WHEN 'sales' THEN trailing_12m_sales_usd >= sales_threshold_usd
      ELSE greatest(trailing_12m_sales_usd / sales_threshold_usd, trailing_12m_transactions / transaction_threshold) >= 1
    END AS has_crossed_nexus_threshold
  FROM nexus_in
),
nexus AS (
  SELECT merchant_id, state_code, state_name, trailing_12m_sales_usd, trailing_12m_transactions, sales_threshold_usd,
    transaction_threshold, threshold_logic, has_sales_tax, has_crossed_nexus_threshold,
    CASE WHEN has_sales_tax = 'false' THEN 'no_sales_tax'
         WHEN has_crossed_nexus_threshold THEN
           (CASE WHEN trailing_12m_sales_usd / sales_threshold_usd >= 2 THEN 'high_exposure' ELSE 'at_threshold' END)
         ELSE 'below_threshold' END AS exposure_tier
  FROM nexus_crossed
)"""


AS_IS = nexus(1, 1)
SCALED = nexus(50, 20)

CHECKED = """
violations(test_name, violations) AS (
  SELECT 'assert_no_b2b_missing_exemption_cert', count(*) FROM charges WHERE is_b2b_missing_cert
  UNION ALL SELECT 'assert_no_currency_mismatch', count(*)
    FROM charges c LEFT JOIN merchants m ON m.id = c.merchant_id WHERE c.currency <> coalesce(m.currency, 'usd')
  UNION ALL SELECT 'assert_no_duplicate_txn_ids', count(*) FROM (
    SELECT 1 FROM charges GROUP BY merchant_id, shopify_order_id HAVING min(source_store) <> max(source_store))
  UNION ALL SELECT 'assert_no_refund_without_parent', count(*) FROM refunds WHERE is_orphan_refund
  UNION ALL SELECT 'assert_no_tax_collected_missing_state', count(*)
    FROM charges WHERE tax_amount_collected_cents > 0 AND is_missing_state
  UNION ALL SELECT 'assert_no_zero_tax_in_taxable_state', count(*) FROM charges WHERE is_zero_tax_taxable_state
),
checked AS (
  SELECT test_name, violations, CASE WHEN violations > 0 THEN 'failed' ELSE 'passed' END AS status,
    array_to_string(list_transform(string_split(substr(test_name, 11), '_'),
      lambda w: upper(w[1]) || w[2:]), ' ') AS label
  FROM violations
)"""


def oracle(select: str, *layers: str) -> str:
    return "WITH " + ",".join((RAW, *layers)) + "\n" + select
