
from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestax_spark.functions.money import cents_to_units
from salestax_spark.functions.text import surrogate_key, truthy
from salestax_spark.operators import checks, issues, nexus, report, staging, unify
from salestax_spark.sources import flatten, readers, reference_data, schemas
from salestax_spark.sources.tables import write_files, write_once
from testbed import oracle_text as sql
from testbed import projection as raw
from testbed.oracle_text import AS_IS, CHECKED, MARTS, SCALED, STAGED, UNIFIED, oracle
from testbed.projection import AS_OF

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle_sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle_sql is not None:
            ORACLES[fn.__name__] = oracle_sql
        return fn

    return register


def epochs(df: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds, which mean the same to every engine and time zone."""
    out = []
    for name, dtype in df.dtypes:
        out.append(F.unix_seconds(name).alias("created_epoch") if dtype == "timestamp" else F.col(name))
    return df.select(*out)


MART_INPUT = (
    *["merchant_id", "currency", "is_refund", "occurred_at", "billing_state", "billing_country", "subtotal_usd"],
    *["tax_collected_usd", "is_missing_state", "is_missing_zip", "is_b2b_missing_cert", "is_zero_tax_taxable_state"],
)


class Layers:
    """The raw, staged and derived DataFrames for one data folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def merchants(self) -> DataFrame:
        return reference_data.merchant_table(self.spark)

    @cached_property
    def thresholds(self) -> DataFrame:
        return reference_data.threshold_table(self.spark)

    @cached_property
    def raw_refunds(self) -> DataFrame:
        return raw.raw_refunds(self.spark, self.sf_dir)

    @cached_property
    def charges(self) -> DataFrame:
        return staging.stage_charges(raw.raw_charges(self.spark, self.sf_dir))

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stage_orders(raw.raw_orders(self.spark, self.sf_dir))

    @cached_property
    def refunds(self) -> DataFrame:
        return staging.stage_refunds(self.raw_refunds, self.charges)

    @cached_property
    def unified(self) -> DataFrame:
        return unify.unified_transactions(self.charges, self.orders)

    def share_unified(self) -> Layers:
        """For queries that build several marts: what they need of the unified set is computed once."""
        self.unified = write_once(self.unified.select(*MART_INPUT), "unified")
        return self

    @cached_property
    def sales(self) -> DataFrame:
        return nexus.state_sales(self.unified, AS_OF)

    @cached_property
    def orphans(self) -> DataFrame:
        return issues.orphan_refund_counts(self.raw_refunds, self.charges)

    @cached_property
    def issues(self) -> DataFrame:
        return issues.data_issues(self.unified, self.merchants, self.orphans)

    @cached_property
    def nexus(self) -> DataFrame:
        return nexus.nexus_exposure(self.unified, self.thresholds, AS_OF)

    @cached_property
    def nexus_scaled(self) -> DataFrame:
        return nexus.nexus_exposure(self.unified, raw.scaled_thresholds(self.spark), AS_OF)

    @cached_property
    def counts(self) -> DataFrame:
        return issues.transaction_counts(self.unified)

    @cached_property
    def checks(self) -> DataFrame:
        return checks.check_results(checks.violation_counts(self.charges, self.merchants, self.orphans))


CHARGE_FLAT = """id, object, merchant_id, amount, currency, status, created, tax_amount_collected, source_store,
    billing_state, billing_zip, billing_country, is_b2b, exemption_cert_id, shopify_order_id"""
UNIFIED_OUT = """txn_key, source_txn_id, merchant_id, source_store, source_system, created_epoch, subtotal_usd,
    tax_collected_usd, currency, is_refund, parent_txn_id, billing_state, billing_zip, billing_country, is_b2b,
    exemption_cert_id, is_missing_state, is_missing_zip, is_b2b_missing_cert, is_zero_tax_taxable_state"""
NEXUS_OUT = ", ".join(nexus.NEXUS_COLUMNS)


# ---- Sources ------------------------------------------------------------------------------------


@query(oracle(f"SELECT {CHARGE_FLAT} FROM raw_charges"))
def flatten_charges(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_charges(raw.charge_documents(spark, sf))


@query(
    oracle(
        """SELECT id, name, merchant_id, source_store, currency, created AS created_epoch, total_price, subtotal_price,
        total_tax, taxes_included, financial_status, stripe_charge_id, billing_state, billing_zip, billing_country
        FROM raw_orders"""
    )
)
def flatten_orders(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten.flatten_orders(raw.order_documents(spark, sf))
    return epochs(flat.withColumn("created_at", F.col("created_at").try_cast("timestamp")))


@query(oracle(f"SELECT {CHARGE_FLAT} FROM raw_charges"))
def src_json(spark: SparkSession, sf: str) -> DataFrame:
    """Documents delivered as JSON lines and read with the declared schema."""
    path = write_files(raw.charge_documents(spark, sf), "charges", "json")
    return flatten.flatten_charges(readers.read_documents(spark, path, schemas.CHARGE_DOCUMENT, "json_lines"))


@query(oracle(f"SELECT {CHARGE_FLAT} FROM raw_charges"))
def src_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Documents delivered as Parquet."""
    path = write_files(raw.charge_documents(spark, sf), "charges")
    return flatten.flatten_charges(readers.read_documents(spark, path, schemas.CHARGE_DOCUMENT, "parquet"))


@query(
    oracle(
        """SELECT id, object, merchant_id, amount, CAST(NULL AS VARCHAR) AS currency, status, created, charge_id
        FROM raw_refunds"""
    )
)
def conform_refunds(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery without currency and with an unknown column."""
    delivered = raw.raw_refunds(spark, sf).drop("currency").withColumn("memo", F.lit("x"))
    return flatten.conform_refunds(delivered)


@query(
    oracle(
        """SELECT t.state_code, state_name, has_sales_tax, sales_threshold_usd, transaction_threshold, threshold_logic,
        (SELECT count(*) FROM charges c WHERE c.billing_state = t.state_code) AS charges
        FROM threshold_file t""",
        STAGED,
        UNIFIED,
        MARTS,
    )
)
def seed_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Threshold table, delivered as CSV, with the number of charges each jurisdiction has."""
    by_state = Layers(spark, sf).charges.groupBy(F.col("billing_state").alias("state_code")).agg(F.count("*").alias("charges"))
    path = write_files(reference_data.threshold_table(spark), "thresholds", "csv", header=True)
    cleaned = nexus.clean_thresholds(readers.read_thresholds(spark, path))
    table = cleaned.withColumn("has_sales_tax", F.col("has_sales_tax").cast("boolean"))
    return table.join(by_state, "state_code", "left").fillna(0, ["charges"])


@query(
    oracle(
        """SELECT m.id AS merchant_id, m.name, m.currency, CAST(store_cnt AS INTEGER) AS store_cnt,
        count(c.id) AS charges FROM merchants m LEFT JOIN raw_charges c ON c.merchant_id = m.id GROUP BY ALL""",
    )
)
def dim_merchants(spark: SparkSession, sf: str) -> DataFrame:
    """Merchant table with the number of raw charges of each merchant."""
    counted = raw.raw_charges(spark, sf).groupBy("merchant_id").agg(F.count("*").alias("charges"))
    table = reference_data.merchant_table(spark).select(
        F.col("id").alias("merchant_id"), "name", "currency", F.size("shopify_stores").alias("store_cnt")
    )
    return table.join(counted, "merchant_id", "left").fillna(0, ["charges"])


# ---- Projections, filters, flags ----------------------------------------------------------------


@query(oracle("FROM charges", STAGED))
def stg_charges(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(Layers(spark, sf).charges)


@query(oracle("FROM shop", STAGED))
def stg_orders(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(Layers(spark, sf).orders)


@query(oracle("FROM refunds", STAGED))
def stg_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(Layers(spark, sf).refunds)


@query(oracle(f"SELECT {CHARGE_FLAT} FROM raw_charges WHERE status NOT IN ('failed')"))
def succeeded_charges(spark: SparkSession, sf: str) -> DataFrame:
    return staging.succeeded(raw.raw_charges(spark, sf))


_BOTH_FLAGS = "SELECT 'charge' AS kind, id, {0} FROM charges UNION ALL SELECT 'order', CAST(id AS VARCHAR), {0} FROM shop"


def _flag_of_both(spark: SparkSession, sf: str, flag: str) -> DataFrame:
    layers = Layers(spark, sf)
    charges = layers.charges.select(F.lit("charge").alias("kind"), "id", flag)
    return charges.unionByName(layers.orders.select(F.lit("order").alias("kind"), F.col("id").cast("string"), flag))


@query(oracle(_BOTH_FLAGS.format("is_missing_state"), STAGED))
def flag_missing_state(spark: SparkSession, sf: str) -> DataFrame:
    return _flag_of_both(spark, sf, "is_missing_state")


@query(oracle(_BOTH_FLAGS.format("is_missing_zip"), STAGED))
def flag_missing_zip(spark: SparkSession, sf: str) -> DataFrame:
    return _flag_of_both(spark, sf, "is_missing_zip")


@query(oracle("SELECT id, is_b2b_missing_cert FROM charges", STAGED))
def flag_b2b_missing_cert(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).charges.select("id", "is_b2b_missing_cert")


@query(oracle("SELECT id, is_zero_tax_taxable_state FROM charges", STAGED))
def flag_zero_tax_charges(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).charges.select("id", "is_zero_tax_taxable_state")


@query(
    oracle(
        "SELECT source_txn_id AS id, is_zero_tax_taxable_state FROM canonical WHERE source_system = 'shopify'",
        STAGED,
        UNIFIED,
    )
)
def flag_zero_tax_orders(spark: SparkSession, sf: str) -> DataFrame:
    slim = unify.slim_orders(Layers(spark, sf).orders)
    return slim.select(F.col("order_id").alias("id"), "is_zero_tax_taxable_state")


@query(
    oracle(
        """SELECT id, amount_cents / 100.0 AS amount_usd, tax_amount_collected_cents / 100.0 AS tax_usd,
        (amount_cents - tax_amount_collected_cents) / 100.0 AS subtotal_usd FROM charges""",
        STAGED,
    )
)
def cents_to_units_(spark: SparkSession, sf: str) -> DataFrame:
    amount, tax = F.col("amount_cents"), F.col("tax_amount_collected_cents")
    return Layers(spark, sf).charges.select(
        "id",
        cents_to_units(amount).alias("amount_usd"),
        cents_to_units(tax).alias("tax_usd"),
        cents_to_units(amount - tax).alias("subtotal_usd"),
    )


@query(oracle("SELECT source_system, source_txn_id, txn_key FROM canonical", STAGED, UNIFIED))
def txn_key(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf)
    charges = layers.charges.select(F.lit(unify.PAYMENTS).alias("source_system"), F.col("id").alias("source_txn_id"))
    orders = layers.orders.select(
        F.lit(unify.STOREFRONT).alias("source_system"), F.col("id").cast("string").alias("source_txn_id")
    )
    ids = charges.unionByName(orders)
    return ids.withColumn("txn_key", surrogate_key(F.col("source_system"), F.col("source_txn_id")))


@query(oracle(f"SELECT {UNIFIED_OUT}, link_id FROM canonical", STAGED, UNIFIED))
def canonical_rows(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf)
    return epochs(unify.canonical_rows(layers.charges, layers.orders))


@query(
    oracle(
        f"""SELECT txn_key, created_epoch FROM unified
        WHERE to_timestamp(created_epoch)::DATE >= DATE '{AS_OF}' - INTERVAL 1 YEAR""",
        STAGED,
        UNIFIED,
    )
)
def trailing_12m(spark: SparkSession, sf: str) -> DataFrame:
    rows = nexus.trailing(nexus.not_refunds(Layers(spark, sf).unified), AS_OF)
    return epochs(rows.select("txn_key", "occurred_at"))


@query(
    oracle(
        """SELECT txn_key, billing_state, billing_country FROM unified
        WHERE NOT is_missing_state AND billing_country IN ('USA', 'US')""",
        STAGED,
        UNIFIED,
    )
)
def us_known_state(spark: SparkSession, sf: str) -> DataFrame:
    return nexus.us_known_state(Layers(spark, sf).unified).select("txn_key", "billing_state", "billing_country")


@query(oracle("SELECT txn_key, merchant_id, currency FROM off_currency", STAGED, UNIFIED, MARTS))
def currency_mismatch_rows(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf)
    rows = layers.unified.select("txn_key", "merchant_id", "currency")
    return issues.currency_mismatch_rows(rows, layers.merchants)


@query(
    oracle(
        "SELECT txn_key, is_missing_state, is_missing_zip FROM unified WHERE greatest(is_missing_state, is_missing_zip)",
        STAGED,
        UNIFIED,
    )
)
def missing_billing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return issues.missing_billing_rows(Layers(spark, sf).unified).select("txn_key", "is_missing_state", "is_missing_zip")


@query(
    oracle("SELECT merchant_id, state_code, has_crossed_nexus_threshold FROM nexus", STAGED, UNIFIED, MARTS, SCALED)
)
def nexus_crossed(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).nexus_scaled.select("merchant_id", "state_code", "has_crossed_nexus_threshold")


@query(oracle("SELECT merchant_id, state_code, exposure_tier FROM nexus", STAGED, UNIFIED, MARTS, SCALED))
def nexus_tier(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).nexus_scaled.select("merchant_id", "state_code", "exposure_tier")


@query(
    oracle(
        """SELECT 'S' || id AS state_code, name AS state_name,
        CASE WHEN id % 3 = 0 THEN 'false' WHEN id % 3 = 1 THEN 'true' END AS has_sales_tax,
        CASE WHEN id % 5 NOT IN (1, 3) THEN total_price END AS sales_threshold_usd,
        CASE WHEN id % 4 < 2 THEN id WHEN id % 4 = 2 THEN CAST(id + 1 AS BIGINT) END AS transaction_threshold,
        CASE id % 3 WHEN 1 THEN 'AND' WHEN 2 THEN 'or' END AS threshold_logic
        FROM raw_orders"""
    )
)
def thresholds_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaning of threshold text as untidy as files get; one row of text per order."""
    key = F.col("id")
    price, number = F.col("total_price").cast("string"), key.cast("string")
    untidy = raw.raw_orders(spark, sf).select(
        F.concat(F.lit("S"), number).alias("state_code"),
        F.col("name").alias("state_name"),
        F.when(key % 3 == 0, " FALSE").when(key % 3 == 1, "True ").alias("has_sales_tax"),
        F.when(key % 5 == 1, "n/a").when(key % 5 == 3, "  ").otherwise(F.concat(F.lit(" "), price)).alias("sales_threshold_usd"),
        F.when(key % 4 == 0, number)
        .when(key % 4 == 1, F.concat(number, F.lit(".0 ")))
        .when(key % 4 == 2, F.concat(number, F.lit(".5")))
        .otherwise("none")
        .alias("transaction_threshold"),
        F.when(key % 3 == 1, " AND ").when(key % 3 == 2, "or").otherwise(" ").alias("threshold_logic"),
    )
    return nexus.clean_thresholds(untidy)


@query(oracle("SELECT issues.* FROM issues WHERE merchant_id = 'merch_ridge_gear'", STAGED, UNIFIED, MARTS))
def issues_for_merchant(spark: SparkSession, sf: str) -> DataFrame:
    return report.issues_for_merchant(Layers(spark, sf).issues, "merch_ridge_gear")


@query(
    oracle(
        """SELECT id, is_b2b IS TRUE AS from_boolean, is_b2b AS from_text, id LIKE 'ch_dup%' AS from_number
        FROM raw_charges"""
    )
)
def truthy_flag(spark: SparkSession, sf: str) -> DataFrame:
    is_copy = F.col("id").startswith("ch_dup").cast("int")
    return raw.raw_charges(spark, sf).select(
        "id",
        truthy(F.col("is_b2b")).alias("from_boolean"),
        truthy(F.when(F.col("is_b2b"), "true").otherwise("False")).alias("from_text"),
        truthy(is_copy).alias("from_number"),
    )


# ---- Joins --------------------------------------------------------------------------------------


@query(oracle("SELECT id, charge_id, is_orphan_refund FROM refunds", STAGED))
def refund_orphan_flag(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).refunds.select("id", "charge_id", "is_orphan_refund")


@query(oracle("SELECT id, merchant_id, charge_id FROM raw_refunds r WHERE NOT EXISTS (FROM charges c WHERE c.id = r.charge_id)", STAGED))
def orphan_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return checks.orphan_refunds(Layers(spark, sf).refunds).select("id", "merchant_id", "charge_id")


@query(
    oracle(
        """SELECT merchant_id, state_code, state_name, trailing_12m_sales_usd, sales_threshold_usd, transaction_threshold,
        threshold_logic FROM nexus_in""",
        STAGED,
        UNIFIED,
        MARTS,
        AS_IS,
    )
)
def state_thresholds_join(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf)
    joined = nexus.attach_thresholds(layers.sales, nexus.clean_thresholds(layers.thresholds))
    return joined.select(
        *["merchant_id", "state_code", "state_name", "trailing_12m_sales_usd", "sales_threshold_usd"],
        *["transaction_threshold", "threshold_logic"],
    )


# ---- Dedup --------------------------------------------------------------------------------------


@query(oracle("SELECT link_id, source_system, source_txn_id, 1 AS rn FROM unified", STAGED, UNIFIED))
def link_rank(spark: SparkSession, sf: str) -> DataFrame:
    """The best-ranked row of every link, with its rank."""
    layers = Layers(spark, sf)
    ranked = unify.rank_links(unify.slim_rows(layers.charges, layers.orders))
    return unify.widen(ranked.where(F.col("rn") == 1), "link_id", "rn").select("link_id", "source_system", "source_txn_id", "rn")


@query(oracle(f"SELECT {UNIFIED_OUT} FROM unified", STAGED, UNIFIED))
def unified_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(Layers(spark, sf).unified)


@query(oracle(f"SELECT {UNIFIED_OUT} FROM (FROM linked UNION ALL FROM unlinked)", STAGED, UNIFIED))
def unified_keep_unlinked(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf)
    return epochs(unify.unified_transactions(layers.charges, layers.orders, null_link="keep"))


# ---- Aggregations and marts ---------------------------------------------------------------------


def _family_oracle(issue_type: str) -> str:
    return oracle(f"SELECT merchant_id, issue_type, issue_count, severity FROM issues WHERE issue_type = '{issue_type}'", STAGED, UNIFIED, MARTS)


def _family(spark: SparkSession, sf: str, family: reference_data.Issue) -> DataFrame:
    layers = Layers(spark, sf)
    return issues.data_issues(layers.unified, layers.merchants, layers.orphans, (family,)).drop("recommended_action")


@query(_family_oracle("missing_billing_address"))
def issue_missing_billing(spark: SparkSession, sf: str) -> DataFrame:
    return _family(spark, sf, reference_data.MISSING_BILLING)


@query(_family_oracle("zero_tax_in_taxable_state"))
def issue_zero_tax(spark: SparkSession, sf: str) -> DataFrame:
    return _family(spark, sf, reference_data.ZERO_TAX)


@query(_family_oracle("b2b_missing_exemption_cert"))
def issue_b2b_cert(spark: SparkSession, sf: str) -> DataFrame:
    return _family(spark, sf, reference_data.B2B_CERTIFICATE)


@query(_family_oracle("currency_mismatch"))
def issue_currency(spark: SparkSession, sf: str) -> DataFrame:
    return _family(spark, sf, reference_data.CURRENCY)


@query(_family_oracle("orphan_refund"))
def issue_orphan_refund(spark: SparkSession, sf: str) -> DataFrame:
    return _family(spark, sf, reference_data.ORPHAN_REFUND)


@query(oracle("FROM sales", STAGED, UNIFIED, MARTS))
def trailing_state_sales(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).sales


@query(
    oracle(
        """SELECT merchant_id, shopify_order_id, len(array_agg(DISTINCT source_store)) AS store_cnt FROM charges
        GROUP BY ALL HAVING store_cnt > 1""",
        STAGED,
    )
)
def cross_store_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.cross_store_duplicates(Layers(spark, sf).charges)


@query(oracle("FROM txn_counts", STAGED, UNIFIED, MARTS))
def transaction_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).counts


@query(oracle("SELECT merchant_id, issue_type, issue_count, severity, recommended_action FROM issues", STAGED, UNIFIED, MARTS))
def data_issues(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).issues


@query(oracle(f"SELECT {NEXUS_OUT} FROM nexus", STAGED, UNIFIED, MARTS, AS_IS))
def nexus_exposure(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).nexus


@query(oracle(f"SELECT {NEXUS_OUT} FROM nexus", STAGED, UNIFIED, MARTS, SCALED))
def nexus_exposure_scaled(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).nexus_scaled


# ---- Checks -------------------------------------------------------------------------------------


@query(oracle("FROM charges WHERE is_b2b_missing_cert", STAGED))
def chk_b2b_cert(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(checks.b2b_without_certificate(Layers(spark, sf).charges))


@query(
    oracle(
        """SELECT c.* FROM charges c
        WHERE c.currency <> coalesce((SELECT m.currency FROM merchants m WHERE m.id = c.merchant_id), 'usd')""",
        STAGED,
    )
)
def chk_currency(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf)
    return epochs(checks.off_currency(layers.charges, layers.merchants))


@query(ORACLES["cross_store_duplicates"])
def chk_duplicate_txn(spark: SparkSession, sf: str) -> DataFrame:
    return checks.cross_store_duplicates(Layers(spark, sf).charges)


@query(oracle("FROM refunds WHERE is_orphan_refund", STAGED))
def chk_orphan_refund(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(checks.orphan_refunds(Layers(spark, sf).refunds))


@query(oracle("FROM charges WHERE tax_amount_collected_cents > 0 AND is_missing_state", STAGED))
def chk_tax_no_state(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(checks.tax_without_state(Layers(spark, sf).charges))


@query(oracle("FROM charges WHERE is_zero_tax_taxable_state", STAGED))
def chk_zero_tax(spark: SparkSession, sf: str) -> DataFrame:
    return epochs(checks.untaxed_in_taxable_state(Layers(spark, sf).charges))


@query(oracle("FROM checked", STAGED, CHECKED))
def check_results(spark: SparkSession, sf: str) -> DataFrame:
    return Layers(spark, sf).checks


@query(
    oracle(
        "SELECT count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'failed') AS failed FROM checked",
        STAGED,
        CHECKED,
    )
)
def check_totals(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_totals(Layers(spark, sf).checks)


# ---- Report -------------------------------------------------------------------------------------


@query(
    oracle(
        """SELECT m.id AS merchant_id, m.name AS merchant_name, coalesce(t, 0) AS total_transactions,
          CAST(coalesce(i, 0) AS BIGINT) AS total_issues, coalesce(x, 0) AS nexus_states,
          CAST(least(100, greatest(0, floor((1 - coalesce(i, 0) / greatest(coalesce(t, 0), 1)) * 100 + 0.5))) AS BIGINT) AS quality_score
        FROM merchants m
        LEFT JOIN (SELECT merchant_id, total_transactions AS t FROM txn_counts) a ON a.merchant_id = m.id
        LEFT JOIN (SELECT merchant_id, CAST(sum(issue_count) AS BIGINT) AS i FROM issues GROUP BY ALL) b ON b.merchant_id = m.id
        LEFT JOIN (SELECT merchant_id, count(*) AS x FROM nexus WHERE has_crossed_nexus_threshold GROUP BY ALL) c
          ON c.merchant_id = m.id""",
        STAGED,
        UNIFIED,
        MARTS,
        SCALED,
    )
)
def merchant_kpis(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf).share_unified()
    return report.merchant_kpis(layers.merchants, layers.issues, layers.nexus_scaled, layers.counts)


@query(
    oracle(
        f"""SELECT merchant_id, label AS issue_label, issue_count, severity, recommended_action,
        CAST(1 + (SELECT count(*) FROM issues b WHERE b.merchant_id = a.merchant_id
          AND (b.severity < a.severity OR (b.severity = a.severity AND b.issue_count > a.issue_count))) AS INTEGER) AS issue_rank
        FROM issues a JOIN (VALUES {sql._values((i.issue_type, i.label) for i in reference_data.ISSUES)}) l(issue_type, label)
        USING (issue_type)""",
        STAGED,
        UNIFIED,
        MARTS,
    )
)
def ranked_issues(spark: SparkSession, sf: str) -> DataFrame:
    return report.ranked_issues(Layers(spark, sf).issues)


@query(
    oracle(
        """SELECT merchant_id, CAST(rank() OVER (PARTITION BY merchant_id ORDER BY trailing_12m_sales_usd DESC) AS INTEGER) AS sales_rank,
        state_name || ' (' || state_code || ')' AS state_label, trailing_12m_sales_usd, trailing_12m_transactions,
        sales_threshold_usd, replace(exposure_tier, '_', ' ') AS tier_label
        FROM nexus WHERE has_crossed_nexus_threshold""",
        STAGED,
        UNIFIED,
        MARTS,
        SCALED,
    )
)
def ranked_nexus(spark: SparkSession, sf: str) -> DataFrame:
    return report.ranked_nexus(Layers(spark, sf).nexus_scaled)


def _json(columns: str) -> str:
    pairs = ", ".join(f"'{name}': {name}" for name in columns.replace(" ", "").split(","))
    return f"CAST(to_json({{{pairs}}}) AS VARCHAR)"


@query(oracle(f"SELECT {_json(NEXUS_OUT)} AS record FROM nexus", STAGED, UNIFIED, MARTS, AS_IS))
def mart_json_records(spark: SparkSession, sf: str) -> DataFrame:
    return report.json_records(Layers(spark, sf).nexus)


@query(
    oracle(
        f"""SELECT section, 1 AS part, record,
          CASE WHEN record = min(record) OVER (PARTITION BY section) THEN record ELSE ',' || record END AS line
        FROM (
          SELECT 1 AS section, {_json("id,name")} AS record FROM merchants
          UNION ALL SELECT 2, {_json("merchant_id,issue_type,issue_count,severity,recommended_action")} FROM issues
          UNION ALL SELECT 3, {_json(NEXUS_OUT)} FROM nexus
          UNION ALL SELECT 4, {_json("merchant_id,total_transactions")} FROM txn_counts
          UNION ALL SELECT 5, {_json("test_name,status")} FROM checked
        )
        UNION ALL SELECT 0, 0, '', '{{"generated_at": "{AS_OF}T00:00:00+00:00",'
        UNION ALL SELECT s, 0, '', '"' || key || '": [' FROM
          (VALUES (1, 'merchants'), (2, 'data_issues'), (3, 'nexus_exposure'), (4, 'transaction_counts'), (5, 'dbt_test_results')) v(s, key)
        UNION ALL SELECT s, 2, '', CASE s WHEN 5 THEN ']}}' ELSE '],' END FROM range(1, 6) r(s)""",
        STAGED,
        UNIFIED,
        MARTS,
        AS_IS,
        CHECKED,
    )
)
def report_document(spark: SparkSession, sf: str) -> DataFrame:
    layers = Layers(spark, sf).share_unified()
    return report.report_lines(
        layers.merchants, layers.issues, layers.nexus, layers.counts, layers.checks, generated_at=f"{AS_OF}T00:00:00+00:00"
    )


# The helper it tests has the name the survey gives to the query.
QUERIES["cents_to_units"] = QUERIES.pop("cents_to_units_")
ORACLES["cents_to_units"] = ORACLES.pop("cents_to_units_")
