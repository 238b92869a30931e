"""From source documents to marts, checks and report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestax_spark.functions.dates import as_date
from salestax_spark.operators import checks, issues, nexus, report, staging, unify
from salestax_spark.sources import flatten, readers, reference_data, schemas
from salestax_spark.sources.tables import FolderStore, register_views


@dataclass(frozen=True)
class Inputs:
    """Where the sources are. ``formats`` maps a source name to one of ``readers.FORMATS``.

    ``on_bad``: records that cannot be parsed stop the run ("fail") or are left out and listed in a table ("skip").
    """

    charges: str
    orders: str
    refunds: str
    thresholds: str | None = None
    merchants: str | None = None
    formats: Mapping[str, str] = field(default_factory=dict)
    on_bad: str = readers.FAIL

    def format_of(self, name: str) -> str:
        return {"thresholds": "csv", "merchants": "json_lines"}.get(name) or self.formats.get(name, "json_array")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return readers.read_documents(spark, getattr(self, name), SOURCE_SCHEMAS[name], self.format_of(name), self.on_bad)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Records of all parsed sources that cannot be read: source, file, record, read_as."""
        lists = [
            readers.rejected_records(spark, getattr(self, name), schema, self.format_of(name)).select(F.lit(name).alias("source"), "*")
            for name, schema in SOURCE_SCHEMAS.items()
            if getattr(self, name) and not self.format_of(name).startswith("parquet")
        ]
        nothing = spark.createDataFrame([], "source string, file string, record string, read_as string")
        return reduce(DataFrame.unionByName, lists, nothing)


SOURCE_SCHEMAS = {
    "charges": schemas.CHARGE_DOCUMENT,
    "orders": schemas.ORDER_DOCUMENT,
    "refunds": schemas.REFUND_DOCUMENT,
    "thresholds": schemas.THRESHOLDS,
    "merchants": schemas.MERCHANTS,
}


# Table names, which existing queries refer to.
RAW_CHARGES, RAW_ORDERS, RAW_REFUNDS = "raw_stripe_charges", "raw_shopify_orders", "raw_stripe_refunds"
THRESHOLDS, MERCHANTS = "state_nexus_thresholds", "merchants"
REJECTED = "rejected_records"
STG_CHARGES, STG_ORDERS, STG_REFUNDS = "stg_stripe_charges", "stg_shopify_orders", "stg_stripe_refunds"
UNIFIED, ISSUES_MART, NEXUS_MART = "int_unified_transactions", "fct_data_issues", "fct_nexus_exposure"
ORPHANS, PROFILE, COUNTS, CHECKS, KPIS, REPORT = (
    "orphan_refund_counts",
    "merchant_profile",
    "transaction_counts",
    "check_results",
    "merchant_kpis",
    "report",
)


#: Columns by which raw tables of a CatalogStore can be bucketed, so that charges and orders meet without a shuffle.
def link_buckets(number: int) -> dict[str, tuple]:
    return {RAW_CHARGES: (number, "id"), RAW_ORDERS: (number, "stripe_charge_id")}


#: Steps that run at the same time.
THREADS = 4

#: Name of a step, names of the steps whose results it takes, and what it does with them. A step comes after the ones it takes from.
Step = tuple[str, tuple[str, ...], Callable[..., DataFrame]]


class StepsFailed(RuntimeError):
    """Steps that failed, with their errors, and those left out because they take from one of them."""

    def __init__(self, errors: Mapping[str, BaseException], left_out: list[str]):
        self.errors, self.left_out = dict(errors), left_out
        texts = [f"{name}: {str(error).splitlines()[0] if str(error) else type(error).__name__}" for name, error in errors.items()]
        super().__init__("; ".join(texts) + (f"; not run: {', '.join(left_out)}" if left_out else ""))


def side_by_side(spark: SparkSession, steps: list[Step], given: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Results of all steps. Steps that do not need each other run at the same time, each in a scheduler pool of its own name.

    A step that fails takes only those with it that need its result; the others finish, and then all errors are raised together.
    """
    futures: dict[str, Future] = {}

    def run_step(name: str, needs: tuple[str, ...], build: Callable[..., DataFrame]) -> DataFrame | None:
        # Needed steps were submitted earlier, so the earliest unfinished one never waits, however few threads there are.
        inputs = [given[n] if n in given else futures[n].result() for n in needs]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return build(*inputs)

    with ThreadPoolExecutor(THREADS) as pool:
        for name, needs, build in steps:
            futures[name] = pool.submit(inheritable_thread_target(spark)(run_step), name, needs, build)
    errors = {name: error for name, future in futures.items() if (error := future.exception())}
    if errors:
        needed = {name: needs for name, needs, _ in steps}
        left_out = [name for name in errors if any(n in errors for n in needed[name])]
        raise StepsFailed({n: e for n, e in errors.items() if n not in left_out}, left_out) from next(iter(errors.values()))
    return {name: future.result() for name, future in futures.items()}


def load_raw(spark: SparkSession, inputs: Inputs, store) -> dict[str, DataFrame]:
    """Source documents to flat raw tables and reference tables; every later step reads those. Either all are replaced or none."""

    def thresholds() -> DataFrame:
        if not inputs.thresholds:
            return store.replace(THRESHOLDS, reference_data.threshold_table(spark))
        table = store.replace(THRESHOLDS, readers.read_thresholds(spark, inputs.thresholds, inputs.on_bad))
        readers.check_state_codes(table)
        return table

    def merchants() -> DataFrame:
        return inputs.read(spark, "merchants") if inputs.merchants else reference_data.merchant_table(spark)

    steps: list[Step] = [
        (RAW_CHARGES, (), lambda: store.replace(RAW_CHARGES, flatten.flatten_charges(inputs.read(spark, "charges")))),
        (RAW_ORDERS, (), lambda: store.replace(RAW_ORDERS, flatten.flatten_orders(inputs.read(spark, "orders")))),
        (RAW_REFUNDS, (), lambda: store.replace(RAW_REFUNDS, flatten.conform_refunds(inputs.read(spark, "refunds")))),
        (THRESHOLDS, (), thresholds),
        (MERCHANTS, (), lambda: store.replace(MERCHANTS, merchants())),
    ]
    if inputs.on_bad == readers.SKIP:
        steps.append((REJECTED, (), lambda: store.replace(REJECTED, inputs.rejected(spark))))
    with store.refresh():
        return side_by_side(spark, steps, {})


def staged(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging layer as lazy DataFrames over the raw tables."""
    charges = staging.stage_charges(raw[RAW_CHARGES])
    return {
        STG_CHARGES: charges,
        STG_ORDERS: staging.stage_orders(raw[RAW_ORDERS]),
        STG_REFUNDS: staging.stage_refunds(raw[RAW_REFUNDS], charges),
    }


def by_time(unified: DataFrame) -> DataFrame:
    """Sorted inside each file, so that row groups outside a time window are skipped. No shuffle."""
    return unified.sortWithinPartitions("occurred_at")


def by_month(unified: DataFrame) -> DataFrame:
    """Rows of a month together, in as many tasks as the month needs by its size, for a table with a folder per month. One shuffle."""
    return nexus.with_month(unified).hint("rebalance", nexus.MONTH).sortWithinPartitions(nexus.MONTH, "occurred_at")


def checked(store, charges: DataFrame, merchants: DataFrame, orphan_counts: DataFrame) -> DataFrame:
    """The check suite in one pass; if that fails, check by check, so that a broken one fails alone and the job goes on."""
    try:
        return store.replace(CHECKS, checks.check_results(checks.violation_counts(charges, merchants, orphan_counts)))
    except checks.ERRORS as error:
        checks.LOG.warning("checks are counted one by one after an error: %s", error)
    return store.replace(CHECKS, checks.check_results(checks.counted_one_by_one(charges, merchants, orphan_counts)))


def transform(
    raw: Mapping[str, DataFrame],
    store,
    as_of: dt.date | str | None = None,
    months: int = 12,
    null_link: str = "collapse",
    month_folders: bool = False,
) -> dict[str, DataFrame]:
    """Raw tables to unified set, marts, checks and merchant figures, each written once and read from there; all are replaced or none.

    With ``month_folders`` the unified table has a column ``occurred_month`` more and a folder per month, and a mart over some months lists
    only their files; writing it takes another shuffle.
    """
    day = as_date(as_of)
    charges = staging.stage_charges(raw[RAW_CHARGES])
    orders = staging.stage_orders(raw[RAW_ORDERS])

    def unified() -> DataFrame:
        rows = unify.unified_transactions(charges, orders, null_link)
        if month_folders:
            return store.replace(UNIFIED, by_month(rows), partition_by=(nexus.MONTH,))
        return store.replace(UNIFIED, by_time(rows))

    def written(name: str, build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        return lambda *inputs: store.replace(name, build(*inputs))

    steps: list[Step] = [
        (UNIFIED, (), unified),
        (ORPHANS, (), written(ORPHANS, lambda: issues.orphan_refund_counts(raw[RAW_REFUNDS], charges))),
        (PROFILE, (UNIFIED, MERCHANTS), written(PROFILE, issues.merchant_profile)),
        (NEXUS_MART, (UNIFIED, THRESHOLDS), written(NEXUS_MART, lambda rows, limits: nexus.nexus_exposure(rows, limits, day, months))),
        (CHECKS, (MERCHANTS, ORPHANS), lambda merchants, orphans: checked(store, charges, merchants, orphans)),
        (ISSUES_MART, (PROFILE, ORPHANS), written(ISSUES_MART, issues.issues_of_profile)),
        (COUNTS, (PROFILE,), written(COUNTS, issues.counts_of_profile)),
        (KPIS, (MERCHANTS, ISSUES_MART, NEXUS_MART, COUNTS), written(KPIS, report.merchant_kpis)),
    ]
    with store.refresh():
        return side_by_side(charges.sparkSession, steps, raw)


def run(
    spark: SparkSession,
    inputs: Inputs,
    location: str,
    as_of: dt.date | str | None = None,
    months: int = 12,
    null_link: str = "collapse",
    store=None,
    views: bool = False,
    month_folders: bool = False,
) -> dict[str, DataFrame]:
    """Full refresh of every table below ``location`` (or in ``store``) and of the report, as one step for readers of a folder store.

    With ``views`` all tables and the staging layer can afterwards be queried in SQL by name.
    """
    folders = FolderStore(spark, location)
    store = store or folders
    with store.refresh():
        raw = load_raw(spark, inputs, store)
        tables = transform(raw, store, as_of, months, null_link, month_folders)
        lines = report.report_lines(
            raw[MERCHANTS], tables[ISSUES_MART], tables[NEXUS_MART], tables[COUNTS], tables[CHECKS]
        )
        # The report is a folder of text parts, also where the tables are in the catalog.
        (store if isinstance(store, FolderStore) else folders).replace(REPORT, report.in_order(lines), fmt="text")
    if views:
        register_views({**raw, **staged(raw), **tables})
    return {**raw, **tables}
