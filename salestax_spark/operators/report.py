"""Merchant figures and the JSON report, all computed from the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestax_spark.functions.dates import utc_now_iso
from salestax_spark.functions.text import state_label, text_or, tier_label, title_from_slug, truthy
from salestax_spark.sources.inline import inline_table
from salestax_spark.sources.reference_data import ISSUES

# Report keys in document order; severities in display order.
REPORT_KEYS = (
    "generated_at",
    "merchants",
    "data_issues",
    "nexus_exposure",
    "transaction_counts",
    "dbt_test_results",
)
SEVERITY_ORDER = ("high", "medium")
OTHER_SEVERITY = 9


def quality_score(issues: Column, transactions: Column) -> Column:
    """Share of transactions without an issue in whole percent, halves up, within 0 and 100."""
    share = (1 - issues / F.greatest(transactions, F.lit(1))) * 100
    return F.least(F.greatest(F.floor(share + 0.5), F.lit(0)), F.lit(100)).cast("bigint")


def merchant_kpis(merchants: DataFrame, issues: DataFrame, nexus: DataFrame, counts: DataFrame) -> DataFrame:
    issue_totals = issues.groupBy("merchant_id").agg(F.sum("issue_count").alias("total_issues"))
    crossed = nexus.groupBy("merchant_id").agg(
        F.count_if(truthy(F.col("has_crossed_nexus_threshold"))).alias("nexus_states")
    )
    joined = merchants.select(F.col("id").alias("merchant_id"), F.col("name").alias("merchant_name"))
    for part in (counts, issue_totals, crossed):
        joined = joined.join(part, "merchant_id", "left")
    filled = joined.fillna(0, ["total_transactions", "total_issues", "nexus_states"])
    return filled.withColumn("quality_score", quality_score(F.col("total_issues"), F.col("total_transactions")))


def issue_label(issue_type: Column) -> Column:
    label = title_from_slug(issue_type)
    for issue in ISSUES:
        label = F.when(issue_type == issue.issue_type, F.lit(issue.label)).otherwise(label)
    return label


def severity_rank(severity: Column) -> Column:
    rank = F.lit(OTHER_SEVERITY)
    for position, name in enumerate(SEVERITY_ORDER):
        rank = F.when(F.lower(severity) == name, F.lit(position)).otherwise(rank)
    return rank


def issues_for_merchant(issues: DataFrame, merchant_id: str) -> DataFrame:
    return issues.where(F.col("merchant_id") == merchant_id)


def ranked_issues(issues: DataFrame) -> DataFrame:
    """Issues of each merchant, the most severe and most frequent first; equals share a rank."""
    order = [severity_rank(F.col("severity")), F.desc("issue_count")]
    return issues.select(
        "merchant_id",
        F.rank().over(Window.partitionBy("merchant_id").orderBy(*order)).alias("issue_rank"),
        issue_label(F.col("issue_type")).alias("issue_label"),
        "issue_count",
        F.lower(text_or(F.col("severity"), F.lit("medium"))).alias("severity"),
        text_or(F.col("recommended_action"), F.lit("—")).alias("recommended_action"),
    )


def ranked_nexus(nexus: DataFrame) -> DataFrame:
    """Crossed states of each merchant, largest sales first."""
    sales = F.coalesce("trailing_12m_sales_usd", F.lit(0.0))
    by_sales = Window.partitionBy("merchant_id").orderBy(sales.desc())
    return nexus.where(truthy(F.col("has_crossed_nexus_threshold"))).select(
        "merchant_id",
        F.rank().over(by_sales).alias("sales_rank"),
        state_label(F.col("state_name"), F.col("state_code")).alias("state_label"),
        "trailing_12m_sales_usd",
        "trailing_12m_transactions",
        "sales_threshold_usd",
        tier_label(F.col("exposure_tier")).alias("tier_label"),
    )


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row; NULLs are written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


_OPEN, _RECORD, _CLOSE = 0, 1, 2
_LINE_COLUMNS = {"section": "int", "part": "int", "record": "string", "line": "string"}


def report_lines(
    merchants: DataFrame,
    issues: DataFrame,
    nexus: DataFrame,
    counts: DataFrame,
    checks: DataFrame,
    generated_at: str | None = None,
) -> DataFrame:
    """The report as ordered lines which, put together, are one JSON object with the REPORT_KEYS.

    Lines instead of one nested value: the document then never has to fit into one row or one task, and
    writing it is an ordinary distributed sort. Columns ``section``, ``part``, ``record`` give the order.
    """
    spark = issues.sparkSession
    stamp, *arrays = REPORT_KEYS
    content = dict(
        zip(
            arrays,
            (
                merchants.select("id", "name"),
                issues,
                nexus,
                counts,
                checks.select("test_name", "status"),
            ),
            strict=True,
        )
    )
    frame = [(0, _OPEN, "", '{"%s": "%s",' % (stamp, generated_at or utc_now_iso()))]
    records = None
    for section, (key, df) in enumerate(content.items(), start=1):
        frame.append((section, _OPEN, "", '"%s": [' % key))
        frame.append((section, _CLOSE, "", "]," if section < len(content) else "]}"))
        part = json_records(df).withColumn("section", F.lit(section))
        records = part if records is None else records.unionByName(part)

    # A separator goes in front of every record but the first of its array. Records that are equal to the letter become one entry with a count,
    # and each of its copies a line again, so that "the first" is one line.
    entries = records.groupBy("section", "record").agg(F.count("*").cast("int").alias("copies"))
    firsts = records.groupBy("section").agg(F.min("record").alias("first_record"))
    repeated = entries.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    opens = (F.col("record") == F.col("first_record")) & (F.col("copy") == 1)
    lines = repeated.join(firsts, "section").select(
        "section",
        F.lit(_RECORD).alias("part"),
        "record",
        F.when(opens, F.col("record")).otherwise(F.concat(F.lit(","), F.col("record"))).alias("line"),
    )
    return inline_table(spark, _LINE_COLUMNS, frame).unionByName(lines)


#: Lines in this order are the document; of equal records the one without a separator comes first.
LINE_ORDER = ("section", "part", "record")


def in_order(lines: DataFrame) -> DataFrame:
    return lines.orderBy(*LINE_ORDER, F.col("line").startswith(",")).select("line")


def write_report(lines: DataFrame, path: str) -> None:
    """Text parts in document order; reading them one after the other gives the JSON object."""
    in_order(lines).write.mode("overwrite").text(path)
