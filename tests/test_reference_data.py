from salestax_spark.sources import reference_data as ref
from salestax_spark.sources.inline import inline_table


def test_sizes():
    assert len({row[0] for row in ref.NEXUS_THRESHOLDS}) == len(ref.NEXUS_THRESHOLDS) == 51
    assert len(set(ref.ZERO_TAX_STATES)) == len(ref.ZERO_TAX_STATES) == 45
    assert "DC" not in ref.ZERO_TAX_STATES
    assert len(ref.KNOWN_MERCHANTS) == 5


def test_threshold_kinds(spark):
    rows = {r.state_code: r for r in ref.threshold_table(spark).collect()}
    assert len(rows) == 51
    common = [r for r in rows.values() if (r.sales_threshold_usd, r.transaction_threshold, r.threshold_logic) == (1e5, 200, "OR")]
    assert len(common) == 43
    assert (rows["CA"].sales_threshold_usd, rows["CA"].transaction_threshold, rows["CA"].threshold_logic) == (5e5, None, None)
    assert (rows["TX"].sales_threshold_usd, rows["TX"].transaction_threshold) == (5e5, None)
    assert (rows["NY"].sales_threshold_usd, rows["NY"].transaction_threshold, rows["NY"].threshold_logic) == (5e5, 100, "AND")
    assert sorted(s for s, r in rows.items() if not r.has_sales_tax) == ["AK", "DE", "MT", "NH", "OR"]
    assert rows["DC"].state_name == "District of Columbia"


def test_inline_table_quotes_and_types(spark):
    row = ("it's a \\ and \"quote\"", None, 3, 1.5, True, ["a", "b"])
    columns = {"s": "string", "n": "string", "i": "bigint", "d": "double", "b": "boolean", "l": "array<string>"}
    df = inline_table(spark, columns, [row])
    assert tuple(df.first()) == row
    assert [t for _, t in df.dtypes] == list(columns.values())


def test_reference_tables_have_a_known_small_size(spark):
    plan = ref.merchant_table(spark)._jdf.queryExecution().optimizedPlan()
    assert plan.getClass().getSimpleName() == "LocalRelation"
