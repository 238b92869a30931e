import json

import pytest
from pyspark.sql import functions as F

from salestax_spark.operators import nexus
from salestax_spark.sources import flatten, readers, schemas
from salestax_spark.sources import reference_data as ref
from salestax_spark.sources.tables import CatalogStore, FolderStore, register_views, scratch_folder, write_once

CHARGE = {
    "id": "c1", "object": "charge", "merchant_id": "m", "amount": 100, "currency": "usd", "status": "succeeded", "created": 5,
    "billing_details": {"email": "e", "name": "n", "address": {"city": "x", "country": "US", "line1": "l", "postal_code": "9", "state": "CA"}},
    "metadata": {"shopify_order_id": "77", "is_b2b": True, "exemption_cert_id": None},
    "tax_amount_collected": 8, "source_store": "s", "something_new": 1,
}
ORDER = {
    "id": 77, "name": "#77", "merchant_id": "m", "source_store": "s", "created_at": "2024-01-15T12:00:00+0000", "currency": "USD",
    "total_price": "1.00", "subtotal_price": "0.92", "total_tax": "0.08", "taxes_included": False, "financial_status": "paid",
    "billing_address": {"address1": "a", "city": "x", "province_code": "CA", "country_code": "US", "zip": ""},
    "stripe_charge_id": "c1", "note_attributes": [{"name": "is_b2b", "value": "true"}],
}


def _json(path, payload):
    path.write_text(json.dumps(payload, indent=2))
    return str(path)


def test_json_array_to_flat_charges(spark, tmp_path):
    path = _json(tmp_path / "c.json", [CHARGE, {"id": "c2", "metadata": None}])
    rows = flatten.flatten_charges(readers.read_documents(spark, path, schemas.CHARGE_DOCUMENT)).orderBy("id").collect()
    first, second = rows
    assert first.asDict() == {
        "id": "c1", "object": "charge", "merchant_id": "m", "amount": 100, "currency": "usd", "status": "succeeded",
        "created": 5, "tax_amount_collected": 8, "source_store": "s", "billing_state": "CA", "billing_zip": "9",
        "billing_country": "US", "is_b2b": True, "exemption_cert_id": None, "shopify_order_id": "77",
    }
    assert second.id == "c2" and second.billing_state is None and second.is_b2b is None


def test_quoted_and_bare_metadata_values(spark, tmp_path):
    docs = [{"id": str(i), "metadata": {"is_b2b": v, "shopify_order_id": 77}} for i, v in enumerate([True, "true", "false", None])]
    df = readers.read_documents(spark, _json(tmp_path / "m.json", docs), schemas.CHARGE_DOCUMENT)
    rows = flatten.flatten_charges(df).orderBy("id").collect()
    assert [r.is_b2b for r in rows] == [True, True, False, None]
    assert {r.shopify_order_id for r in rows} == {"77"}


def test_json_lines_and_parquet_give_the_same(spark, tmp_path):
    lines = tmp_path / "c.jsonl"
    lines.write_text("\n".join(json.dumps({**CHARGE, "id": f"c{i}"}) for i in range(5)))
    docs = readers.read_documents(spark, str(lines), schemas.CHARGE_DOCUMENT, "json_lines")
    docs.write.parquet(str(tmp_path / "p"))
    again = readers.read_documents(spark, str(tmp_path / "p"), schemas.CHARGE_DOCUMENT, "parquet")
    assert flatten.flatten_charges(docs).exceptAll(flatten.flatten_charges(again)).isEmpty()
    assert again.count() == 5


def test_parquet_scan_reads_only_the_needed_leaves(spark, tmp_path):
    docs = readers.read_documents(spark, _json(tmp_path / "c.json", [CHARGE]), schemas.CHARGE_DOCUMENT)
    docs.write.parquet(str(tmp_path / "p"))
    flat = flatten.flatten_charges(readers.read_documents(spark, str(tmp_path / "p"), schemas.CHARGE_DOCUMENT, "parquet"))
    plan = flat.where("status = 'succeeded'").select("id", "billing_state")._jdf.queryExecution().executedPlan().toString()
    assert "billing_details:struct<address:struct<state:string>>" in plan
    assert "EqualTo(status,succeeded)" in plan and "line1" not in plan


def test_orders_lose_the_attribute_list(spark, tmp_path):
    docs = readers.read_documents(spark, _json(tmp_path / "o.json", [ORDER]), schemas.ORDER_DOCUMENT)
    flat = flatten.flatten_orders(docs)
    assert "note_attributes" not in flat.columns and "billing_address" not in flat.columns
    row = flat.first()
    assert (row.billing_state, row.billing_country, row.billing_zip, row.total_price) == ("CA", "US", "", "1.00")


def test_absent_nested_fields_become_null(spark):
    docs = spark.sql("SELECT 'c' AS id, named_struct('address', named_struct('state', 'CA')) AS billing_details")
    row = flatten.flatten_charges(docs).first()
    assert (row.billing_state, row.billing_zip, row.is_b2b) == ("CA", None, None)
    assert dict(flatten.flatten_charges(docs).dtypes)["is_b2b"] == "boolean"


def test_refund_conformance(spark, tmp_path):
    empty = readers.read_documents(spark, _json(tmp_path / "r.json", []), schemas.REFUND_DOCUMENT)
    assert flatten.conform_refunds(empty).dtypes == list(schemas.REFUND_COLUMNS.items())
    assert empty.count() == 0
    partial = spark.createDataFrame([(5, "r1", "x")], "amount int, id string, memo string")
    conformed = flatten.conform_refunds(partial)
    assert conformed.dtypes == list(schemas.REFUND_COLUMNS.items())
    assert conformed.first().amount == 5 and conformed.first().charge_id is None


def test_missing_and_malformed_inputs_stop_the_run(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_documents(spark, str(tmp_path / "nope.json"), schemas.REFUND_DOCUMENT)
    bad = _json(tmp_path / "bad.json", [{"id": "r", "amount": "lots"}])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_documents(spark, bad, schemas.REFUND_DOCUMENT).collect()
    with pytest.raises(ValueError, match="unknown source format"):
        readers.read_documents(spark, bad, schemas.REFUND_DOCUMENT, "xml")


def test_threshold_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    header = ",".join(schemas.THRESHOLD_COLUMNS)
    path.write_text(f"{header}\nCA,California,TRUE,500000,,,x\nAK,Alaska,FALSE,,,,\nNY,New York,true,500000,100,AND,\"a, b\"\n")
    rows = {r.state_code: tuple(r)[2:] for r in readers.read_thresholds(spark, str(path)).collect()}
    assert rows == {
        "CA": ("TRUE", "500000", None, None, "x"),
        "AK": ("FALSE", None, None, None, None),
        "NY": ("true", "500000", "100", "AND", "a, b"),
    }


def test_merchant_file(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"id": "m", "name": "M", "currency": "usd", "shopify_stores": ["a", "b"], "extra": 1}\n')
    assert tuple(readers.read_merchants(spark, str(path)).first()) == ("m", "M", "usd", ["a", "b"])


def test_folder_store_replaces(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    assert store.replace("t", spark.range(5)).count() == 5
    assert store.replace("t", spark.range(2)).count() == 2 == store.read("t").count()


def test_folder_store_replaces_all_or_nothing(spark, tmp_path):
    store, reader = FolderStore(spark, str(tmp_path)), FolderStore(spark, str(tmp_path))
    with store.refresh():
        store.replace("a", spark.range(1))
        store.replace("b", spark.range(1))
        with pytest.raises(LookupError, match="table not found: a"):
            reader.read("a")
    old = reader.read("a")
    with pytest.raises(RuntimeError, match="middle"):
        with store.refresh():
            assert store.replace("a", spark.range(7)).count() == 7
            raise RuntimeError("middle")
    assert (reader.read("a").count(), reader.read("b").count(), old.count()) == (1, 1, 1)
    store.replace("a", spark.range(3))
    # A query that found the former generation can end; the one before that is gone.
    assert (reader.read("a").count(), reader.read("b").count(), old.count()) == (3, 1, 1)
    store.replace("b", spark.range(4))
    assert (reader.read("a").count(), reader.read("b").count()) == (3, 4)
    store.replace("a", spark.range(5))
    assert len(list((tmp_path / "generations").iterdir())) == 3


def test_a_write_that_fails_leaves_nothing_behind(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    store.replace("t", spark.range(5))
    with pytest.raises(Exception, match="stop"):
        store.replace("t", spark.range(9).selectExpr("IF(id = 8, raise_error('stop'), id) AS id"))
    assert store.read("t").count() == 5
    assert len(list((tmp_path / "generations").iterdir())) == 1


def test_catalog_store_keeps_the_former_table_of_a_failed_refresh(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS atomic")
    try:
        spark.range(2).write.saveAsTable("atomic.t")  # as earlier versions wrote it
        store = CatalogStore(spark, "atomic")
        for n in (3, 4, 5):
            store.replace("t", spark.range(n))
            assert store.read("t").count() == n
        with pytest.raises(RuntimeError, match="middle"):
            with store.refresh():
                store.replace("t", spark.range(6))
                raise RuntimeError("middle")
        assert store.read("t").count() == 5
        assert spark.sql("SHOW TABLES IN atomic").count() == 3  # the view and two generations
    finally:
        spark.sql("DROP DATABASE atomic CASCADE")


def test_catalog_store_falls_back_to_the_qualified_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    store = CatalogStore(spark, "marts")
    store.replace("numbers", spark.range(3))
    assert store.replace("numbers", spark.range(4)).count() == 4
    assert store.read("numbers").count() == 4
    with pytest.raises(LookupError, match="absent"):
        store.read("absent")
    spark.range(1).createOrReplaceTempView("numbers")
    assert store.read("numbers").count() == 1
    spark.catalog.dropTempView("numbers")
    spark.sql("DROP DATABASE marts CASCADE")


def test_views(spark):
    register_views({"merchant_view": ref.merchant_table(spark)})
    assert spark.sql("SELECT count(*) AS n FROM merchant_view").first().n == 5
    spark.catalog.dropTempView("merchant_view")


def test_write_once_cuts_the_plan_and_keeps_the_rows(spark):
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    written = write_once(df, "counts")
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, df.collect()))
    assert written.dtypes == df.dtypes
    assert "Exchange" not in written._jdf.queryExecution().executedPlan().toString()
    assert scratch_folder(spark) == scratch_folder(spark)


class _Cluster:
    """A session as scratch_folder sees it: settings, and a context that is not local."""

    master = "yarn"

    def __init__(self, settings):
        self.conf, self.sparkContext = settings, self

    def getCheckpointDir(self):
        return None


def test_scratch_folder_of_a_cluster_comes_from_its_setting():
    assert scratch_folder(_Cluster({"spark.checkpoint.dir": "hdfs://shared/x/"})) == "hdfs://shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(_Cluster({}))


@pytest.mark.parametrize(
    "row",
    ["NY,New York,true,500000", "NY,New York,true,500000,100,AND,x,y,z", '"NY,New York,true,500000,100,AND,x', 'NY,"New York,true,500000,100,AND,x'],
    ids=["short", "long", "open quote", "open quote inside"],
)
def test_broken_threshold_rows_stop_the_run_or_are_listed(spark, tmp_path, row):
    path = tmp_path / "t.csv"
    path.write_text(",".join(schemas.THRESHOLD_COLUMNS) + f"\nCA,California,true,500000,,,x\n{row}\nOR,Oregon,false,,,,\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_thresholds(spark, str(path)).select("state_code").collect()
    left = readers.read_thresholds(spark, str(path), readers.SKIP)
    assert sorted(r.state_code for r in left.select("state_code").collect()) == ["CA", "OR"]
    listed = readers.rejected_records(spark, str(path), schemas.THRESHOLDS, "csv").collect()
    assert [r.record for r in listed] == [row] and listed[0].file.endswith("t.csv")


def test_state_codes_are_checked(spark):
    readers.check_state_codes(ref.threshold_table(spark))
    for codes in (["CA", "CA"], ["ca"], [None], ["California"], ['"NY"X']):
        with pytest.raises(ValueError, match="state codes"):
            readers.check_state_codes(spark.createDataFrame([(c,) for c in codes], "state_code string"))


def test_bad_json_is_listed(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"id": "a", "amount": 5}\n{"id": "b", "amount": "lots"}\n{"id": "c"\n')
    kept = readers.read_documents(spark, str(path), schemas.REFUND_DOCUMENT, "json_lines", readers.SKIP)
    assert [(r.id, r.amount) for r in kept.collect()] == [("a", 5)]
    listed = readers.rejected_records(spark, str(path), schemas.REFUND_DOCUMENT, "json_lines")
    assert sorted(r.record for r in listed.collect()) == ['{"id": "b", "amount": "lots"}', '{"id": "c"']
    assert '"id":"b"' in "".join(r.read_as for r in listed.collect())
    with pytest.raises(ValueError, match="not parsed one by one"):
        readers.rejected_records(spark, str(path), schemas.REFUND_DOCUMENT, "parquet")


def test_parquet_files_of_other_types(spark, tmp_path):
    """A boolean, a text and a missing is_b2b; amounts as numbers and text; dates of three deliveries in folders of their own."""
    path = str(tmp_path / "charges")
    deliveries = [
        ("id string, amount bigint, metadata struct<is_b2b: boolean, exemption_cert_id: string>", [("a", 5, (True, "C")), ("b", 6, (None, None))]),
        ("id string, amount int, metadata struct<is_b2b: boolean, exemption_cert_id: string>", [("c", 7, (False, None))]),
        ("id string, amount string, metadata struct<is_b2b: string, shopify_order_id: string>", [("d", "8", ("true", "9")), ("e", "9", None)]),
        ("id string, amount bigint, metadata struct<shopify_order_id: bigint>, more double", [("f", None, (77,), 0.5)]),
        ("id string, amount bigint, metadata struct<is_b2b: boolean, exemption_cert_id: string>", [("g", 1, (True, "D"))]),
    ]
    for day, (ddl, rows) in enumerate(deliveries):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{path}/day={day}")
    docs = readers.read_documents(spark, path, schemas.CHARGE_DOCUMENT, "parquet")
    flat = flatten.flatten_charges(docs)
    got = {r.id: (r.amount, r.is_b2b, r.exemption_cert_id, r.shopify_order_id) for r in flat.collect()}
    assert got == {
        "a": (5, True, "C", None), "b": (6, None, None, None), "c": (7, False, None, None), "d": (8, True, None, "9"),
        "e": (9, None, None, None), "f": (None, None, None, "77"), "g": (1, True, "D", None),
    }
    plan = flat.select("id", "is_b2b")._jdf.queryExecution().executedPlan().toString()
    assert "metadata:struct<is_b2b:boolean>" in plan and "metadata:struct<is_b2b:string>" in plan
    assert "exemption_cert_id" not in plan.split("ReadSchema", 1)[1].split("\n")[0]
    # Files of the same types are one scan, however many deliveries lie between them.
    assert plan.count("FileScan parquet") == 4


def test_declared_parquet_looks_at_no_footer(spark, tmp_path):
    path = str(tmp_path / "refunds")
    spark.createDataFrame([("r", 5, "x")], "id string, amount bigint, memo string").write.parquet(path)
    started = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    docs = readers.read_documents(spark, path, schemas.REFUND_DOCUMENT, "parquet_declared")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == started
    row = docs.first()
    assert (row.id, row.amount, row.charge_id) == ("r", 5, None) and "memo" not in docs.columns


def test_threshold_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "state_name,state_code,has_sales_tax,threshold_logic,transaction_threshold,sales_threshold_usd\n"
        "Oregon,OR, FALSE ,,200.0, 1000 \n"
    )
    row = nexus.clean_thresholds(readers.read_thresholds(spark, str(path))).first()
    assert row.state_code == "OR" and row.has_sales_tax == "false"
    assert row.transaction_threshold == 200 and row.sales_threshold_usd == 1000


def test_threshold_file_without_a_needed_column(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("state_code,state_name\nOR,Oregon\n")
    with pytest.raises(ValueError, match="has_sales_tax"):
        readers.read_thresholds(spark, str(path))


def test_parquet_files_with_other_columns_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "charges")
    one = "id string, amount bigint, metadata struct<shopify_order_id: string, is_b2b: boolean>"
    two = "id string, merchant_id string, metadata struct<shopify_order_id: string, exemption_cert_id: string>"
    spark.createDataFrame([("a", 5, ("1", True))], one).write.mode("append").parquet(path)
    spark.createDataFrame([("b", "m", ("2", "C"))], two).write.mode("append").parquet(path)
    docs = readers.read_documents(spark, path, schemas.CHARGE_DOCUMENT, "parquet")
    flat = {r.id: r for r in flatten.flatten_charges(docs).collect()}
    assert flat["b"].exemption_cert_id == "C" and flat["a"].exemption_cert_id is None
    assert flat["a"].amount == 5 and flat["b"].merchant_id == "m" and flat["a"].currency is None
