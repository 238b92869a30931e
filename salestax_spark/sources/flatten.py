"""Nested source documents to flat raw rows.

Only the nested fields that are used are selected, so a Parquet scan reads just those leaves. A field
missing from the input becomes a typed NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestax_spark.sources import schemas

CHARGE_FIELDS = {
    "billing_state": ("billing_details.address.state", "string"),
    "billing_zip": ("billing_details.address.postal_code", "string"),
    "billing_country": ("billing_details.address.country", "string"),
    "is_b2b": ("metadata.is_b2b", "boolean"),
    "exemption_cert_id": ("metadata.exemption_cert_id", "string"),
    "shopify_order_id": ("metadata.shopify_order_id", "string"),
}

ORDER_FIELDS = {
    "billing_state": ("billing_address.province_code", "string"),
    "billing_zip": ("billing_address.zip", "string"),
    "billing_country": ("billing_address.country_code", "string"),
}


def has_path(schema: T.StructType, path: str) -> bool:
    node: T.DataType = schema
    for step in path.split("."):
        if not isinstance(node, T.StructType) or step not in node.fieldNames():
            return False
        node = node[step].dataType
    return True


def nested_or_null(df: DataFrame, path: str, dtype: str) -> Column:
    return F.col(path).cast(dtype) if has_path(df.schema, path) else F.lit(None).cast(dtype)


def _pull_up(df: DataFrame, fields: dict[str, tuple[str, str]], dropped: set[str]) -> DataFrame:
    kept = [F.col(name) for name in df.columns if name not in dropped]
    pulled = [nested_or_null(df, path, dtype).alias(name) for name, (path, dtype) in fields.items()]
    return df.select(*kept, *pulled)


def flatten_charges(documents: DataFrame) -> DataFrame:
    return _pull_up(documents, CHARGE_FIELDS, {"billing_details", "metadata"})


def flatten_orders(documents: DataFrame) -> DataFrame:
    """The free-form attribute list is not carried into the raw table."""
    return _pull_up(documents, ORDER_FIELDS, {"billing_address", "note_attributes"})


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly the declared columns, in declared order and type; missing ones are NULL."""
    return df.select(*[nested_or_null(df, name, dtype).alias(name) for name, dtype in columns.items()])


def conform_refunds(documents: DataFrame) -> DataFrame:
    return conform(documents, schemas.REFUND_COLUMNS)
