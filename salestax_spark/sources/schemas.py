"""Declared schemas (DDL) of the source documents and of the reference tables.

Free-form metadata values and order money are read as text, since feeds deliver them with and without quotes;
flattening and staging cast them strictly.
"""

from __future__ import annotations

CHARGE_DOCUMENT = """
    id string, object string, merchant_id string, amount bigint, currency string, status string, created bigint,
    billing_details struct<
        email: string, name: string,
        address: struct<city: string, country: string, line1: string, postal_code: string, state: string>>,
    metadata struct<shopify_order_id: string, is_b2b: string, exemption_cert_id: string>,
    tax_amount_collected bigint, source_store string
"""

ORDER_DOCUMENT = """
    id bigint, name string, merchant_id string, source_store string, created_at string, currency string,
    total_price string, subtotal_price string, total_tax string, taxes_included boolean, financial_status string,
    billing_address struct<
        address1: string, city: string, province_code: string, country_code: string, zip: string>,
    stripe_charge_id string, note_attributes array<struct<name: string, value: string>>
"""

REFUND_COLUMNS = {
    "id": "string",
    "object": "string",
    "merchant_id": "string",
    "amount": "bigint",
    "currency": "string",
    "status": "string",
    "created": "bigint",
    "charge_id": "string",
}

THRESHOLD_COLUMNS = {
    "state_code": "string",
    "state_name": "string",
    "has_sales_tax": "boolean",
    "sales_threshold_usd": "double",
    "transaction_threshold": "bigint",
    "threshold_logic": "string",
    "notes": "string",
}

THRESHOLD_OPTIONAL = ("state_name", "notes")

MERCHANT_COLUMNS = {
    "id": "string",
    "name": "string",
    "currency": "string",
    "shopify_stores": "array<string>",
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {dtype}" for name, dtype in columns.items())


REFUND_DOCUMENT = ddl(REFUND_COLUMNS)
THRESHOLDS = ddl(THRESHOLD_COLUMNS)
MERCHANTS = ddl(MERCHANT_COLUMNS)
