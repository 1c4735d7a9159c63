"""Schemas of raw tables, and where each staged column is found in a payload."""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)

PAGE = T.StructType(
    [T.StructField("page_no", T.LongType()), T.StructField("body", T.StringType())]
)

CURSOR_STATE = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("cursor_field", T.StringType()),
        T.StructField("cursor_value", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

JOB_HISTORY = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("run_started_at", T.TimestampType()),
        T.StructField("run_completed_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)

# Payload field names. Staged column -> path in the payload.

PRODUCT = {
    "product_title": "title",
    "handle": "handle",
    "vendor": "vendor",
    "product_type": "product_type",
    "status": "status",
    "tags": "tags",
    "product_created_at": "created_at",
    "product_updated_at": "updated_at",
    "product_published_at": "published_at",
}

VARIANT = {
    "variant_key": "id",
    "sku": "sku",
    "variant_title": "title",
    "barcode": "barcode",
    "price": "price",
    "compare_at_price": "compare_at_price",
    "inventory_quantity": "inventory_quantity",
    "inventory_item_id": "inventory_item_id",
    "inventory_policy": "inventory_policy",
    "inventory_management": "inventory_management",
    "variant_created_at": "created_at",
    "variant_updated_at": "updated_at",
}

LOCATION = {
    "location_name": "name",
    "address1": "address1",
    "address2": "address2",
    "city": "city",
    "province": "province",
    "province_code": "province_code",
    "country": "country",
    "country_code": "country_code",
    "postcode": "zip",
    "is_active": "active",
    "is_legacy": "legacy",
    "location_created_at": "created_at",
    "location_updated_at": "updated_at",
}

INVENTORY_LEVEL = {
    "inventory_item_id": "inventory_item_id",
    "location_id": "location_id",
    "available_quantity": "available",
    "inventory_level_updated_at": "updated_at",
}

ORDER = {
    "order_name": "name",
    "customer_email": "email",
    "financial_status": "financial_status",
    "fulfillment_status": "fulfillment_status",
    "total_price": "total_price",
    "subtotal_price": "subtotal_price",
    "total_tax": "total_tax",
    "total_discounts": "total_discounts",
    "currency": "currency",
    "tags": "tags",
    "order_created_at": "created_at",
    "order_updated_at": "updated_at",
    "order_cancelled_at": "cancelled_at",
}

ORDER_LINE = {
    "order_line_id": "id",
    "line_product_id": "product_id",
    "variant_id": "variant_id",
    "sku": "sku",
    "product_name": "name",
    "variant_title": "variant_title",
    "vendor": "vendor",
    "quantity": "quantity",
    "unit_price": "price",
    "total_discount": "total_discount",
}

SHIPPING_LINE = {"discounted_price": "discounted_price", "price": "price"}

REFUND_LINE = {
    "line_location_id": "location_id",
    "refund_subtotal": "subtotal",
    "refund_tax": "total_tax",
    "quantity": "quantity",
}

CUSTOMER = {
    "email": "email",
    "first_name": "first_name",
    "last_name": "last_name",
    "phone": "phone",
    "customer_state": "state",
    "tags": "tags",
    "currency": "currency",
    "orders_count": "orders_count",
    "total_spent": "total_spent",
    "verified_email": "verified_email",
    "tax_exempt": "tax_exempt",
    "email_marketing_state": "email_marketing_consent.state",
    "email_marketing_opt_in_level": "email_marketing_consent.opt_in_level",
    "email_marketing_consent_updated_at": "email_marketing_consent.consent_updated_at",
    "sms_marketing_state": "sms_marketing_consent.state",
    "sms_marketing_opt_in_level": "sms_marketing_consent.opt_in_level",
    "sms_marketing_consent_updated_at": "sms_marketing_consent.consent_updated_at",
    "customer_created_at": "created_at",
    "customer_updated_at": "updated_at",
    "last_order_id": "last_order_id",
    "last_order_name": "last_order_name",
    "default_country": "default_address.country",
    "default_country_code": "default_address.country_code",
    "default_province": "default_address.province",
    "default_province_code": "default_address.province_code",
    "default_city": "default_address.city",
    "default_postcode": "default_address.zip",
    "default_phone": "default_address.phone",
}

# Entity -> (array field of a page, id paths, has an updated_at cursor)
ENTITIES = {
    "product": ("products", ("id",), True),
    "order": ("orders", ("id",), True),
    "customer": ("customers", ("id",), True),
    "location": ("locations", ("id",), False),
    "inventory_level": ("inventory_levels", ("inventory_item_id", "location_id"), False),
}
CURSOR_FIELD = "updated_at"
