"""Declared schemas and the fixed value domains of the order data."""

from __future__ import annotations

from pyspark.sql import types as T


def struct_of(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields in the given order."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


TEXT, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()

# Raw order files. Every field is nullable: unreadable cells arrive as NULL.
ORDERS = struct_of(
    order_id=TEXT,
    customer_id=TEXT,
    order_amount=DOUBLE,
    order_date=T.DateType(),
    product_category=TEXT,
    payment_method=TEXT,
    delivery_status=TEXT,
    customer_age=T.IntegerType(),
)

# The order shape plus the source key (tie-break) and the arrival batch.
TRACKED_ORDERS = T.StructType(
    [
        T.StructField("src_key", LONG, True),
        *ORDERS.fields,
        T.StructField("batch_id", LONG, True),
    ]
)

# A table of rules: parameters are typed columns, unused ones NULL.
RULES = struct_of(
    column=TEXT,
    rule_type=TEXT,
    min_value=DOUBLE,
    max_value=DOUBLE,
    accepted=T.ArrayType(TEXT),
    max_null_rate=DOUBLE,
    reasoning=TEXT,
)

# Per-batch check history.
HISTORY = struct_of(
    dataset_name=TEXT,
    check=TEXT,
    column=TEXT,
    status=TEXT,
    metric=DOUBLE,
    timestamp=T.TimestampType(),
    batch=TEXT,
)

# Fixed values of the order domain.
CATEGORIES = ("Electronics", "Clothing", "Books", "Food")
INVALID_CATEGORIES = ("Unknown", "INVALID", "???", "TestCategory")
PAYMENT_METHODS = ("UPI", "Card", "COD")
DELIVERY_STATUSES = ("Delivered", "Pending", "Cancelled")
MIN_AGE, MAX_AGE = 18, 100

# Audit columns: written by the layers, left out of profiles.
INGESTED_AT, TRANSFORMED_AT = "ingested_at", "transformed_at"
AUDIT_COLUMNS = (INGESTED_AT, TRANSFORMED_AT)
