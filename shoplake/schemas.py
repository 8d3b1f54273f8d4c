"""Declared schemas of the three feeds and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
NTZ = T.TimestampNTZType()
AUDIT_TS = T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Point-of-sale feed: 19 columns, mapped by position.
POS_COLUMNS = [
    "transaction_id",
    "store_id",
    "store_name",
    "store_city",
    "store_region",
    "cashier_id",
    "customer_id",
    "transaction_date",
    "transaction_time",
    "product_sku",
    "product_name",
    "category",
    "subcategory",
    "quantity",
    "unit_price",
    "discount_pct",
    "total_amount",
    "payment_method",
    "loyalty_points",
]
POS_TEXT = _struct(*[(name, STRING) for name in POS_COLUMNS])


def pos_bronze(money: T.DecimalType = MONEY) -> T.StructType:
    """Typed point-of-sale schema; ``money`` sets the two amount columns."""
    kinds = {
        "transaction_date": DATE,
        "quantity": INT,
        "unit_price": money,
        "discount_pct": INT,
        "total_amount": money,
        "loyalty_points": INT,
    }
    return _struct(*[(name, kinds.get(name, STRING)) for name in POS_COLUMNS])


# Purchase-order feed: 19 columns, mapped by name without regard to case.
ERP_BRONZE = _struct(
    ("order_id", STRING),
    ("order_date", STRING),
    ("store_id", STRING),
    ("store_city", STRING),
    ("supplier_id", STRING),
    ("supplier_name", STRING),
    ("supplier_city", STRING),
    ("product_sku", STRING),
    ("category", STRING),
    ("quantity_ordered", LONG),
    ("quantity_received", LONG),
    ("unit_cost", DOUBLE),
    ("total_cost", DOUBLE),
    ("order_status", STRING),
    ("expected_delivery", STRING),
    ("actual_delivery", STRING),
    ("warehouse_id", STRING),
    ("lead_time_days", LONG),
    ("is_late", T.BooleanType()),
)

# Sensor feed: one payload per event, six fields lifted out of it.
EVENTS_RAW = _struct(("raw_col", T.VariantType()))
IOT_BRONZE = _struct(
    ("event_id", STRING),
    ("event_type", STRING),
    ("store_id", STRING),
    ("store_name", STRING),
    ("events_ts", NTZ),
    ("device_id", STRING),
    ("raw_payload", T.VariantType()),
    ("source_file", STRING),
    ("loaded_at", AUDIT_TS),
)

SENSOR_SILVER = _struct(
    ("event_id", STRING),
    ("event_type", STRING),
    ("store_id", STRING),
    ("store_name", STRING),
    ("events_ts", NTZ),
    ("device_id", STRING),
    ("firmware", STRING),
    ("battery_pct", INT),
    ("signal_rssi", INT),
    ("store_floor_sensor", INT),
    ("sensor", STRING),
    ("sensor_value", DOUBLE),
    ("sensor_unit", STRING),
    ("source_file", STRING),
    ("loaded_at", AUDIT_TS),
    ("processing_ts", AUDIT_TS),
)


def pos_silver(money: T.DecimalType = MONEY) -> T.StructType:
    """Cleansed point-of-sale schema."""
    added = _struct(
        ("transaction_ts", NTZ), ("line_total", DOUBLE), ("processing_time", AUDIT_TS)
    )
    return T.StructType([*pos_bronze(money).fields, *added.fields])


ERP_SILVER = _struct(
    ("order_id", STRING),
    ("order_date", DATE),
    ("store_id", STRING),
    ("store_city", STRING),
    ("supplier_id", STRING),
    ("supplier_name", STRING),
    ("supplier_city", STRING),
    ("product_sku", STRING),
    ("category", STRING),
    ("quantity_ordered", LONG),
    ("quantity_received", LONG),
    ("unit_cost", T.DecimalType(12, 2)),
    ("total_cost", T.DecimalType(14, 2)),
    ("order_status", STRING),
    ("expected_delivery", DATE),
    ("actual_delivery", DATE),
    ("warehouse_id", STRING),
    ("lead_time_days", LONG),
    ("is_late", T.BooleanType()),
    ("processing_time", AUDIT_TS),
)
