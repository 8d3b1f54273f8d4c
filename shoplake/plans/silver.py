"""Cleansed, typed tables. Every one is a narrow projection of its raw table."""

from __future__ import annotations

from datetime import datetime
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import (
    floor_at_zero,
    payload_int,
    payload_text,
    payment_code,
    run_time,
)
from shoplake.schemas import ERP_SILVER, SENSOR_SILVER, pos_silver


def silver_pos(bronze: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Upper-case category, amounts floored at zero, payment codes, transaction time."""
    money = bronze.schema["unit_price"].dataType
    moment = F.concat(F.col("transaction_date").cast("string"), F.lit(" "), "transaction_time")
    changed = {
        "category": F.upper("category"),
        "quantity": floor_at_zero(F.col("quantity"), bronze.schema["quantity"].dataType),
        "unit_price": floor_at_zero(F.col("unit_price"), money),
        "discount_pct": floor_at_zero(
            F.col("discount_pct"), bronze.schema["discount_pct"].dataType
        ),
        "payment_method": payment_code(F.col("payment_method")),
        "transaction_ts": moment.cast("timestamp_ntz"),
        "line_total": F.lit(0.0),
        "processing_time": run_time(run_ts),
    }
    return bronze.select(
        *[changed.get(name, F.col(name)).alias(name) for name in pos_silver().fieldNames()]
    )


def silver_erp(bronze: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Dates parsed, category and status upper case, costs as exact decimals."""
    changed = {
        "order_date": F.to_date("order_date"),
        "category": F.upper("category"),
        "order_status": F.upper("order_status"),
        "expected_delivery": F.to_date("expected_delivery"),
        "actual_delivery": F.to_date("actual_delivery"),
        "processing_time": run_time(run_ts),
    }
    return bronze.select(
        *[
            changed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in ERP_SILVER
        ]
    )


def silver_sensor(
    bronze_iot: DataFrame,
    on_bad_value: Literal["fail", "null"] = "fail",
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per reading; events without readings give none.

    A reading whose value is no number fails the query, or becomes NULL with
    ``on_bad_value="null"``.
    """
    payload = F.col("raw_payload")
    events = bronze_iot.select(
        *[c for c in bronze_iot.columns if c != "raw_payload"],
        payload_text(payload, "$.metadata.firmware").alias("firmware"),
        payload_int(payload, "$.metadata.battery_pct").alias("battery_pct"),
        payload_int(payload, "$.metadata.signal_rssi").alias("signal_rssi"),
        payload_int(payload, "$.metadata.store_floor").alias("store_floor_sensor"),
        F.variant_get(payload, "$.readings", "variant").alias("readings"),
    )
    listed = bronze_iot.sparkSession.tvf.variant_explode(F.col("readings").outer())
    unnested = events.lateralJoin(listed)
    reading = F.col("value")
    number = payload_text(reading, "$.value")
    shredded = {
        "sensor": payload_text(reading, "$.sensor"),
        "sensor_value": number.try_cast("double")
        if on_bad_value == "null"
        else number.cast("double"),
        "sensor_unit": payload_text(reading, "$.unit"),
        "processing_ts": run_time(run_ts),
    }
    return unnested.select(
        *[shredded.get(name, F.col(name)).alias(name) for name in SENSOR_SILVER.fieldNames()]
    )
