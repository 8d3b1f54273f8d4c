"""Dimensions of the star schema.

Surrogate keys are dense and follow the natural key, so a rebuild from the same
rows gives the same keys.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import calendar_columns, run_time
from shoplake.operators import assign_surrogate_key, first_per_key


def _keyed(df: DataFrame, key: str, natural_key: str, run_ts: datetime | None) -> DataFrame:
    numbered = assign_surrogate_key(df, key, [natural_key])
    return numbered.withColumn("created_at", run_time(run_ts))


def dim_date(pos: DataFrame, erp: DataFrame, sensor: DataFrame) -> DataFrame:
    """Every calendar day seen in one of the three feeds."""
    days = [
        pos.select(F.col("transaction_date").alias("full_date")),
        erp.select(F.col("order_date").alias("full_date")),
        sensor.select(F.to_date("events_ts").alias("full_date")),
    ]
    seen = reduce(DataFrame.unionByName, days).where("full_date is not null").distinct()
    return seen.select(*calendar_columns(F.col("full_date")))


def dim_store(
    pos: DataFrame,
    sensor: DataFrame,
    coalesce_sources: bool = False,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per store, from sales and sensor events.

    The first row by store name is kept; between equal names one with a city
    wins. ``coalesce_sources`` instead takes city and region from sales and the
    floor from the sensors, for stores known to both.
    """
    floor = sensor.schema["store_floor_sensor"].dataType
    sold = pos.select(
        "store_id",
        "store_name",
        "store_city",
        "store_region",
        F.lit(None).cast(floor).alias("store_floor_sensor"),
    )
    sensed = sensor.select(
        "store_id",
        "store_name",
        F.lit(None).cast("string").alias("store_city"),
        F.lit(None).cast("string").alias("store_region"),
        "store_floor_sensor",
    )
    seen = sold.unionByName(sensed).where("store_id is not null")
    order = ["store_name", "store_city", "store_region", "store_floor_sensor"]
    stores = first_per_key(seen, ["store_id"], order)
    if coalesce_sources:
        floors = (
            sensed.where("store_id is not null and store_floor_sensor is not null")
            .groupBy("store_id")
            .agg(F.min("store_floor_sensor").alias("store_floor_sensor"))
        )
        stores = first_per_key(
            sold.where("store_id is not null").unionByName(
                sensed.where("store_id is not null").withColumn(
                    "store_floor_sensor", F.lit(None).cast(floor)
                )
            ),
            ["store_id"],
            order,
        )
        stores = stores.drop("store_floor_sensor").join(floors, "store_id", "left")
    return _keyed(
        stores.withColumn("store_floor_sensor", F.col("store_floor_sensor").cast("bigint")),
        "store_key",
        "store_id",
        run_ts,
    )


def dim_product(pos: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per SKU sold: the first by product name."""
    sold = pos.where("product_sku is not null").select(
        "product_sku", "product_name", "category", "subcategory"
    )
    products = first_per_key(sold, ["product_sku"], ["product_name"])
    return _keyed(products, "product_key", "product_sku", run_ts)


def dim_customer(pos: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Every known customer."""
    customers = pos.where("customer_id is not null").select("customer_id").distinct()
    return _keyed(customers, "customer_key", "customer_id", run_ts)


def dim_supplier(erp: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per supplier: the first by supplier name."""
    named = erp.where("supplier_id is not null").select(
        "supplier_id", "supplier_name", "supplier_city"
    )
    suppliers = first_per_key(named, ["supplier_id"], ["supplier_name"])
    return _keyed(suppliers, "supplier_key", "supplier_id", run_ts)
