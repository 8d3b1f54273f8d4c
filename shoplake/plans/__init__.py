"""Tables of the lakehouse as functions from DataFrames to DataFrames."""

from shoplake.plans.dims import dim_customer, dim_date, dim_product, dim_store, dim_supplier
from shoplake.plans.facts import (
    fct_daily_sales,
    fct_iot_sensor_readings,
    fct_purchase_orders,
    fct_sales,
    fct_store_category_margin,
)
from shoplake.plans.silver import silver_erp, silver_pos, silver_sensor
from shoplake.plans.validate import check_expected_count, validate_dims, validate_facts

__all__ = [
    "check_expected_count",
    "dim_customer",
    "dim_date",
    "dim_product",
    "dim_store",
    "dim_supplier",
    "fct_daily_sales",
    "fct_iot_sensor_readings",
    "fct_purchase_orders",
    "fct_sales",
    "fct_store_category_margin",
    "silver_erp",
    "silver_pos",
    "silver_sensor",
    "validate_dims",
    "validate_facts",
]
