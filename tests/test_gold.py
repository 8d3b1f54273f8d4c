from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplake import plans
from shoplake.schemas import ERP_SILVER, SENSOR_SILVER, pos_silver
from tests.conftest import rows

D1, D2 = dt.date(2023, 1, 1), dt.date(2024, 2, 29)


def table(spark, schema, *overrides):
    base = {f.name: None for f in schema}
    return spark.createDataFrame([tuple((base | o).values()) for o in overrides], schema)


def sale(tx, day=D1, store="S1", category="FOOD", amount="10.00", quantity=1, **more):
    return {
        "transaction_id": tx,
        "transaction_date": day,
        "store_id": store,
        "category": category,
        "total_amount": None if amount is None else Decimal(amount),
        "quantity": quantity,
        **more,
    }


def order(oid, day=D1, store="S1", category="FOOD", cost="4.00", **more):
    return {
        "order_id": oid,
        "order_date": day,
        "store_id": store,
        "category": category,
        "total_cost": Decimal(cost),
        "quantity_ordered": 5,
        "quantity_received": 3,
        **more,
    }


def pos(spark, *overrides):
    return table(spark, pos_silver(), *overrides)


def erp(spark, *overrides):
    return table(spark, ERP_SILVER, *overrides)


def sensor(spark, *overrides):
    return table(spark, SENSOR_SILVER, *overrides)


def stores(spark, *ids):
    return spark.createDataFrame([(i + 1, s) for i, s in enumerate(ids)], "store_key bigint, store_id string")


# --- dimensions ------------------------------------------------------------------


def test_dim_date_attributes(spark):
    df = plans.dim_date(
        pos(spark, sale("1"), sale("2", day=None)),
        erp(spark, order("O", day=D1)),
        sensor(spark, {"events_ts": dt.datetime(2024, 2, 29, 23, 59)}, {}),
    )
    assert rows(df) == [
        (20230101, D1, 1, "Sun", 52, 1, "Jan", 1, 2023),
        (20240229, D2, 29, "Thu", 9, 2, "Feb", 1, 2024),
    ]


def test_dim_store_prefers_the_row_with_a_city(spark):
    sold = pos(
        spark,
        {"store_id": "S2", "store_name": "B", "store_city": "C2", "store_region": "R"},
        {"store_id": "S1", "store_name": "A", "store_city": "C1", "store_region": "R"},
        {"store_id": "S1", "store_name": None, "store_city": "C0", "store_region": "R"},
        {"store_name": "nobody"},
    )
    sensed = sensor(
        spark,
        {"store_id": "S1", "store_name": "A", "store_floor_sensor": 2},
        {"store_id": "S3", "store_name": "C", "store_floor_sensor": 1},
    )
    columns = ["store_key", "store_id", "store_name", "store_city", "store_floor_sensor"]
    assert rows(plans.dim_store(sold, sensed), *columns) == [
        (1, "S1", "A", "C1", None),
        (2, "S2", "B", "C2", None),
        (3, "S3", "C", None, 1),
    ]
    both = plans.dim_store(sold, sensed, coalesce_sources=True)
    assert rows(both, *columns) == [
        (1, "S1", "A", "C1", 2),
        (2, "S2", "B", "C2", None),
        (3, "S3", "C", None, 1),
    ]


def test_dim_product_customer_supplier(spark):
    sold = pos(
        spark,
        {"product_sku": "P1", "product_name": "b", "category": "X"},
        {"product_sku": "P1", "product_name": "a", "category": "Z", "subcategory": "s"},
        {"product_sku": "P1", "product_name": "a", "category": "Y"},
        {"customer_id": "C2"},
        {"customer_id": "C1"},
        {"customer_id": "C2"},
    )
    run = dt.datetime(2024, 1, 1)
    assert rows(plans.dim_product(sold, run)) == [(1, "P1", "a", "Y", None, run)]
    assert rows(plans.dim_customer(sold, run)) == [(1, "C1", run), (2, "C2", run)]
    bought = erp(
        spark,
        {"supplier_id": "V", "supplier_name": None, "supplier_city": "a"},
        {"supplier_id": "V", "supplier_name": "n", "supplier_city": "b"},
        {"supplier_name": "unknown"},
    )
    assert rows(plans.dim_supplier(bought, run)) == [(1, "V", "n", "b", run)]


# --- facts ---------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_fct_sales_measures_and_unknown_members(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sold = pos(
        spark,
        sale("1", product_sku="P1", customer_id="C1", quantity=3, unit_price=Decimal("1.99"),
             discount_pct=15, loyalty_points=4, amount="5.00"),
        sale("2", store=None, day=None, quantity=0, unit_price=Decimal("0"), discount_pct=0),
        sale("3", store="unknown", customer_id="nobody"),
    )
    product = spark.createDataFrame([(7, "P1")], "product_key bigint, product_sku string")
    customer = spark.createDataFrame([(9, "C1")], "customer_key bigint, customer_id string")
    df = plans.fct_sales(sold, stores(spark, "S1"), product, customer, broadcast_limit=limit)
    columns = [
        "transaction_id", "date_key", "store_key", "product_key", "customer_key",
        "gross_amount", "discount_amount", "net_sales_amount", "loyalty_points",
    ]
    got = rows(df, *columns)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # 3 * 1.99 = 5.97; 15 % of it is 0.8955.
    assert got == [
        ("1", 20230101, 1, 7, 9, Decimal("5.97"), Decimal("0.90"), Decimal("5.00"), 4),
        ("2", None, None, None, None, 0, 0, Decimal("10.00"), None),
        ("3", 20230101, None, None, None, None, None, Decimal("10.00"), None),
    ]
    assert df.columns[0] == "sales_key" and df.columns[-1] == "created_at"


def test_fct_daily_sales(spark):
    sold = pos(
        spark,
        sale("1", customer_id="C1", amount="0.01"),
        sale("1", customer_id="C1", amount="0.01"),
        sale("2", amount="0.01", quantity=4),
        sale("3", category=None),
        sale(None, category=None),
        sale(None, category="LOST"),
        sale("4", store=None),
        sale("5", store="unknown"),
    )
    df = plans.fct_daily_sales(sold, stores(spark, "S1")).drop("created_at")
    assert rows(df) == [
        (D1, 1, "FOOD", Decimal("0.03"), 6, 2, 1, Decimal("0.02")),
        (D1, 1, "LOST", Decimal("10.00"), 1, 0, 0, None),
        (D1, 1, None, Decimal("20.00"), 2, 1, 0, Decimal("20.00")),
    ]


def test_fct_purchase_orders_unknown_store(spark):
    supplier = spark.createDataFrame([(3, "V")], "supplier_key bigint, supplier_id string")
    df = plans.fct_purchase_orders(
        erp(spark, order("O1", supplier_id="V", is_late=True), order("O2", store="ERP only")),
        stores(spark, "S1"),
        supplier,
    )
    assert rows(df, "order_id", "store_key", "supplier_key", "date_key", "is_late") == [
        ("O1", 1, 3, 20230101, True),
        ("O2", None, None, 20230101, None),
    ]


def test_fct_margin(spark):
    sold = pos(
        spark,
        sale("1", amount="3.00"),
        sale("2", amount="3.00", quantity=2),
        sale("3", category="NO ORDERS"),
        sale("4", category="FREE", amount="0.00"),
        sale("5", category="LOSS", amount="3.00"),
        sale("6", category=None),
        sale("7", category="UNKNOWN", amount=None),
        sale("8", store=None),
        sale("9", store="not in dim"),
    )
    bought = erp(
        spark,
        order("O1", is_late=True),
        order("O2", is_late=None, cost="0.50"),
        order("O3", category="FREE", is_late=False),
        order("O4", category="LOSS"),
        order("O5", category="NO SALE"),
        order("O6", category=None),
        order("O7", day=D2),
    )
    df = plans.fct_store_category_margin(sold, bought, stores(spark, "S1")).drop("created_at")
    m = Decimal
    assert rows(df) == [
        (D1, 1, "FOOD", m("6.00"), m("4.50"), m("1.50"), m("25.00"), 3, 10, 6, 1),
        (D1, 1, "FREE", m("0.00"), m("4.00"), m("-4.00"), m("0.00"), 1, 5, 3, 0),
        (D1, 1, "LOSS", m("3.00"), m("4.00"), m("-1.00"), m("-33.33"), 1, 5, 3, 0),
        (D1, 1, "NO ORDERS", m("10.00"), m("0.00"), m("10.00"), m("100.00"), 1, 0, 0, 0),
        (D1, 1, "UNKNOWN", None, m("0.00"), None, None, 1, 0, 0, 0),
        (D1, 1, None, m("10.00"), m("0.00"), m("10.00"), m("100.00"), 1, 0, 0, 0),
    ]


def test_fct_margin_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    df = plans.fct_store_category_margin(
        pos(spark, sale("1")), erp(spark, order("O")), stores(spark, "S1")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") == 2


def test_fct_iot_readings(spark):
    df = plans.fct_iot_sensor_readings(
        sensor(
            spark,
            {"event_id": "E", "store_id": "S1", "events_ts": dt.datetime(2024, 2, 29, 1), "sensor_value": 1.23456},
            {"event_id": "F", "sensor_value": None},
        ),
        stores(spark, "S1"),
    )
    assert rows(df, "event_id", "date_key", "store_key", "sensor_value") == [
        ("E", 20240229, 1, Decimal("1.2346")),
        ("F", None, None, None),
    ]


def test_expected_count(spark):
    assert rows(plans.check_expected_count(spark.range(3), 3)) == [(3, 3, True)]
    assert rows(plans.check_expected_count(spark.range(3), 4)) == [(3, 4, False)]


def test_silver_reads_only_what_a_dimension_needs(spark, tmp_path):
    path = str(tmp_path / "pos")
    pos(spark, sale("1", customer_id="C")).write.parquet(path)
    known = spark.read.parquet(path).where("customer_id is not null").select("customer_id").distinct()
    text = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string>" in text and "IsNotNull(customer_id)" in text


# --- invariants over the driver tables ---------------------------------------------------


@pytest.fixture(scope="module")
def feeds(spark, sf_dir):
    from checks import queries as q

    return (q._pos(spark, sf_dir).cache(), q._erp(spark, sf_dir).cache(), q._sensor(spark, sf_dir).cache())


def test_grains_are_unique(spark, feeds):
    sold, bought, sensed = feeds
    store = plans.dim_store(sold, sensed)
    daily = plans.fct_daily_sales(sold, store)
    margin = plans.fct_store_category_margin(sold, bought, store)
    for df, grain in (
        (plans.dim_date(sold, bought, sensed), ["full_date"]),
        (store, ["store_id"]),
        (plans.dim_product(sold), ["product_sku"]),
        (daily, ["sales_date", "store_key", "category"]),
        (margin, ["margin_date", "store_key", "category"]),
    ):
        assert df.count() == df.select(*grain).distinct().count()
    known = sold.where("store_id is not null").agg(F.sum("total_amount")).first()[0]
    assert daily.agg(F.sum("total_revenue")).first()[0] == known
    assert margin.agg(F.sum("sales_revenue")).first()[0] == known


def test_lookups_keep_every_fact_row(spark, feeds):
    sold, bought, sensed = feeds
    store = plans.dim_store(sold, sensed)
    facts = [
        (plans.fct_sales(sold, store, plans.dim_product(sold), plans.dim_customer(sold)), sold),
        (plans.fct_purchase_orders(bought, store, plans.dim_supplier(bought)), bought),
        (plans.fct_iot_sensor_readings(sensed, store), sensed),
    ]
    for fact, source in facts:
        assert fact.count() == source.count()
