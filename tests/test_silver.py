from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplake.plans import silver_erp, silver_pos, silver_sensor
from shoplake.schemas import ERP_BRONZE, ERP_SILVER, IOT_BRONZE, SENSOR_SILVER, pos_bronze, pos_silver
from tests.conftest import rows

RUN = dt.datetime(2024, 5, 1, 12, 0, 0)


def pos_rows(spark, *overrides):
    base = {f.name: None for f in pos_bronze()}
    return spark.createDataFrame([tuple((base | o).values()) for o in overrides], pos_bronze())


def erp_rows(spark, *overrides):
    base = {f.name: None for f in ERP_BRONZE}
    return spark.createDataFrame([tuple((base | o).values()) for o in overrides], ERP_BRONZE)


def iot_rows(spark, *events):
    """Events as (event_id, payload text)."""
    df = spark.createDataFrame(list(events), "event_id string, payload string")
    made = {"event_id": F.col("event_id"), "raw_payload": F.parse_json("payload")}
    return df.select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in IOT_BRONZE]
    )


def test_pos_schema_and_audit(spark):
    df = silver_pos(pos_rows(spark, {"transaction_id": "T"}), RUN)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in pos_silver()
    ]
    assert rows(df, "processing_time", "line_total") == [(RUN, 0.0)]


@pytest.mark.parametrize(
    "column, given, kept",
    [
        ("quantity", [-1, 0, None, 4], [0, 0, 0, 4]),
        ("unit_price", [Decimal("-1.00"), None, Decimal("2.50")], [0, 0, Decimal("2.50")]),
        ("discount_pct", [-5, 0, None, 120], [0, 0, 0, 120]),
    ],
)
def test_pos_floors(spark, column, given, kept):
    for value, expected in zip(given, kept):
        got = silver_pos(pos_rows(spark, {column: value})).select(column).first()[0]
        assert got == expected


def test_pos_payment_codes(spark):
    methods = ["credit card", "Debit Card", "CREDIT CARD", "Cash", " credit card", None]
    df = silver_pos(
        pos_rows(spark, *[{"transaction_id": str(i), "payment_method": m} for i, m in enumerate(methods)])
    )
    got = [r[1] for r in rows(df, "transaction_id", "payment_method")]
    assert got == ["CC", "DC", "CC", "Cash", " credit card", None]


def test_pos_transaction_time(spark):
    day = dt.date(2024, 3, 10)
    df = silver_pos(
        pos_rows(
            spark,
            {"transaction_id": "1", "transaction_date": day, "transaction_time": "02:30:00"},
            {"transaction_id": "2", "transaction_date": day},
            {"transaction_id": "3", "transaction_time": "02:30:00"},
        )
    )
    assert rows(df, "transaction_id", "transaction_ts") == [
        ("1", dt.datetime(2024, 3, 10, 2, 30)),
        ("2", None),
        ("3", None),
    ]


def test_pos_category_upper_only(spark):
    df = silver_pos(pos_rows(spark, {"category": "Dairy", "subcategory": "Milk"}))
    assert rows(df, "category", "subcategory") == [("DAIRY", "Milk")]


def test_erp_types_and_rounding(spark):
    df = silver_erp(
        erp_rows(
            spark,
            {
                "order_date": "2024-01-31",
                "category": "dairy",
                "order_status": "open",
                "unit_cost": 1.005,
                "total_cost": 2.345,
                "actual_delivery": None,
            },
        ),
        RUN,
    )
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ERP_SILVER]
    assert rows(df, "order_date", "category", "order_status", "unit_cost", "total_cost") == [
        (dt.date(2024, 1, 31), "DAIRY", "OPEN", Decimal("1.01"), Decimal("2.35"))
    ]


def test_erp_bad_date_fails(spark):
    with pytest.raises(Exception):
        silver_erp(erp_rows(spark, {"order_date": "31.01.2024"})).collect()


META = '"metadata":{"firmware":"1.2","battery_pct":55.5,"signal_rssi":-70,"store_floor":null}'


def test_sensor_unnests_readings(spark):
    df = silver_sensor(
        iot_rows(
            spark,
            ("two", f'{{{META},"readings":[{{"sensor":"t","value":1.5,"unit":"C"}},{{"sensor":"h","value":"2"}}]}}'),
            ("empty", f'{{{META},"readings":[]}}'),
            ("none", f"{{{META}}}"),
            (None, '{"readings":[{"sensor":"z","value":null}]}'),
        )
    )
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in SENSOR_SILVER
    ]
    columns = ["event_id", "firmware", "battery_pct", "signal_rssi", "store_floor_sensor"]
    assert rows(df, *columns, "sensor", "sensor_value", "sensor_unit") == [
        ("two", "1.2", 56, -70, None, "h", 2.0, None),
        ("two", "1.2", 56, -70, None, "t", 1.5, "C"),
        (None, None, None, None, None, "z", None, None),
    ]


def test_sensor_bad_value(spark):
    events = iot_rows(spark, ("bad", '{"readings":[{"value":"n/a"},{"value":3}]}'))
    with pytest.raises(Exception):
        silver_sensor(events).collect()
    assert rows(silver_sensor(events, on_bad_value="null"), "sensor_value") == [(3.0,), (None,)]


def test_sensor_shredding_does_not_shuffle(spark):
    events = iot_rows(spark, ("e", "{}"))
    plan = silver_sensor(events)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
