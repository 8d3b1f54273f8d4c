from __future__ import annotations

import datetime as dt
import os
import time

from shoplake.plans import silver_pos, silver_sensor
from shoplake.plans.lakehouse import Lakehouse
from shoplake.schemas import IOT_BRONZE, SENSOR_SILVER, pos_bronze, pos_silver
from shoplake.sources import JsonFormat, read_csv_pos, read_json_events
from shoplake.streaming import backfill, ingest_stream, merge_stream, read_merged
from tests.conftest import rows

HEADER = ",".join(f"h{i}" for i in range(19))


def line(tx, amount="4.05", store="S1"):
    return (
        f"{tx},{store},Shop,City,North,K1,C1,2024-01-02,09:05:06,P1,Milk,dairy,fresh,"
        f"3,1.50,10,{amount},Credit Card,7"
    )


def event(eid, *sensors):
    readings = ",".join(f'{{"sensor":"{s}","value":1,"unit":"u"}}' for s in sensors)
    return (
        f'{{"event_id":"{eid}","store_id":"S1","store_name":"Shop",'
        f'"timestamp":"2024-01-02 03:04:05","readings":[{readings}]}}'
    )


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def csv(folder, name, *lines):
    put(folder, name, "\n".join([HEADER, *lines]) + "\n")


def ingest(spark, feed, work, **options):
    ingest_stream(
        spark, feed, str(work / "src"), str(work / "raw"), str(work / "seen"), **options
    ).awaitTermination()


def merge(spark, work, schema, transform, keys):
    merge_stream(
        spark, str(work / "raw"), schema, str(work / "silver"), transform, keys, str(work / "done"),
        files_per_batch=1,
    ).awaitTermination()


def test_files_are_loaded_once(spark, tmp_path):
    csv(tmp_path / "src", "a.csv", line("1"))
    ingest(spark, "pos", tmp_path)
    ingest(spark, "pos", tmp_path)
    csv(tmp_path / "src", "b.csv", line("2"))
    ingest(spark, "pos", tmp_path)
    raw = spark.read.schema(pos_bronze()).parquet(str(tmp_path / "raw"))
    assert rows(raw, "transaction_id") == [("1",), ("2",)]


def test_files_dated_long_ago_are_loaded(spark, tmp_path):
    csv(tmp_path / "src", "a.csv", line("1"))
    ingest(spark, "pos", tmp_path)
    csv(tmp_path / "src", "b.csv", line("2"))
    old = time.time() - 40 * 86_400
    os.utime(tmp_path / "src" / "b.csv", (old, old))
    ingest(spark, "pos", tmp_path)
    raw = spark.read.schema(pos_bronze()).parquet(str(tmp_path / "raw"))
    assert rows(raw, "transaction_id") == [("1",), ("2",)]


def test_stream_in_steps_equals_one_batch(spark, tmp_path):
    for step in range(3):
        csv(tmp_path / "src", f"{step}.csv", *[line(f"{step}-{i}") for i in range(4)])
        ingest(spark, "pos", tmp_path)
        merge(spark, tmp_path, pos_bronze(), silver_pos, ["transaction_id"])
    run = dt.datetime(2024, 1, 1)
    batch = silver_pos(read_csv_pos(spark, str(tmp_path / "src")), run)
    stream = read_merged(spark, str(tmp_path / "silver"), pos_silver())
    assert stream.columns == batch.columns
    assert rows(stream.drop("processing_time")) == rows(batch.drop("processing_time"))


def test_redelivery_is_absorbed_but_unknown_keys_are_kept(spark, tmp_path):
    csv(tmp_path / "src", "a.csv", line("1", "1.00"), line("1", "2.00"), line("N/A", "3.00"))
    ingest(spark, "pos", tmp_path)
    merge(spark, tmp_path, pos_bronze(), silver_pos, ["transaction_id"])
    csv(tmp_path / "src", "b.csv", line("1", "9.00"), line("N/A", "4.00"), line("2", "5.00"))
    ingest(spark, "pos", tmp_path)
    merge(spark, tmp_path, pos_bronze(), silver_pos, ["transaction_id"])
    stored = read_merged(spark, str(tmp_path / "silver"), pos_silver())
    got = rows(stored.selectExpr("transaction_id", "cast(total_amount as string)"))
    assert got == [("1", "1.00"), ("1", "2.00"), ("2", "5.00"), (None, "3.00"), (None, "4.00")]


def test_a_batch_run_again_does_not_add_twice(spark, tmp_path):
    csv(tmp_path / "src", "a.csv", line("1"), line("N/A"))
    ingest(spark, "pos", tmp_path)
    for attempt in ("first", "second"):
        # A new checkpoint makes the stream run batch 0 once more.
        merge_stream(
            spark, str(tmp_path / "raw"), pos_bronze(), str(tmp_path / "silver"), silver_pos,
            ["transaction_id"], str(tmp_path / attempt),
        ).awaitTermination()
    stored = read_merged(spark, str(tmp_path / "silver"), pos_silver())
    assert rows(stored, "transaction_id") == [("1",), (None,)]


def test_sensor_stream_with_late_reading(spark, tmp_path):
    put(tmp_path / "src", "a.json", f"[{event('E1', 'a', 'b')},{event('E2')}]")
    ingest(spark, "iot", tmp_path)
    merge(spark, tmp_path, IOT_BRONZE, silver_sensor, ["event_id"])
    put(tmp_path / "src", "b.json", f"[{event('E1', 'a', 'c')},{event('E3', 'd')}]")
    ingest(spark, "iot", tmp_path)
    merge(spark, tmp_path, IOT_BRONZE, silver_sensor, ["event_id"])
    stored = read_merged(spark, str(tmp_path / "silver"), SENSOR_SILVER)
    # The event is the key: a reading that arrives later is not added ...
    assert rows(stored, "event_id", "sensor") == [("E1", "a"), ("E1", "b"), ("E3", "d")]
    # ... unless the reading's sensor is made part of the key.
    merge_stream(
        spark, str(tmp_path / "raw"), IOT_BRONZE, str(tmp_path / "silver2"), silver_sensor,
        ["event_id", "sensor"], str(tmp_path / "done2"), files_per_batch=1,
    ).awaitTermination()
    finer = read_merged(spark, str(tmp_path / "silver2"), SENSOR_SILVER)
    assert rows(finer, "event_id", "sensor") == [("E1", "a"), ("E1", "b"), ("E1", "c"), ("E3", "d")]


def test_backfill_then_stream(spark, tmp_path):
    csv(tmp_path / "src", "a.csv", line("1"))
    ingest(spark, "pos", tmp_path)
    backfill(spark.read.schema(pos_bronze()).parquet(str(tmp_path / "raw")), str(tmp_path / "silver"), silver_pos)
    csv(tmp_path / "src", "b.csv", line("2"))
    ingest(spark, "pos", tmp_path)
    merge(spark, tmp_path, pos_bronze(), silver_pos, ["transaction_id"])
    stored = read_merged(spark, str(tmp_path / "silver"), pos_silver())
    assert rows(stored, "transaction_id") == [("1",), ("2",)]


def test_json_lines_and_payload_feeds(spark, tmp_path):
    put(tmp_path / "src", "a.json", f"{event('E1', 'a')}\n{event('E2', 'b')}\n")
    ingest(spark, "events", tmp_path, fmt=JsonFormat(layout="lines"))
    raw = spark.read.schema("raw_col variant").parquet(str(tmp_path / "raw"))
    assert rows(raw.selectExpr("variant_get(raw_col, '$.event_id', 'string')")) == [("E1",), ("E2",)]


def test_payload_survives_storage_for_replay(spark, tmp_path):
    put(tmp_path / "src", "a.json", f"[{event('E1', 'a', 'b')}]")
    ingest(spark, "iot", tmp_path)
    stored = spark.read.schema(IOT_BRONZE).parquet(str(tmp_path / "raw"))
    direct = read_json_events(spark, str(tmp_path / "src"))
    audit = ("loaded_at", "processing_ts", "source_file")
    assert rows(silver_sensor(stored).drop(*audit)) == rows(silver_sensor(direct).drop(*audit))


def test_whole_lakehouse(spark, tmp_path):
    csv(tmp_path / "pos", "a.csv", line("1"), line("2", store="S2"), line("3", store="N/A"))
    put(tmp_path / "iot", "a.json", f"[{event('E1', 'a', 'b')}]")
    spark.sql(
        "select 'O1' as order_id, '2024-01-02' as order_date, 'S1' as store_id, 'V' as supplier_id,"
        " 'Dairy' as category, 4L as quantity_ordered, 1.0D as total_cost, 'open' as order_status"
    ).write.parquet(str(tmp_path / "erp"))
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    for feed in ("pos", "iot", "erp", "events"):
        lake.load(feed, str(tmp_path / ("iot" if feed == "events" else feed)))
    lake.build_silver()
    for partitioned in (False, True):
        gold = lake.build_gold(partition_facts=partitioned)
        counts = {name: df.count() for name, df in gold.items()}
        assert counts == {
            "dim_date": 1,
            "dim_store": 2,
            "dim_product": 1,
            "dim_customer": 1,
            "dim_supplier": 1,
            "fct_sales": 3,
            "fct_purchase_orders": 1,
            "fct_iot_sensor_readings": 2,
            "fct_daily_sales": 2,
            "fct_store_category_margin": 2,
        }
        margin = rows(gold["fct_store_category_margin"], "store_key", "ordered_units")
        assert margin == [(1, 4), (2, 0)]
        assert len(set(rows(gold["fct_sales"], "sales_key"))) == 3
        assert rows(gold["fct_sales"], "date_key") == [(20240102,)] * 3
    # A second load of the same files adds nothing.
    assert lake.load("pos", str(tmp_path / "pos")).count() == 3


def test_lakehouse_updates_without_a_full_refresh(spark, tmp_path):
    csv(tmp_path / "pos", "a.csv", line("1"), line("2"))
    put(tmp_path / "iot", "a.json", f"[{event('E1', 'a', 'b')}]")
    spark.sql("select 'O1' as order_id").write.parquet(str(tmp_path / "erp"))
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    for feed in ("pos", "iot", "erp"):
        lake.load(feed, str(tmp_path / feed))
    lake.build_silver()
    lake.update_silver()
    csv(tmp_path / "pos", "b.csv", line("2", "9.99"), line("3"))
    put(tmp_path / "iot", "b.json", f"[{event('E2', 'c')}]")
    spark.sql("select 'O2' as order_id").write.mode("append").parquet(str(tmp_path / "erp"))
    for feed in ("pos", "iot", "erp"):
        lake.load(feed, str(tmp_path / feed))
    silver = lake.update_silver()
    sold = silver["stg_csv_transaction"].selectExpr("transaction_id", "cast(total_amount as string)")
    assert rows(sold) == [("1", "4.05"), ("2", "4.05"), ("3", "4.05")]
    assert rows(silver["stg_json_sensor"], "event_id", "sensor") == [
        ("E1", "a"),
        ("E1", "b"),
        ("E2", "c"),
    ]
    assert rows(silver["stg_erp_orders"], "order_id") == [("O1",), ("O2",)]
    # A full refresh takes later versions of a transaction as they are in the raw table.
    again = lake.build_silver()["stg_csv_transaction"]
    assert again.count() == 4


def test_no_raw_file_is_taken_in_twice(spark, tmp_path):
    csv(tmp_path / "src", "a.csv", line("1"), line("N/A"))
    ingest(spark, "pos", tmp_path)
    backfill(spark.read.schema(pos_bronze()).parquet(str(tmp_path / "raw")), str(tmp_path / "silver"), silver_pos)
    def follow(checkpoint):
        merge_stream(
            spark, str(tmp_path / "raw"), pos_bronze(), str(tmp_path / "silver"), silver_pos,
            ["transaction_id"], str(tmp_path / checkpoint), files_per_batch=1,
        ).awaitTermination()
        return rows(read_merged(spark, str(tmp_path / "silver"), pos_silver()), "transaction_id")

    assert follow("one") == [("1",), (None,)]
    for name in ("b", "c"):
        csv(tmp_path / "src", f"{name}.csv", line(name), line(name), line("N/A"))
        ingest(spark, "pos", tmp_path)
    wanted = [("1",), ("b",), ("b",), ("c",), ("c",), (None,), (None,), (None,)]
    assert follow("one") == wanted
    assert follow("two") == wanted
