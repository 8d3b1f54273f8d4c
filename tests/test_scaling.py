"""What the feeds and versioned tables must not move or store."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, StructType

from checks import feeds, queries
from shoplake import tables
from shoplake.plans.lakehouse import MERGE_KEYS, SILVER_TABLES, Lakehouse
from shoplake.schemas import pos_silver
from shoplake.tables import VersionedTable


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _tables(spark, folder):
    """A few rows of each table of the feeds; one line has no part, one order no customer."""
    made = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(3, "INDIA", 0), (4, "FRANCE", 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(1, "a", 3), (2, "b", 4), (3, "c", None)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(7, "s", 3), (8, "t", 4)]),
        "part": ("p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double", [(5, "x", "T", "B", 9.5), (6, "y", "U", "C", 8.5)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string",
            [(10, 1, "O", "2024-01-02", "1-URGENT"), (11, 2, "F", "2024-01-03", "5-LOW"), (12, 3, "F", "2024-01-04", "2-HIGH"), (13, 99, "F", "2024-01-04", "2-HIGH")],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_returnflag string, l_linestatus string, l_shipdate string",
            [(o, p, 7 + n % 2, n, 2.0, 19.0, 0.05, "R", "F", "2024-02-01") for n, (o, p) in enumerate([(10, 5), (10, 5), (11, 6), (11, 77), (12, 5), (13, 6), (None, 5)], 1)],
        ),
    }
    for name, (schema, rows) in made.items():
        df = spark.createDataFrame(rows, schema)
        for c in ("o_orderdate", "l_shipdate"):
            df = df.withColumn(c, F.col(c).cast("timestamp")) if c in df.columns else df
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_feeds_shuffle_lines_by_order_only(spark, tmp_path):
    _tables(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for text in (feeds.POS, feeds.ERP):
            tables = {n: spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in feeds.TABLES if f"{{{n}}}" in text}
            made, plain = feeds.feed(spark, str(tmp_path), text), spark.sql(text, **tables)
            assert made.schema == plain.schema
            assert _rows(made) == _rows(plain) and made.count() > 0
            plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert "o_custkey" in plan and plan.count("BroadcastHashJoin") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_dimension_stores_its_own_cleansed_tables_only(spark, sf_dir, monkeypatch):
    stored, path = [], queries._silver_path
    monkeypatch.setattr(queries, "_silver_path", lambda s, sf, name: stored.append(name) or path(s, sf, name))
    for name, tables in {"product": ["pos"], "supplier": ["erp"], "store": ["pos", "sensor"]}.items():
        queries._dim_path.cache_clear()
        stored.clear()
        queries.stored_dim(spark, sf_dir, name)
        assert stored == tables


def test_rows_enter_buckets_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 3).withColumn("task", F.spark_partition_id())
    table = VersionedTable(spark, str(tmp_path / "t"), rows.schema, ["id"], buckets=4)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    table.insert_absent(rows)
    held = table.read().withColumn("file", F.input_file_name()).groupBy("file").agg(F.count_distinct("task").alias("n"))
    assert {r.n for r in held.collect()} == {1}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    table.insert_absent(spark.range(2000, 5000, 1, 3).withColumn("task", F.spark_partition_id()))
    table.compact()
    assert _rows(table.read().select("id")) == _rows(spark.range(5000))
    assert len(table.read().inputFiles()) <= 8


def test_keys_held_many_times_enter_a_filter_once(spark, tmp_path):
    rows = spark.range(0, 400).select((F.col("id") % 40).alias("k"), "id")
    table = VersionedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], buckets=2)
    table.replace(rows)
    table.insert_absent(spark.range(0, 60).select(F.col("id").alias("k"), "id"))
    assert table.read().count() == 420
    assert table.read().where("k >= 40").count() == 20


def test_sales_files_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("", "c")], "x string, y string")
    folder = queries._write_pos_files(rows, str(tmp_path / "csv"))
    assert all(f.endswith(".csv.gz") for f in spark.read.text(folder).inputFiles())


def test_large_files_are_dealt_to_many_tasks(spark, tmp_path):
    events = [(None if i == 5 else str(i), "t", "S1", "N", "2024-01-01 00:00:00", "D1", '{"k":1}') for i in range(400)] * 2
    columns = "event_id string, event_type string, store_id string, store_name string, events_ts string, device_id string, raw_payload string"
    rows, written = spark.createDataFrame(events, columns), {}
    for tasks in (None, 40):
        folder = queries._write_iot_files(rows, str(tmp_path / f"{tasks}"), 10, "none", tasks)
        text = spark.read.text(folder, wholetext=True)
        # Elements of a file come in any order.
        written[tasks] = sorted(str(sorted(r.value.strip("[]\n").split(",\n"))) for r in text.collect())
        made = {f.rsplit("/", 1)[1].split("-")[1] for f in text.inputFiles()}
    assert written[40] == written[None] and len(written[40]) == 41
    # The session has 8 tasks a shuffle, whatever the size.
    assert len(made) > 8


def test_parts_of_a_feed_are_the_feed(spark, tmp_path, monkeypatch):
    _tables(spark, str(tmp_path))
    monkeypatch.setattr(feeds, "LINES_PER_PART", 2)
    for text in (feeds.POS, feeds.ERP):
        parts = feeds.feed_parts(spark, str(tmp_path), text)
        whole = feeds.feed(spark, str(tmp_path), text)
        assert len(parts) == 4 and all(p.schema == whole.schema for p in parts)
        assert sum((_rows(p) for p in parts), Counter()) == _rows(whole)
        assert sum(p.count() > 0 for p in parts) >= 2
    monkeypatch.setattr(feeds, "LINES_PER_PART", 100)
    assert len(feeds.feed_parts(spark, str(tmp_path), feeds.POS)) == 1


def test_large_inserts_meet_held_keys_by_bucket(spark, tmp_path, monkeypatch):
    """Where keys can't be broadcast, only rows of some buckets are shuffled at once."""
    old = spark.createDataFrame([(i, "old") for i in range(100)] + [(None, "old")], "id long, x string")
    new = spark.createDataFrame([(i, "new") for i in range(50, 200)] + [(150, "again"), (None, "new"), (None, "new")], old.schema)
    table = VersionedTable(spark, str(tmp_path / "t"), old.schema, ["id"], buckets=4, broadcast_limit=0)
    table.insert_absent(old)
    met, insert = [], tables.insert_absent
    monkeypatch.setattr(tables, "insert_absent", lambda held, rows, *a, **b: met.append(rows.count()) or insert(held, rows, *a, **b))
    table.insert_absent(new)
    assert _rows(table.read()) == _rows(old) + _rows(new.where("id is null or id >= 100"))
    assert len(met) == 4 and max(met) < 100
    assert not list(Path(tmp_path, "t").glob("staged/*"))
    table.insert_absent(new.where("id is not null"))
    assert table.read().where("x <> 'old'").count() == 103


@pytest.mark.parametrize("name", ["stream_pos", "handover", "lakehouse"])
def test_feeds_are_deleted_when_loaded(spark, sf_dir, name):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    known = set(root.glob("shoplake/*/*"))
    queries.QUERIES[name](spark, sf_dir)
    made = set(root.glob("shoplake/*/*")) - known
    assert made and not [d for d in made if "feed" in d.name or list(d.glob("src")) or list(d.glob("feeds/*"))]


def test_filters_are_not_asked_for_very_many_keys(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 300).withColumn("x", F.lit(1))
    table = VersionedTable(spark, str(tmp_path / "t"), rows.schema, ["id"], buckets=2)
    table.replace(rows)
    asked, may_hold = [], VersionedTable._may_hold
    monkeypatch.setattr(VersionedTable, "_may_hold", lambda self, segments, wanted: asked.append(len(segments)) or may_hold(self, segments, wanted))
    for most in (1_000, 20):
        monkeypatch.setattr(tables, "ASKED", most)
        found, _ = table.candidates(table.version(), rows.where("id % 2 = 0"))
        assert len(found) == 2
    assert asked == [2, 0]
    table.insert_absent(spark.range(200, 400).withColumn("x", F.lit(2)))
    assert table.read().count() == 400


def test_sales_facts_are_made_in_parts(spark, tmp_path, monkeypatch):
    """Parts of whole buckets give the facts that the whole table gives, with keys of their own."""
    pos = spark.createDataFrame(
        [(f"{i}", f"S{i % 3}", "N", None, None, None, f"C{i % 5}", None, None, f"P{i % 7}", "x", "c", "s", 1, 2, 0, 3, None, 1, None, 0.0, None) for i in range(200)] * 2,
        StructType([StructField(f.name, StringType() if f.name in ("transaction_date", "transaction_ts", "processing_time") else f.dataType if not isinstance(f.dataType, DecimalType) else IntegerType()) for f in pos_silver()]),
    ).select(*[F.col(f.name).cast(f.dataType) for f in pos_silver()])
    pos = pos.withColumn("transaction_date", F.expr("case when cast(transaction_id as int) % 11 > 0 then date_add(date'2024-01-01', cast(transaction_id as int) % 9) end"))
    found = {}
    for rows in (1 << 24, 60):
        lake = Lakehouse(spark, str(tmp_path / f"lake{rows}"))
        for name, (table, schema) in SILVER_TABLES.items():
            made = pos if name == "pos" else spark.createDataFrame([], schema)
            VersionedTable(spark, lake.path("staging", table), schema, MERGE_KEYS.get(name, ())).replace(made)
        parts = VersionedTable.read_parts
        monkeypatch.setattr(VersionedTable, "read_parts", lambda self, number=None, rows=rows: parts(self, number, rows))
        gold = lake.build_gold(run_ts=datetime(2024, 1, 1))
        monkeypatch.undo()
        sales = gold["fct_sales"]
        assert sales.agg(F.count_distinct("sales_key")).first()[0] == sales.count() == 400
        found[rows] = [_rows(sales.drop("sales_key")), _rows(gold["fct_daily_sales"])]
        if rows == 60:
            assert sales.where(F.col("sales_key") >= 1 << 58).count() > 0
    assert found[60] == found[1 << 24] and len(found[60][1]) > 9
