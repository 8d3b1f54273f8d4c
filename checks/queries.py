"""Registered queries: every table and operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cache
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feeds
from shoplake import operators as ops
from shoplake import plans
from shoplake.plans.lakehouse import Lakehouse
from shoplake.schemas import ERP_BRONZE, ERP_SILVER, IOT_BRONZE, SENSOR_SILVER, pos_bronze, pos_silver
from shoplake.sources import CsvFormat, JsonFormat, read_csv_pos, read_event_payloads, read_json_events, read_parquet_erp
from shoplake.sources.pos_csv import typed_columns
from shoplake.storage import COMPRESSION, discard, free_shuffles, materialize, materialize_parts, remove, scratch_path, write_table
from shoplake.streaming import backfill, ingest_stream, listed_table, load_files, merge_stream, read_merged
from shoplake.tables import VersionedTable

Query = Callable[[SparkSession, str], DataFrame]

AUDIT = ("created_at", "processing_time", "processing_ts", "loaded_at", "source_file")
FACT_KEYS = ("sales_key", "order_key", "sensor_reading_key")

# Small enough that no side passes for broadcastable.
SHUFFLE_ONLY = 0


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT)


# --- raw and cleansed tables derived in place -------------------------------


def _pos_raw(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed(spark, sf, feeds.POS)


def _erp_raw(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed(spark, sf, feeds.ERP)


def _iot_raw(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed(spark, sf, feeds.IOT).select(
        "event_id",
        "event_type",
        "store_id",
        "store_name",
        "events_ts",
        "device_id",
        F.parse_json("raw_payload").alias("raw_payload"),
        F.lit("events").alias("source_file"),
        F.current_timestamp().alias("loaded_at"),
    )


def _pos(spark: SparkSession, sf: str) -> DataFrame:
    return plans.silver_pos(_pos_raw(spark, sf))


def _erp(spark: SparkSession, sf: str) -> DataFrame:
    return plans.silver_erp(_erp_raw(spark, sf))


def _sensor(spark: SparkSession, sf: str) -> DataFrame:
    return plans.silver_sensor(_iot_raw(spark, sf))


_SILVER = {"pos": _pos, "erp": _erp, "sensor": _sensor}


@cache
def _silver_path(spark: SparkSession, sf: str, name: str) -> str:
    path = scratch_path(spark, f"silver-{name}")
    write_table(_SILVER[name](spark, sf), path)
    return path


def stored_silver(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A cleansed table, written by its first reader in the session."""
    return spark.read.parquet(_silver_path(spark, sf, name))


# Each dimension with the cleansed tables it is made of; no other is stored for it.
_DIMS = {
    "date": (plans.dim_date, ("pos", "erp", "sensor")),
    "store": (plans.dim_store, ("pos", "sensor")),
    "product": (plans.dim_product, ("pos",)),
    "customer": (plans.dim_customer, ("pos",)),
    "supplier": (plans.dim_supplier, ("erp",)),
}


@cache
def _dim_path(spark: SparkSession, sf: str, name: str) -> str:
    path = scratch_path(spark, f"dim-{name}")
    build, tables = _DIMS[name]
    write_table(build(*[stored_silver(spark, sf, table) for table in tables]), path)
    return path


def stored_dim(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A dimension, written by its first reader in the session."""
    return spark.read.parquet(_dim_path(spark, sf, name))


def silver_pos(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_pos(spark, sf))


def silver_erp(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_erp(spark, sf))


def silver_sensor(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_sensor(spark, sf))


# --- dimensions ---------------------------------------------------------------


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return plans.dim_date(_pos(spark, sf), _erp(spark, sf), _sensor(spark, sf))


def dim_store(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(plans.dim_store(_pos(spark, sf), _sensor(spark, sf)))


def dim_store_both_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(plans.dim_store(_pos(spark, sf), _sensor(spark, sf), coalesce_sources=True))


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(plans.dim_product(_pos(spark, sf)))


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(plans.dim_customer(_pos(spark, sf)))


def dim_supplier(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(plans.dim_supplier(_erp(spark, sf)))


# --- facts, from stored cleansed tables and dimensions ----------------------------


def _sales(spark: SparkSession, sf: str, **options) -> DataFrame:
    dims = [stored_dim(spark, sf, name) for name in ("store", "product", "customer")]
    return plans.fct_sales(stored_silver(spark, sf, "pos"), *dims, **options)


def _purchase_orders(spark: SparkSession, sf: str) -> DataFrame:
    dims = [stored_dim(spark, sf, name) for name in ("store", "supplier")]
    return plans.fct_purchase_orders(stored_silver(spark, sf, "erp"), *dims)


def _iot_readings(spark: SparkSession, sf: str) -> DataFrame:
    stores = stored_dim(spark, sf, "store")
    return plans.fct_iot_sensor_readings(stored_silver(spark, sf, "sensor"), stores)


def _daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    stores = stored_dim(spark, sf, "store")
    return plans.fct_daily_sales(stored_silver(spark, sf, "pos"), stores)


def _margin(spark: SparkSession, sf: str) -> DataFrame:
    silver = [stored_silver(spark, sf, name) for name in ("pos", "erp")]
    return plans.fct_store_category_margin(*silver, stored_dim(spark, sf, "store"))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_sales(spark, sf)).drop(*FACT_KEYS)


def sales_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_sales(spark, sf, broadcast_limit=SHUFFLE_ONLY)).drop(*FACT_KEYS)


def sales_numbered(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_sales(spark, sf, key_order=["transaction_id"]))


def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_daily_sales(spark, sf))


def purchase_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_purchase_orders(spark, sf)).drop(*FACT_KEYS)


def margin(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_margin(spark, sf))


def iot_readings(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_iot_readings(spark, sf)).drop(*FACT_KEYS)


def fact_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Facts keyed without a shuffle: as many distinct keys as rows."""
    facts = {
        "sales_key": _sales(spark, sf),
        "order_key": _purchase_orders(spark, sf),
        "sensor_reading_key": _iot_readings(spark, sf),
    }
    checked = [
        df.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("key_count")).select(
            F.lit(key).alias("key_name"), "row_count", "key_count"
        )
        for key, df in facts.items()
    ]
    return checked[0].unionByName(checked[1]).unionByName(checked[2])


# --- validation -------------------------------------------------------------------


def validate_dims(spark: SparkSession, sf: str) -> DataFrame:
    return plans.validate_dims({f"dim_{name}": stored_dim(spark, sf, name) for name in _DIMS})


def validate_facts(spark: SparkSession, sf: str) -> DataFrame:
    return plans.validate_facts(
        {
            "fct_sales": _sales(spark, sf),
            "fct_daily_sales": _daily_sales(spark, sf),
            "fct_purchase_orders": _purchase_orders(spark, sf),
            "fct_store_category_margin": _margin(spark, sf),
            "fct_iot_sensor_readings": _iot_readings(spark, sf),
        }
    )


def expected_count(spark: SparkSession, sf: str) -> DataFrame:
    return plans.check_expected_count(_erp(spark, sf), 45_000)


# --- change feed and merge ------------------------------------------------------------


def _order_states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the orders: low ones arrive, urgent ones go, high ones cost more."""
    orders = feeds.table(spark, sf, "orders")
    dearer = F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 1)
    old = orders.where("o_orderpriority <> '5-LOW'")
    new = orders.where("o_orderpriority <> '1-URGENT'").withColumn(
        "o_totalprice", F.coalesce(dearer, "o_totalprice")
    )
    return old, new


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _order_states(spark, sf)
    return ops.change_feed(old, new, ["o_orderkey"]).withColumnsRenamed(
        {ops.ACTION: "action", ops.IS_UPDATE: "is_update"}
    )


def _merge_full(spark: SparkSession, sf: str, **options) -> DataFrame:
    old, new = _order_states(spark, sf)
    changes = materialize(ops.change_feed(old, new, ["o_orderkey"]), "changes")
    return ops.merge(old, changes, ["o_orderkey"], **options)


def merge_full(spark: SparkSession, sf: str) -> DataFrame:
    return _merge_full(spark, sf)


def merge_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return _merge_full(spark, sf, broadcast_limit=SHUFFLE_ONLY)


def merge_append(spark: SparkSession, sf: str) -> DataFrame:
    """All orders delivered again at another price: only unknown ones are added."""
    old, _ = _order_states(spark, sf)
    again = feeds.table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return ops.merge(old, ops.append_feed(again), ["o_orderkey"])


def merge_table(spark: SparkSession, sf: str) -> DataFrame:
    """Updates, inserts and deletes, each DELETE delivered three times, applied to a stored table."""
    old, new = _order_states(spark, sf)
    feed = ops.change_feed(old, new, ["o_orderkey"])
    again = feed.where(f"{ops.ACTION} = 'DELETE' and not {ops.IS_UPDATE}")
    changes = materialize(feed.unionByName(again).unionByName(again), "changes")
    table = VersionedTable(spark, scratch_path(spark, "merge-table"), old.schema, ["o_orderkey"])
    table.replace(old)
    table.merge(changes)
    return table.read()


def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is read, replaced in full, and read again: the first reader keeps its version."""
    old, new = _order_states(spark, sf)
    table = VersionedTable(spark, scratch_path(spark, "replace-table"), old.schema)
    table.replace(old)
    before = table.read()
    table.replace(new)
    states = {"before": before, "after": table.read(), "before again": table.read(1)}
    named = [df.select(F.lit(name).alias("state"), "*") for name, df in states.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Sales in six waves, each delivered again with the next one, then compacted."""
    rows = stored_silver(spark, sf, "pos")
    table = VersionedTable(spark, scratch_path(spark, "compaction"), rows.schema, ["transaction_id"])
    wave = F.col("transaction_id").cast("bigint") % 6
    for i in range(6):
        table.insert_absent(rows.where(wave.isin(i, i - 1)), loader="waves", batch=i)
        table.compact(max_segments=2)
    table.compact()
    return _plain(table.read())


def change_feed_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of events with a payload column, stores as keys: many rows to a key, and none for some.

    Which of a store's rows pair up is free, so rows are counted by event and action, and
    updates by store.
    """
    rows = feeds.feed(spark, sf, feeds.IOT).select(
        F.expr("case when cast(event_id as bigint) % 5 > 0 then store_id end").alias("store_id"),
        "event_id",
        "event_type",
        "raw_payload",
    )
    renamed = F.replace("raw_payload", F.lit('"firmware"'), F.lit('"release"'))
    moved = rows.withColumn("raw_payload", F.when(F.col("event_id").cast("bigint") % 7 == 0, renamed).otherwise(F.col("raw_payload")))
    old, new = (
        df.where(F.col("event_type") != left_out).withColumn("raw_payload", F.parse_json("raw_payload"))
        for df, left_out in ((rows, "click"), (moved, "view"))
    )
    feed = materialize(ops.change_feed(old, new, ["store_id"]), "payload-changes")
    release = F.variant_get("raw_payload", "$.release", "string")
    by_event = feed.groupBy("event_id", F.coalesce(release, F.lit("-")).alias("detail"), ops.ACTION).agg(F.count("*").alias("row_count"))
    by_store = feed.groupBy("store_id", F.col(ops.IS_UPDATE).cast("string").alias("detail"), ops.ACTION).agg(F.count("*").alias("row_count"))
    parts = [
        df.select(F.lit(by).alias("counted_by"), F.col(by).alias("id"), "detail", F.col(ops.ACTION).alias("action"), "row_count")
        for by, df in (("event_id", by_event), ("store_id", by_store))
    ]
    return parts[0].unionByName(parts[1])


# --- feeds through files ---------------------------------------------------------------


def _write_pos_files(rows: DataFrame, folder: str) -> str:
    """Compressed CSV; a file has the rows of one task."""
    rows.write.mode("append").csv(folder, header=True, nullValue="N/A", emptyValue="", quote="", compression="gzip")
    return folder


def _pos_once(spark: SparkSession, sf: str, label: str) -> DataFrame:
    """The sales feed for several deliveries, derived and stored once."""
    return materialize_parts(feeds.feed_parts(spark, sf, feeds.POS), label)


def _elements() -> Column:
    """An event as JSON text."""
    return F.concat(
        F.lit('{"event_id":"'),
        "event_id",
        F.lit('","event_type":"'),
        "event_type",
        F.lit('","store_id":"'),
        "store_id",
        F.lit('","store_name":"'),
        "store_name",
        F.lit('","timestamp":"'),
        F.col("events_ts").cast("string"),
        F.lit('","device_id":"'),
        "device_id",
        F.lit('",'),
        F.substring("raw_payload", 2, 1 << 30),
    )


def _write_iot_files(rows: DataFrame, folder: str, events_per_file: int = 2_000, compression: str = "gzip", tasks: int | None = None) -> str:
    """Files of one JSON array each; compressed ones are read by one task each.

    A task gathers the texts of many files at once. Where files are large, ``tasks``
    deals the events by file first, so that each of that many tasks has few files.
    """
    element = _elements()
    rows = rows.withColumn("file", F.floor(F.col("event_id").cast("bigint") / events_per_file))
    arrays = (
        (rows.repartition(tasks, "file") if tasks else rows)
        .groupBy("file")
        .agg(F.array_join(F.collect_list(element), ",\n").alias("body"))
        .select(F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
    )
    arrays.write.mode("append").option("maxRecordsPerFile", 1).text(folder, compression=compression)
    return folder


def bronze_pos(spark: SparkSession, sf: str) -> DataFrame:
    return read_csv_pos(spark, _write_pos_files(_pos_raw(spark, sf), scratch_path(spark, "csv")))


def bronze_iot(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.feed(spark, sf, feeds.IOT)
    folder = _write_iot_files(rows, scratch_path(spark, "json"))
    return _plain(read_json_events(spark, folder)).drop("raw_payload")


def bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.feed(spark, sf, feeds.IOT)
    folder = _write_iot_files(rows, scratch_path(spark, "json"))
    payload = read_event_payloads(spark, folder).select(
        F.variant_get("raw_col", "$.event_id", "string").alias("event_id"),
        F.variant_get("raw_col", "$.metadata.firmware", "string").alias("firmware"),
        F.variant_get("raw_col", "$.readings[1].value", "bigint").alias("second_value"),
    )
    return payload


def bronze_erp(spark: SparkSession, sf: str) -> DataFrame:
    rows = _erp_raw(spark, sf)
    folder = scratch_path(spark, "parquet")
    rows.toDF(*[c.upper() for c in rows.columns]).write.parquet(folder)
    return read_parquet_erp(spark, folder)


def _ingest(spark: SparkSession, feed: str, src: str, work: str) -> None:
    ingest_stream(spark, feed, src, f"{work}/raw", f"{work}/seen").awaitTermination()


def stream_pos(spark: SparkSession, sf: str) -> DataFrame:
    """Two regions arrive first, then the whole feed: known transactions are absorbed."""
    work, rows = scratch_path(spark, "stream-pos"), _pos_once(spark, sf, "stream-pos-feed")
    for wave in (rows.where("store_region in ('ASIA', 'EUROPE')"), rows):
        _write_pos_files(wave, f"{work}/src")
        if wave is rows:
            discard(rows)
        _ingest(spark, "pos", f"{work}/src", work)
        if wave is rows:
            remove(spark, f"{work}/src")
        merge_stream(
            spark,
            f"{work}/raw",
            pos_bronze(),
            f"{work}/silver",
            plans.silver_pos,
            ["transaction_id"],
            f"{work}/merged",
        ).awaitTermination()
    return _plain(read_merged(spark, f"{work}/silver", pos_silver()))


def stream_iot(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks arrive first, then all events: known events are absorbed."""
    work, rows = scratch_path(spark, "stream-iot"), feeds.feed(spark, sf, feeds.IOT)
    for wave in (rows.where("event_type = 'click'"), rows):
        _write_iot_files(wave, f"{work}/src")
        _ingest(spark, "iot", f"{work}/src", work)
        merge_stream(
            spark,
            f"{work}/raw",
            IOT_BRONZE,
            f"{work}/silver",
            plans.silver_sensor,
            ["event_id"],
            f"{work}/merged",
        ).awaitTermination()
    return _plain(read_merged(spark, f"{work}/silver", SENSOR_SILVER))


def stream_erp(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the two waves are loaded file by file, then refreshed in full."""
    work, rows = scratch_path(spark, "stream-erp"), materialize(_erp_raw(spark, sf), "stream-erp-feed")
    for wave in (rows.where("is_late"), rows.where("is_late is null or not is_late")):
        wave.write.mode("append").parquet(f"{work}/src")
        _ingest(spark, "erp", f"{work}/src", work)
    raw = spark.read.schema(ERP_BRONZE).parquet(f"{work}/raw")
    return _plain(plans.silver_erp(raw)).select(
        *[c for c in ERP_SILVER.fieldNames() if c not in AUDIT]
    )


def handover(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk load, then a stream, then the same stream from an empty checkpoint.

    Every eleventh order has no key, the others have one row per line.
    """
    work = scratch_path(spark, "handover")
    number = F.col("transaction_id")
    feed = _pos_once(spark, sf, "handover-feed")
    rows = feed.withColumn("transaction_id", F.when(number.cast("bigint") % 11 > 0, number))

    def follow(checkpoint: str) -> None:
        merge_stream(
            spark,
            f"{work}/raw",
            pos_bronze(),
            f"{work}/silver",
            plans.silver_pos,
            ["transaction_id"],
            f"{work}/{checkpoint}",
        ).awaitTermination()

    early = F.col("store_region").isin("ASIA", "EUROPE")
    _write_pos_files(rows.where(early), f"{work}/src")
    _ingest(spark, "pos", f"{work}/src", work)
    raw = spark.read.schema(pos_bronze()).parquet(f"{work}/raw")
    backfill(raw, f"{work}/silver", plans.silver_pos, ["transaction_id"])
    follow("merged")
    _write_pos_files(rows.where(~early), f"{work}/src")
    discard(feed)
    _ingest(spark, "pos", f"{work}/src", work)
    remove(spark, f"{work}/src")
    follow("merged")
    follow("merged-anew")
    return _plain(read_merged(spark, f"{work}/silver", pos_silver()))


def file_selection(spark: SparkSession, sf: str) -> DataFrame:
    """One region's files by their prefix, another's by an explicit list of files."""
    work, rows = scratch_path(spark, "selection"), _pos_once(spark, sf, "selection-feed")
    for region in ("ASIA", "EUROPE", "AFRICA"):
        _write_pos_files(rows.where(F.col("store_region") == region), f"{work}/{region.lower()}-1")
    by_prefix = read_csv_pos(spark, f"{work}/asia*")
    listed = spark.read.text(f"{work}/europe-1").inputFiles()
    return by_prefix.select(F.lit("prefix").alias("selected"), "*").unionByName(
        read_csv_pos(spark, listed).select(F.lit("list").alias("selected"), "*")
    )


def load_list_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Two lists of files that share one region's files, the second one loaded twice."""
    work, rows = scratch_path(spark, "lists"), _pos_once(spark, sf, "lists-feed")
    listed = {}
    for region in ("ASIA", "EUROPE", "AFRICA"):
        folder = _write_pos_files(rows.where(F.col("store_region") == region), f"{work}/{region.lower()}")
        listed[region] = spark.read.text(folder).inputFiles()
    for paths in (listed["ASIA"] + listed["EUROPE"], *[listed["EUROPE"] + listed["AFRICA"]] * 2):
        load_files(spark, "pos", paths, f"{work}/raw")
    return listed_table(spark, "pos", f"{work}/raw").read()


def csv_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Events as padded text: blanks around fields, four NULL tokens, dates and times of other patterns."""
    fmt = CsvFormat(delimiter="|", skip_header=False, date_format="dd.MM.yyyy", timestamp_format="dd/MM/yyyy HH-mm-ss")
    folder, number = scratch_path(spark, "csv-edges"), F.col("event_id") % 6
    tokens = F.when(number == 0, "NULL").when(number == 1, "null").when(number == 2, "").when(number == 3, "N/A")
    fields = [
        F.col("event_id").cast("string"),
        F.date_format("ts", "dd/MM/yyyy HH-mm-ss"),
        F.date_format("ts", "dd.MM.yyyy"),
        F.coalesce(tokens, F.col("value").cast("decimal(18,4)").cast("string")),
    ]
    padded = F.concat_ws("|", *[F.concat(F.lit("  "), f, F.lit(" ")) for f in fields])
    feeds.table(spark, sf, "events").select(F.concat(padded, F.lit("|")).alias("line")).write.text(folder)
    names = ["event_id", "event_ts", "event_day", "amount"]
    text = spark.read.schema(", ".join(f"{n} string" for n in [*names, "rest"])).options(**fmt.options())
    kinds = "event_id string, event_ts timestamp_ntz, event_day date, amount decimal(18,4)"
    return typed_columns(text.csv(folder), spark.createDataFrame([], kinds).schema, fmt)


def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that hold several elements of an array, with its brackets and commas."""
    rows, folder = feeds.feed(spark, sf, feeds.IOT), scratch_path(spark, "json-lines")
    number = F.col("event_id").cast("bigint")
    lines = rows.groupBy(F.floor(number / 7).alias("line")).agg(F.array_join(F.collect_list(_elements()), " , ").alias("body"))
    bracketed = F.concat(F.when(F.col("line") % 3 == 0, "[").otherwise("  "), "body", F.when(F.col("line") % 3 == 2, "]").otherwise(","))
    lines.select(bracketed.alias("value")).write.text(folder)
    return _plain(read_json_events(spark, folder, fmt=JsonFormat(layout="lines"))).drop("raw_payload")


def json_large_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of many events a file, cut between tasks, next to small files read whole."""
    rows, folder = feeds.feed(spark, sf, feeds.IOT), scratch_path(spark, "json-arrays")
    number, per_file = F.col("event_id").cast("bigint"), 50_000
    large = rows.where(number % 10 > 0)
    tasks = max(ceil(large.count() / per_file), spark.sparkContext.defaultParallelism)
    _write_iot_files(large, f"{folder}/large", per_file, "none", tasks)
    _write_iot_files(rows.where(number % 10 == 0), f"{folder}/small", 500, "none")
    events = read_json_events(spark, [f"{folder}/large", f"{folder}/small"], fmt=JsonFormat(split_above=1 << 17))
    return _plain(events).select(
        "*",
        F.variant_get("raw_payload", "$.metadata.firmware", "string").alias("firmware"),
        F.variant_get("raw_payload", "$.readings[1].value", "bigint").alias("second_value"),
    ).drop("raw_payload")


def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Load time, source file and creation time, as text, of one run at a fixed time."""
    run = datetime(2024, 5, 6, 7, 8, 9)
    folder = f"{scratch_path(spark, 'audit')}/sensor-feed"
    events = read_json_events(spark, _write_iot_files(feeds.feed(spark, sf, feeds.IOT), folder), run)
    stores = plans.dim_store(_pos(spark, sf), _sensor(spark, sf), run_ts=run)

    def text(column: str) -> Column:
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")

    loaded = events.select(
        F.col("event_id").alias("row_id"),
        F.regexp_extract("source_file", r"/([^/]+)/part-[^/]+$", 1).alias("origin"),
        text("loaded_at").alias("written"),
    )
    return loaded.unionByName(
        stores.select(F.col("store_id").alias("row_id"), F.lit("dim_store").alias("origin"), text("created_at").alias("written"))
    )


def lakehouse(spark: SparkSession, sf: str) -> DataFrame:
    """The whole build, from feed files to row counts of the star schema."""
    root = scratch_path(spark, "lakehouse")
    lake = Lakehouse(spark, root)

    def load(feed: str, parts: list[DataFrame], write: Callable[[DataFrame, str], object]) -> None:
        """Write the files of a feed, load them, and delete them."""
        folder = f"{root}/feeds/{feed}"
        for part in parts:
            write(part, folder)
            free_shuffles(spark)
        lake.load(feed, folder)
        remove(spark, folder)

    load("pos", feeds.feed_parts(spark, sf, feeds.POS), _write_pos_files)
    load("iot", [feeds.feed(spark, sf, feeds.IOT)], _write_iot_files)
    load("erp", feeds.feed_parts(spark, sf, feeds.ERP), lambda rows, folder: rows.write.mode("append").parquet(folder, compression=COMPRESSION))
    lake.build_silver()
    gold = lake.build_gold()
    return plans.validate_dims(gold).unionByName(plans.validate_facts(gold))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        margin,
        daily_sales,
        sales,
        sales_shuffled,
        sales_numbered,
        purchase_orders,
        iot_readings,
        fact_keys,
        silver_pos,
        silver_erp,
        silver_sensor,
        dim_date,
        dim_store,
        dim_store_both_sources,
        dim_product,
        dim_customer,
        dim_supplier,
        validate_dims,
        validate_facts,
        expected_count,
        change_feed,
        merge_full,
        merge_shuffled,
        merge_append,
        merge_table,
        replace_table,
        compaction,
        change_feed_payload,
        bronze_pos,
        bronze_iot,
        bronze_events,
        bronze_erp,
        stream_pos,
        stream_iot,
        stream_erp,
        handover,
        file_selection,
        load_list_twice,
        csv_edges,
        json_documents,
        json_large_arrays,
        audit_columns,
        lakehouse,
    )
}
