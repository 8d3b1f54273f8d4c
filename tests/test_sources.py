from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import DecimalType, StructType, TimestampNTZType

from shoplake.schemas import IOT_BRONZE, pos_bronze
from shoplake.sources import (
    CsvFormat,
    JsonFormat,
    read_csv_pos,
    read_event_payloads,
    read_json_events,
    read_parquet_erp,
)
from shoplake.sources.pos_csv import typed_columns
from tests.conftest import rows

RUN = dt.datetime(2024, 5, 1, 12, 0, 0)

EVENT = (
    '{"event_id":"E1","event_type":"t","store_id":"S1","store_name":"A","device_id":"D1",'
    '"timestamp":"2024-01-02T03:04:05Z","readings":[{"sensor":"x","value":1}]}'
)

HEADER = ",".join(f"h{i}" for i in range(19))
GOOD = (
    "T1,S1,Shop,City,North,K1,C1,2024-01-02,09:05:06,P1,Milk,dairy,fresh,3,1.50,10,4.05,cash,7"
)


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


# --- JSON ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "text",
    [
        f"[{EVENT},{EVENT.replace('E1', 'E2')}]",
        f"[\n  {EVENT},\n  {EVENT.replace('E1', 'E2')}\n]\n",
    ],
)
def test_json_array_gives_one_row_per_element(spark, tmp_path, text):
    path = _file(tmp_path / "in", "a.json", text)
    df = read_json_events(spark, path, RUN)
    assert df.schema.fieldNames() == IOT_BRONZE.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in IOT_BRONZE]
    got = rows(df, "event_id", "store_name", "events_ts", "loaded_at")
    # The zone of the text is dropped.
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == [("E1", "A", moment, RUN), ("E2", "A", moment, RUN)]
    files = {r.source_file.rsplit("/", 1)[1] for r in df.select("source_file").collect()}
    assert files == {"a.json"}


def test_json_payload_is_kept_whole(spark, tmp_path):
    path = _file(tmp_path / "in", "a.json", '[{"event_id":"E1","other":{"deep":[1,2]}}]')
    df = read_event_payloads(spark, path)
    assert rows(df.selectExpr("to_json(raw_col)")) == [('{"event_id":"E1","other":{"deep":[1,2]}}',)]


def test_json_missing_and_null_fields_are_null(spark, tmp_path):
    path = _file(tmp_path / "in", "a.json", '[{"store_id":null}]')
    assert rows(read_json_events(spark, path), "event_id", "store_id", "events_ts") == [
        (None, None, None)
    ]


def test_json_single_object_and_empty_array(spark, tmp_path):
    path = _file(tmp_path / "in", "a.json", EVENT)
    _file(tmp_path / "in", "b.json", "[]")
    assert rows(read_json_events(spark, path), "event_id") == [("E1",)]


def test_json_malformed_file_fails(spark, tmp_path):
    path = _file(tmp_path / "in", "a.json", f"[{EVENT},")
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_events(spark, path).collect()


def test_json_lines_layout_splits_by_line(spark, tmp_path):
    second = EVENT.replace("E1", "E2").replace('"A"', '"},{ [x], "')
    path = _file(tmp_path / "in", "a.json", f"[{EVENT},\n  {EVENT.replace('E1', 'E3')} ,\n{EVENT}\n]\n\n")
    lines = JsonFormat(layout="lines")
    assert rows(read_json_events(spark, path, fmt=lines), "event_id") == [("E1",), ("E1",), ("E3",)]
    ndjson = _file(tmp_path / "nd", "a.json", f"{EVENT}\n{second}\n")
    assert rows(read_json_events(spark, ndjson, fmt=lines), "event_id") == [("E1",), ("E2",)]


def test_json_file_list_and_prefix(spark, tmp_path):
    for name in ("batch_01.json", "batch_02.json", "other.json"):
        folder = _file(tmp_path / "in", name, f"[{EVENT.replace('E1', name)}]")
    listed = read_json_events(spark, [f"{folder}/batch_01.json", f"{folder}/other.json"])
    assert rows(listed, "event_id") == [("batch_01.json",), ("other.json",)]
    prefixed = read_json_events(spark, f"{folder}/batch*")
    assert rows(prefixed, "event_id") == [("batch_01.json",), ("batch_02.json",)]


# --- CSV ----------------------------------------------------------------------


def test_csv_is_positional_and_typed(spark, tmp_path):
    df = read_csv_pos(spark, _file(tmp_path / "in", "a.csv", f"{HEADER}\n{GOOD}\n"))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in pos_bronze()
    ]
    assert rows(df) == [
        (
            "T1", "S1", "Shop", "City", "North", "K1", "C1", dt.date(2024, 1, 2), "09:05:06", "P1",
            "Milk", "dairy", "fresh", 3, Decimal("1.50"), 10, Decimal("4.05"), "cash", 7,
        )
    ]


def test_csv_trims_and_cleans_null_tokens(spark, tmp_path):
    line = " T1 ,N/A,null,NULL,, k , C1 ,N/A,null,P1,M,NULL,f,,NULL,null,N/A,N/A,"
    df = read_csv_pos(spark, _file(tmp_path / "in", "a.csv", f"{HEADER}\n{line}\n"))
    assert rows(df) == [
        ("T1", None, None, None, None, "k", "C1", None, None, "P1", "M", None, "f")
        + (None,) * 6
    ]


def test_csv_null_tokens_match_whole_fields_only(spark, tmp_path):
    line = GOOD.replace("Milk", "null milk").replace("dairy", "Null").replace("fresh", "n/a")
    df = read_csv_pos(spark, _file(tmp_path / "in", "a.csv", f"{HEADER}\n{line}\n"))
    assert rows(df, "product_name", "category", "subcategory") == [("null milk", "Null", "n/a")]


def test_csv_header_is_skipped_once_per_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        folder = _file(tmp_path / "in", name, f"{HEADER}\n{GOOD}\n{GOOD}\n")
    assert read_csv_pos(spark, folder).count() == 4


@pytest.mark.parametrize(
    "line",
    [
        GOOD + ",extra",
        GOOD.rsplit(",", 1)[0],
        GOOD.replace("2024-01-02", "02/01/2024"),
        GOOD.replace("09:05:06", "late"),
        GOOD.replace(",3,", ",three,"),
        GOOD.replace("4.05", "4,05"),
    ],
)
def test_csv_bad_record_fails_the_load(spark, tmp_path, line):
    path = _file(tmp_path / "in", "a.csv", f"{HEADER}\n{GOOD}\n{line}\n")
    with pytest.raises(Exception):
        read_csv_pos(spark, path).collect()


def test_csv_column_count_is_checked_for_narrow_queries(spark, tmp_path):
    path = _file(tmp_path / "in", "a.csv", f"{HEADER}\n{GOOD},extra\n")
    with pytest.raises(Exception):
        read_csv_pos(spark, path).select("store_id").collect()


def test_csv_numbers_round_half_away_from_zero(spark, tmp_path):
    line = GOOD.replace(",3,", ",2.5,").replace("4.05", "4.055").replace(",10,", ",-2.5,")
    df = read_csv_pos(spark, _file(tmp_path / "in", "a.csv", f"{HEADER}\n{line}\n"))
    assert rows(df, "quantity", "discount_pct", "total_amount") == [(3, -3, Decimal("4.06"))]


def test_csv_timestamp_format(spark):
    text = spark.createDataFrame([("2024-01-02 03:04:05",), ("N/A",)], "at string")
    typed = typed_columns(text, StructType().add("at", TimestampNTZType()), CsvFormat())
    assert rows(typed) == [(dt.datetime(2024, 1, 2, 3, 4, 5),), (None,)]
    bad = spark.createDataFrame([("02.01.2024",)], "at string")
    with pytest.raises(Exception):
        typed_columns(bad, typed.schema, CsvFormat()).collect()


def test_csv_money_type_without_cents(spark, tmp_path):
    path = _file(tmp_path / "in", "a.csv", f"{HEADER}\n{GOOD}\n")
    df = read_csv_pos(spark, path, DecimalType(38, 0))
    assert rows(df, "unit_price", "total_amount") == [(Decimal(2), Decimal(4))]


def test_csv_quotes_are_text_unless_declared(spark, tmp_path):
    line = GOOD.replace("Milk", '"Milk"')
    path = _file(tmp_path / "in", "a.csv", f"{HEADER}\n{line}\n")
    assert rows(read_csv_pos(spark, path), "product_name") == [('"Milk"',)]
    enclosed = CsvFormat(quote='"')
    assert rows(read_csv_pos(spark, path, fmt=enclosed), "product_name") == [("Milk",)]


# --- Parquet --------------------------------------------------------------------


def test_parquet_matches_names_in_any_case(spark, tmp_path):
    path = str(tmp_path / "erp")
    spark.sql(
        "select 'O1' as ORDER_ID, cast(5 as int) as Quantity_Ordered, true as IS_LATE, 'x' as extra"
    ).write.parquet(path)
    df = read_parquet_erp(spark, path)
    assert df.columns[:2] == ["order_id", "order_date"] and len(df.columns) == 19
    assert rows(df, "order_id", "quantity_ordered", "is_late", "order_date") == [
        ("O1", 5, True, None)
    ]


@pytest.mark.parametrize("text", [f"[{EVENT}] garbage", f"[{EVENT}]\n[{EVENT}]", f"{EVENT}\n{EVENT}"])
def test_json_after_the_first_document_fails(spark, tmp_path, text):
    path = _file(tmp_path / "in", "a.json", text)
    with pytest.raises(Exception, match="MALFORMED"):
        read_event_payloads(spark, path).collect()


def test_json_lines_with_several_elements(spark, tmp_path):
    path = _file(tmp_path / "in", "a.json", f"[{EVENT}, {EVENT},\n{EVENT}]\n{EVENT}\n")
    assert read_event_payloads(spark, path, JsonFormat(layout="lines")).count() == 4
