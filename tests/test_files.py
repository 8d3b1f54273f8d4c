from __future__ import annotations

import os

import pytest

from shoplake.plans import silver_pos
from shoplake.plans.lakehouse import Lakehouse
from shoplake.schemas import pos_silver
from shoplake.streaming import listed_table, load_files, merge_listed, read_merged
from shoplake.tables import VersionedTable
from tests.conftest import rows
from tests.test_streaming import csv, event, line, put


def load(spark, tmp_path, *names, **options):
    paths = [str(tmp_path / "in" / n) for n in names]
    load_files(spark, "pos", paths, str(tmp_path / "raw"), **options)
    return rows(listed_table(spark, "pos", str(tmp_path / "raw")).read(), "transaction_id")


def test_a_list_loads_each_file_once(spark, tmp_path):
    for name in "abc":
        csv(tmp_path / "in", f"{name}.csv", line(name), line("N/A"))
    assert load(spark, tmp_path, "a.csv", "b.csv") == [("a",), ("b",), (None,), (None,)]
    assert load(spark, tmp_path, "b.csv", "a.csv") == [("a",), ("b",), (None,), (None,)]
    # New files of a list are loaded beside known ones; a path given twice is one file.
    assert load(spark, tmp_path, "a.csv", "c.csv", "c.csv")[:3] == [("a",), ("b",), ("c",)]
    assert listed_table(spark, "pos", str(tmp_path / "raw")).versions() == [1, 2]


def test_a_file_that_was_written_anew_is_loaded_again(spark, tmp_path):
    csv(tmp_path / "in", "a.csv", line("1"))
    load(spark, tmp_path, "a.csv")
    csv(tmp_path / "in", "a.csv", line("1"), line("2"))
    assert load(spark, tmp_path, "a.csv") == [("1",), ("1",), ("2",)]
    os.utime(tmp_path / "in" / "a.csv", (1_000_000, 1_000_000))
    assert len(load(spark, tmp_path, "a.csv")) == 5
    assert len(load(spark, tmp_path, "a.csv")) == 5
    assert len(load(spark, tmp_path, "a.csv", force=True)) == 7


def test_a_load_that_dies_has_loaded_nothing(spark, tmp_path, monkeypatch):
    csv(tmp_path / "in", "a.csv", line("1"))
    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_commit", lambda self, version: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, tmp_path, "a.csv")
    csv(tmp_path / "in", "bad.csv", line("2").replace("2024-01-02", "never"))
    with pytest.raises(Exception, match="never|CANNOT_PARSE"):
        load(spark, tmp_path, "a.csv", "bad.csv")
    assert load(spark, tmp_path, "a.csv") == [("1",)]


def test_listed_files_reach_the_cleansed_table_once(spark, tmp_path):
    raw, silver = listed_table(spark, "pos", str(tmp_path / "raw")), str(tmp_path / "silver")
    assert merge_listed(raw, silver, silver_pos, ["transaction_id"]) is None
    wanted = []
    for name in "abc":
        csv(tmp_path / "in", f"{name}.csv", line(name), line("a"), line("N/A"))
        load(spark, tmp_path, f"{name}.csv")
        wanted += [(name,), *([("a",)] if name == "a" else []), (None,)]
        if name != "b":
            for _ in range(2):
                merge_listed(raw, silver, silver_pos, ["transaction_id"])
                stored = rows(read_merged(spark, silver, pos_silver()), "transaction_id")
                assert sorted(map(str, stored)) == sorted(map(str, wanted))


def test_lakehouse_loads_folders_and_lists(spark, tmp_path):
    csv(tmp_path / "pos", "a.csv", line("1"))
    csv(tmp_path / "more", "b.csv", line("2"), line("N/A"))
    put(tmp_path / "iot", "a.json", f"[{event('E1', 'a', 'b')}]")
    spark.sql("select 'O1' as order_id").write.parquet(str(tmp_path / "erp"))
    lake = Lakehouse(spark, str(tmp_path / "lake"), buckets=2)
    lake.load("erp", str(tmp_path / "erp"))
    lake.load("pos", str(tmp_path / "pos"))
    for _ in range(2):
        assert lake.load("pos", [str(tmp_path / "more" / "b.csv")]).count() == 3
        # Sensor events by list only.
        assert lake.load("iot", [str(tmp_path / "iot" / "a.json")]).count() == 1
    sold = [("1",), ("2",), (None,)]
    assert rows(lake.build_silver()["stg_csv_transaction"], "transaction_id") == sold
    csv(tmp_path / "more", "c.csv", line("2", "9.99"), line("3"))
    lake.load("pos", [str(tmp_path / "more" / n) for n in ("b.csv", "c.csv")])
    silver = lake.update_silver()
    assert rows(silver["stg_csv_transaction"], "transaction_id") == [("1",), ("2",), ("3",), (None,)]
    assert rows(silver["stg_json_sensor"], "sensor") == [("a",), ("b",)]
