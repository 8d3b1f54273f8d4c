from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shoplake import tables
from shoplake.operators import ACTION, IS_UPDATE, merge
from shoplake.plans import silver_pos
from shoplake.schemas import pos_bronze, pos_silver
from shoplake.streaming import backfill, merge_stream, read_merged
from shoplake.tables import SOURCE, VersionedTable, replace_table
from tests.conftest import rows
from tests.test_streaming import csv, ingest, line

SCHEMA = "k string, n int, v string"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ("k",), 4)


def frame(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def changes(spark, values):
    return spark.createDataFrame(values, f"{SCHEMA}, {ACTION} string, {IS_UPDATE} boolean")


def test_an_unwritten_table_is_empty(table):
    assert table.versions() == [] and table.read().count() == 0 and table.version().number == 0


def test_readers_keep_their_version(spark, table):
    table.replace(frame(spark, [("a", 1, "x"), (None, 2, "y")]))
    before = table.read()
    table.replace(frame(spark, [("b", 3, "z")]))
    table.insert_absent(frame(spark, [("b", 4, "no"), ("c", 5, "yes"), (None, 6, "yes")]))
    assert rows(before) == [("a", 1, "x"), (None, 2, "y")] == rows(table.read(1))
    assert rows(table.read(2)) == [("b", 3, "z")]
    assert rows(table.read()) == [("b", 3, "z"), ("c", 5, "yes"), (None, 6, "yes")]
    assert table.versions() == [1, 2, 3]
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)


def test_a_write_that_dies_before_its_version_changes_nothing(spark, table, monkeypatch):
    table.replace(frame(spark, [("a", 1, "x")]))

    def dies(self, version):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_commit", dies)
        with pytest.raises(RuntimeError):
            table.replace(frame(spark, [("b", 2, "y")]))
        with pytest.raises(RuntimeError):
            table.insert_absent(frame(spark, [("c", 3, "z")]))
    assert rows(table.read()) == [("a", 1, "x")] and table.versions() == [1]
    table.insert_absent(frame(spark, [("c", 3, "z")]))
    table.expire(keep=1)
    assert rows(table.read()) == [("a", 1, "x"), ("c", 3, "z")]
    # What the lost writes left is gone; what the version uses is not.
    assert table._commits("rows") == {s.commit for s in table.version().segments}


def test_half_a_version_file_does_not_block_the_next_writer(spark, table, tmp_path):
    table.replace(frame(spark, [("a", 1, "x")]))
    (tmp_path / "t" / "versions" / "version=2" / "_temporary").mkdir(parents=True)
    assert rows(table.read()) == [("a", 1, "x")]
    table.replace(frame(spark, [("b", 2, "y")]))
    assert rows(table.read()) == [("b", 2, "y")] and table.versions() == [1, 2]


def test_two_writers_of_one_version_do_not_both_succeed(spark, table):
    table.replace(frame(spark, [("a", 1, "x")]))
    seen = table.version()
    table.insert_absent(frame(spark, [("b", 1, "x")]))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        table.insert_absent(frame(spark, [("c", 1, "x")]), since=seen)
    assert rows(table.read(), "k") == [("a",), ("b",)]


def test_merge_equals_the_operator(spark, table):
    rng = random.Random(4)
    old = [(f"k{i}", i, "old") for i in range(60)] + [(None, i, "old") for i in range(5)]
    table.replace(frame(spark, old))
    state = frame(spark, old)
    for step in range(3):
        made = []
        for k in rng.sample(range(90), 30):
            kind = rng.randrange(4)
            if kind == 0:
                made += [(f"k{k}", -1, "before", "DELETE", True), (f"k{k}", 100 + step, "new", "INSERT", True)]
            elif kind == 1:
                made += [(f"k{k}", None, None, "DELETE", False)] * rng.randrange(1, 4)
            elif kind == 2:
                made += [(f"k{k}", 200 + step, "added", "INSERT", False)] * rng.randrange(1, 3)
        made += [(None, step, "added", "INSERT", False), (None, step, "gone", "DELETE", False)]
        batch = changes(spark, made)
        want = rows(merge(state, batch, ["k"]))
        table.merge(batch)
        assert rows(table.read()) == want
        state = frame(spark, want)


def test_merge_writes_only_touched_buckets_anew(spark, table):
    table.replace(frame(spark, [(f"k{i}", i, "x") for i in range(400)]))
    before = {(s.bucket, s.commit) for s in table.version().segments}
    table.merge(changes(spark, [("k7", 0, "", "DELETE", False), ("fresh", 1, "y", "INSERT", False)]))
    last = table.version()
    kept = {(s.bucket, s.commit) for s in last.segments} & before
    assert len(before) == 4 and len(kept) == 3
    assert table.read().count() == 400 and rows(table.read().where("k in ('k7', 'fresh')"), "k") == [("fresh",)]


def test_merge_of_two_updates_of_a_row_commits_nothing(spark, table):
    table.replace(frame(spark, [("a", 1, "x")]))
    with pytest.raises(Exception, match="several changes"):
        table.merge(changes(spark, [("a", 2, "y", "INSERT", True), ("a", 3, "z", "INSERT", True)]))
    assert rows(table.read()) == [("a", 1, "x")] and table.versions() == [1]


def test_only_segments_that_can_hold_a_key_are_read(spark, table):
    table.replace(frame(spark, [(f"a{i:04}", i, "x") for i in range(2_000)]))
    for wave in "bcd":
        table.insert_absent(frame(spark, [(f"{wave}{i:04}", i, "x") for i in range(40)]))
    last = table.version()
    assert len(last.segments) == 16

    def read(*keys):
        return table.candidates(last, frame(spark, [(k, 0, "") for k in keys]))[0]

    # By bucket and range one segment for each wave's key; a key beyond all ranges needs none.
    assert len(read("c0007")) == 1 and read("c0007")[0].least[0].startswith("c")
    assert read("zzz") == [] and read("") == []
    # Within the range of the first, large segments the key filter decides.
    assert [s.n > 400 for s in read("a0007")] == [True]
    assert sum(len(read(f"a{i:04}x")) for i in range(60)) <= 3
    assert all(len(read(f"a{i:04}")) == 1 for i in range(0, 2_000, 97))
    # The plan scans the chosen folders and no others.
    files = table._read(read("c0007")).inputFiles()
    assert files and len({f.rsplit("/", 1)[0] for f in files}) == 1


def test_numbers_and_several_columns_as_keys(spark, tmp_path):
    schema = "a long, b date, c string, d int"
    t = VersionedTable(spark, str(tmp_path / "n"), spark.createDataFrame([], schema).schema, ("a", "b", "c"), 3)
    first = spark.sql("select id as a, date'2024-01-01' as b, cast(id as string) as c, 1 as d from range(-50, 50)")
    t.replace(first)
    t.insert_absent(spark.sql("select id as a, date'2024-01-01' as b, cast(id as string) as c, 2 as d from range(40, 60)"))
    t.insert_absent(spark.sql("select 7L as a, date'2024-01-02' as b, '7' as c, 3 as d union all select 7, null, '7', 4"))
    assert rows(t.read().groupBy("d").count()) == [(1, 100), (2, 10), (3, 1), (4, 1)]


def test_compaction_keeps_rows_and_bounds_segments(spark, table):
    want = []
    for wave in range(9):
        batch = [(f"k{wave}-{i}", i, "x") for i in range(30)] + [(None, wave, "y")]
        table.insert_absent(frame(spark, batch), spark.createDataFrame([(f"f{wave}",)], f"{SOURCE} string"), "s", wave)
        want += batch
        if table.version().most_segments() > 3:
            table.compact(3)
        assert table.version().most_segments() <= 4
    last = table.compact()
    assert last.most_segments() == 1 and len(last.sources) == 1 and last.offsets == {"s": 8}
    assert rows(table.read()) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    assert all(s.slots for s in last.segments)
    # Keys are still known, and so are the names of the raw files.
    table.insert_absent(frame(spark, [("k3-3", 9, "again"), ("k9", 9, "new")]))
    assert table.read().count() == len(want) + 1
    known = spark.createDataFrame([("f0",), ("f8",), ("f9",)], f"{SOURCE} string")
    assert rows(table.unknown_sources(table.version(), known, "other")) == [("f9",)]
    assert table.compact().number == table.version().number


def test_small_segments_are_joined_before_large_ones(spark, table):
    table.replace(frame(spark, [(f"a{i}", i, "x") for i in range(4_000)]))
    large = {s for s in table.version().segments}
    for wave in range(3):
        table.insert_absent(frame(spark, [(f"b{wave}-{i}", i, "x") for i in range(40)]))
    last = table.compact(2)
    assert large < set(last.segments) and last.most_segments() == 2


def test_a_batch_is_committed_once(spark, table):
    batch = frame(spark, [(None, 1, "x"), ("a", 2, "y")])
    table.insert_absent(batch, loader="s", batch=0)
    table.insert_absent(batch, loader="s", batch=0)
    assert table.read().count() == 2 and table.versions() == [1]
    table.merge(changes(spark, [(None, 1, "x", "INSERT", False)]), loader="s", batch=1)
    table.merge(changes(spark, [(None, 1, "x", "INSERT", False)]), loader="s", batch=1)
    assert table.read().count() == 3 and table.version().offsets == {"s": 1}


def test_partitioned_table_is_replaced(spark, tmp_path):
    df = spark.sql("select cast(id % 3 as int) as date_key, id as a, cast(id as string) as b from range(30)")
    stored = replace_table(df, str(tmp_path / "p"), "date_key")
    again = replace_table(df.where("a < 5"), str(tmp_path / "p"), "date_key")
    assert stored.columns == df.columns and rows(stored) == rows(df) and again.count() == 5
    assert len(stored.where("date_key = 1").select("a").inputFiles()) > 0
    assert "PartitionFilters: [isnotnull(date_key" in stored.where("date_key = 1")._jdf.queryExecution().toString()


def test_no_row_is_doubled_when_a_batch_dies_between_its_files_and_its_version(spark, tmp_path, monkeypatch):
    """The rows and the names of their raw files are written, then the driver is lost, then the checkpoint too."""
    csv(tmp_path / "src", "a.csv", line("1"), line("N/A"))
    ingest(spark, "pos", tmp_path)

    def follow(checkpoint):
        merge_stream(
            spark, str(tmp_path / "raw"), pos_bronze(), str(tmp_path / "silver"), silver_pos,
            ["transaction_id"], str(tmp_path / checkpoint),
        ).awaitTermination()

    def dies(self, version):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_commit", dies)
        with pytest.raises(Exception, match="lost driver"):
            follow("one")
    for checkpoint in ("one", "two", "two"):
        follow(checkpoint)
        stored = read_merged(spark, str(tmp_path / "silver"), pos_silver())
        assert rows(stored, "transaction_id") == [("1",), (None,)]


def test_streams_compact_their_table(spark, tmp_path):
    for i in range(7):
        csv(tmp_path / "src", f"{i}.csv", line(f"t{i}"), line("N/A"))
        ingest(spark, "pos", tmp_path)
    backfill(
        spark.read.schema(pos_bronze()).parquet(str(tmp_path / "raw")).where(F.lit(False)),
        str(tmp_path / "silver"), silver_pos, ["transaction_id"], buckets=2,
    )

    def follow(checkpoint):
        merge_stream(
            spark, str(tmp_path / "raw"), pos_bronze(), str(tmp_path / "silver"), silver_pos, ["transaction_id"],
            str(tmp_path / checkpoint), files_per_batch=1, max_segments=2,
        ).awaitTermination()

    follow("one")
    table = VersionedTable(spark, str(tmp_path / "silver"), pos_silver(), ("transaction_id",))
    last = table.version()
    assert last.buckets == 2 and last.most_segments() <= 3 and len(last.sources) <= 4
    follow("two")
    assert table.read().count() == 14
    assert tables.MAX_SEGMENTS >= 2
