from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplake.operators import (
    ACTION,
    IS_UPDATE,
    append_feed,
    assign_surrogate_key,
    change_feed,
    first_per_key,
    fits_broadcast,
    heavy_keys,
    insert_absent,
    lookup,
    merge,
)
from tests.conftest import rows

# --- first_per_key --------------------------------------------------------------


def test_first_per_key_orders_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "x", 2), ("b", None, 3), (None, "y", 4), ("a", "x", None)],
        "k string, name string, extra int",
    )
    assert rows(first_per_key(df, ["k"], ["name"])) == [("a", "x", 2), ("b", None, 3), (None, "y", 4)]


def test_first_per_key_is_one_whole_row(spark):
    df = spark.createDataFrame(
        [("s", "same", None, "floor"), ("s", "same", "city", None)],
        "k string, name string, city string, floor string",
    )
    assert rows(first_per_key(df, ["k"], ["name", "city"])) == [("s", "same", "city", None)]


def test_first_per_key_aggregates_before_every_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as v")
    plan = first_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


# --- surrogate keys ---------------------------------------------------------------


def test_dense_keys_follow_the_order(spark):
    df = spark.range(5000).selectExpr("concat('k', 9999 - id) as k", "id as v").repartition(16)
    keyed = assign_surrogate_key(df, "key", ["k"])
    assert keyed.columns == ["key", "k", "v"]
    got = [r.k for r in keyed.orderBy("key").collect()]
    assert got == sorted(got)
    assert rows(keyed.agg(F.min("key"), F.max("key"), F.count_distinct("key"))) == [(1, 5000, 5000)]


def test_dense_keys_put_nulls_last_and_handle_copies(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",), ("b",)], "k string")
    keyed = assign_surrogate_key(df, "key", ["k"], start=10)
    assert rows(keyed) == [(10, "a"), (11, "b"), (12, "b"), (13, None)]


def test_dense_keys_spread_a_hot_group_of_copies(spark):
    df = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k")
    keyed = assign_surrogate_key(df, "key", ["k"])
    assert rows(keyed.agg(F.count_distinct("key"), F.max("key"))) == [(40_000, 40_000)]


def test_dense_keys_of_an_empty_table(spark):
    assert assign_surrogate_key(spark.range(0), "key", ["id"]).count() == 0


def test_keys_without_order_are_unique_and_free(spark):
    df = assign_surrogate_key(spark.range(0, 1000, 1, 7), "key")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df.agg(F.min("key"), F.count_distinct("key"))) == [(1, 1000)]


# --- lookup -----------------------------------------------------------------------

LIMITS = [1 << 20, 0]


def _sides(spark):
    left = spark.range(0, 3000, 1, 6).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id as string) end as k",
        "id",
    )
    right = spark.range(1500).selectExpr("cast(id as string) as k", "id as v").union(
        spark.sql("select 'hot', 7").union(spark.sql("select cast(null as string), 8"))
    )
    return left, right


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_equals_a_plain_join(spark, limit, how):
    left, right = _sides(spark)
    got = lookup(left, right, ["k"], how, broadcast_limit=limit)
    plain = left.join(right, "k", how).select("k", "id", "v")
    assert got.columns == ["k", "id", "v"]
    assert rows(got) == rows(plain)


def test_lookup_refuses_keys_of_two_types(spark):
    with pytest.raises(ValueError, match="one type"):
        lookup(spark.range(3), spark.createDataFrame([(1, 2)], "id int, v int"), ["id"])


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_of_copies_with_one_heavy_key(spark, how):
    left = spark.range(0, 6000, 1, 6).selectExpr("if(id % 3 = 0, 7L, id) as k", "'same' as w")
    right = spark.range(0, 6000, 2).selectExpr("id as k", "-id as v").where("k <> 7").union(
        spark.sql("select 7L, cast(null as bigint)")
    )
    got = lookup(left, right, ["k"], how, broadcast_limit=0)
    assert rows(got) == rows(left.join(right, "k", how).select("k", "w", "v"))


def test_lookup_by_two_keys(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, None, 2), (None, "a", 3), (2, "b", 4)], "x int, y string, n int")
    right = spark.createDataFrame([(1, "a", "hit"), (2, "c", "no"), (1, None, "never")], "x int, y string, v string")
    for limit in LIMITS:
        got = lookup(left, right, ["x", "y"], broadcast_limit=limit)
        assert rows(got, "n", "v") == [(1, "hit"), (2, None), (3, None), (4, None)]


def test_lookup_shuffle_spreads_heavy_and_unknown_keys(spark):
    left, right = _sides(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup(left.repartition(16, "id"), right, ["k"], broadcast_limit=0, fits=False)
        sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 3000
    # The hot and the unknown key hold 1000 rows each.
    assert max(sizes) < 900 and len(sizes) == 8


def test_lookup_of_two_hundred_heavy_keys(spark):
    """Each of them holds several fair shares of the 2,000 partitions; three quarters of all rows are theirs."""
    key = "if(id % 4 < 3, id % 200 * 4 + id % 4 + 1000000, id)"
    left = spark.range(0, 400_000, 1, 16).selectExpr(f"{key} as k", "id")
    keys = left.groupBy("k").count()
    assert keys.where("count > 1000").count() >= 150
    right = left.select("k").distinct().where("k % 3 > 0").selectExpr("k", "-k as v")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        got = lookup(left, right, ["k"], broadcast_limit=0, fits=False)
        wrong = F.count_if(~F.col("v").eqNullSafe(F.when(F.col("k") % 3 > 0, -F.col("k"))))
        sizes = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), wrong.alias("wrong"), F.sum("id").alias("ids")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert sum(r.n for r in sizes) == 400_000 and sum(r.ids for r in sizes) == 400_000 * 399_999 // 2
    assert sum(r.wrong for r in sizes) == 0
    assert max(r.n for r in sizes) <= 2 * 400_000 / 2_000


def test_heavy_keys_of_several_columns_in_one_pass(spark):
    df = spark.range(20_000).selectExpr("if(id % 2 = 0, 5, id) as a", "if(id % 3 = 0, null, cast(id % 3 as string)) as b", "id as c")
    a, b, c = heavy_keys(df, [["a"], ["b"], ["c"]])
    digest = lambda sql: spark.sql(f"select xxhash64({sql})").first()[0]
    assert set(a) == {digest("5L")} and set(b) == {digest("'1'"), digest("'2'")} and c == {}
    assert heavy_keys(df.where("false"), [["a"]]) == [{}]


def test_lookup_shuffles_by_route_and_key(spark):
    left, right = _sides(spark)
    got = lookup(left, right, ["k"], broadcast_limit=0, fits=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(shuffles) == 2 and all("_route" in line for line in shuffles)


def test_fits_broadcast_measures_text(spark):
    df = spark.range(100).selectExpr("repeat('x', 1000) as t")
    assert fits_broadcast(df, 200_000)
    assert not fits_broadcast(df, 50_000)
    assert fits_broadcast(df.where("false"), 1)


# --- change feed and merge -----------------------------------------------------------

STATE = "k string, v int, w string"


def _changes(spark, *changes):
    return spark.createDataFrame(list(changes), f"{STATE}, {ACTION} string, {IS_UPDATE} boolean")


def test_change_feed_pairs(spark):
    old = spark.createDataFrame([("gone", 1, "a"), ("same", 2, None), ("new v", 3, "c")], STATE)
    new = spark.createDataFrame([("same", 2, None), ("new v", None, "c"), ("born", 5, "e")], STATE)
    feed = change_feed(old, new, ["k"])
    assert feed.columns == ["k", "v", "w", ACTION, IS_UPDATE]
    assert rows(feed) == [
        ("born", 5, "e", "INSERT", False),
        ("gone", 1, "a", "DELETE", False),
        ("new v", 3, "c", "DELETE", True),
        ("new v", None, "c", "INSERT", True),
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_merge_branches(spark, limit):
    target = spark.createDataFrame([(k, 0, "t") for k in ("i", "iu", "d", "du", "rest")], STATE)
    changes = _changes(
        spark,
        # matched
        ("i", 1, "s", "INSERT", False),
        ("iu", 1, None, "INSERT", True),
        ("d", 1, "s", "DELETE", False),
        ("du", 1, "s", "DELETE", True),
        # not matched
        ("xi", 1, "s", "INSERT", False),
        ("xiu", 1, "s", "INSERT", True),
        ("xd", 1, "s", "DELETE", False),
        ("xdu", 1, "s", "DELETE", True),
    )
    assert rows(merge(target, changes, ["k"], limit)) == [
        ("du", 0, "t"),
        ("i", 0, "t"),
        ("iu", 1, None),
        ("rest", 0, "t"),
        ("xi", 1, "s"),
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_merge_null_and_repeated_keys(spark, limit):
    target = spark.createDataFrame([(None, 0, "t"), ("a", 0, "t"), ("a", 1, "t")], STATE)
    changes = _changes(
        spark,
        (None, 1, "s", "INSERT", False),
        (None, 2, "s", "DELETE", False),
        ("a", 9, "s", "INSERT", True),
        ("b", 1, "s", "INSERT", False),
        ("b", 2, "s", "INSERT", False),
        ("a", 3, "s", "INSERT", False),
        ("a", 4, "s", "INSERT", False),
    )
    assert rows(merge(target, changes, ["k"], limit)) == [
        ("a", 9, "s"),
        ("a", 9, "s"),
        ("b", 1, "s"),
        ("b", 2, "s"),
        (None, 0, "t"),
        (None, 1, "s"),
    ]


@pytest.mark.parametrize(
    "second", [("a", 2, "s", "INSERT", True), ("a", 2, "s", "DELETE", False)]
)
def test_merge_refuses_two_changes_of_one_row(spark, second):
    target = spark.createDataFrame([("a", 0, "t")], STATE)
    changes = _changes(spark, ("a", 1, "s", "INSERT", True), second)
    with pytest.raises(Exception, match="several changes"):
        merge(target, changes, ["k"]).collect()
    # Without a matching row nothing is ambiguous.
    assert rows(merge(target.where("false"), changes, ["k"])) == []


@pytest.mark.parametrize("limit", LIMITS)
def test_merge_again_changes_nothing(spark, limit):
    target = spark.createDataFrame([("a", 0, "t")], STATE)
    feed = append_feed(spark.createDataFrame([("a", 1, "s"), ("b", 1, "s")], STATE))
    once = merge(target, feed, ["k"], limit)
    assert rows(once) == [("a", 0, "t"), ("b", 1, "s")]
    assert rows(merge(once, feed, ["k"], limit)) == rows(once)


def test_merge_with_a_hot_key(spark):
    target = spark.range(0, 3000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as k", "cast(id as int) as v", "'t' as w"
    )
    changes = _changes(spark, ("hot", -1, "s", "INSERT", True), ("1", 0, "", "DELETE", False))
    merged = merge(target, changes, ["k"], broadcast_limit=0)
    assert merged.count() == 2999
    assert merged.where("k = 'hot' and v = -1 and w = 's'").count() == 1000


def test_insert_absent_reads_only_the_keys_of_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 0, "t")], STATE).write.parquet(path)
    new = spark.createDataFrame([("a", 1, "s"), ("b", 1, "s")], STATE)
    plan = insert_absent(spark.read.parquet(path), new, ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string>" in text
    assert "GreaterThanOrEqual(k,a), LessThanOrEqual(k,b)" in text
    assert rows(plan) == [("b", 1, "s")]


def test_insert_absent_without_wanted_keys(spark):
    target = spark.createDataFrame([("a", 0, "t")], STATE)
    assert rows(insert_absent(target, target.where("false"), ["k"])) == []
    unknown = spark.createDataFrame([(None, 1, "s"), (None, 1, "s")], STATE)
    assert rows(insert_absent(target, unknown, ["k"])) == [(None, 1, "s")] * 2


_states = st.dictionaries(
    st.sampled_from("abcdef"),
    st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from("xy"))),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=_states, new=_states)
def test_feed_applied_to_old_gives_new(spark, old, new):
    before = spark.createDataFrame([(k, *v) for k, v in old.items()], STATE)
    after = spark.createDataFrame([(k, *v) for k, v in new.items()], STATE)
    merged = merge(before, change_feed(before, after, ["k"]), ["k"])
    assert rows(merged) == rows(after)


# --- change feed of multisets ----------------------------------------------------------


def _plain_feed(old, new, key):
    """Counts of (row, action, is_update) by the definition; which rows pair up is free."""
    gone, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
    totals = {}
    for k in {key(r) for r in [*gone, *came]}:
        d = sum(n for r, n in gone.items() if key(r) == k)
        i = sum(n for r, n in came.items() if key(r) == k)
        totals[k] = (d, i, min(d, i) if k is not None else 0)
    return gone, came, totals


@pytest.mark.parametrize("seed", range(4))
def test_change_feed_of_repeated_and_null_keys(spark, seed):
    rng = random.Random(seed)

    def table():
        return [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice("xy")) for _ in range(rng.randrange(60))]

    old, new = table(), table()
    feed = change_feed(spark.createDataFrame(old, STATE), spark.createDataFrame(new, STATE), ["k"]).collect()
    gone, came, totals = _plain_feed(old, new, lambda r: r[0])
    assert Counter(tuple(r)[:3] for r in feed if r[ACTION] == "DELETE") == gone
    assert Counter(tuple(r)[:3] for r in feed if r[ACTION] == "INSERT") == came
    for k, (_, _, pairs) in totals.items():
        for action in ("DELETE", "INSERT"):
            assert sum(r.k == k and r[ACTION] == action and r[IS_UPDATE] for r in feed) == pairs


def test_change_feed_of_a_table_and_itself_is_empty(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), (None, 1, "x"), (None, 1, "x")], STATE)
    assert change_feed(df, df, ["k"]).count() == 0


def test_change_feed_of_payloads_and_maps(spark):
    def state(rows_):
        return spark.createDataFrame(rows_, "k int, j string, m map<string,int>, a array<struct<x:int>>").select(
            "k", F.parse_json("j").alias("p"), "m", "a", F.struct(F.parse_json("j").alias("q"), F.lit(1).alias("one")).alias("s")
        )

    old = state([
        (1, '{"a": 1, "b": [1, 2]}', {"x": 1, "y": 2}, [(1,)]),
        (2, '{"a": 1}', {"x": 1}, None),
        (3, None, None, []),
        (4, '"t"', {}, [(None,)]),
    ])
    new = state([
        (1, '{"b": [1, 2], "a": 1}', {"y": 2, "x": 1}, [(1,)]),
        (2, '{"a": 2}', {"x": 1}, None),
        (3, None, None, []),
        (4, '"t"', {"z": 1}, [(None,)]),
        (5, "null", None, None),
    ])
    feed = change_feed(old, new, ["k"])
    assert feed.columns == [*old.columns, ACTION, IS_UPDATE] and feed.schema["p"].dataType == old.schema["p"].dataType
    got = rows(feed.select("k", F.to_json("p"), F.to_json("s.q"), F.map_entries("m"), ACTION, IS_UPDATE))
    pair = lambda n: [r[4:] for r in got if r[0] == n]
    assert sorted(pair(2)) == sorted(pair(4)) == [("DELETE", True), ("INSERT", True)]
    assert pair(5) == [("INSERT", False)] and len(got) == 5
    assert {r[1] for r in got if r[0] == 2} == {r[2] for r in got if r[0] == 2} == {'{"a":1}', '{"a":2}'}


def test_change_feed_of_many_copies_and_a_hot_key(spark):
    old = spark.range(9_000).selectExpr("'hot' as k", "cast(id as int) as v", "'x' as w")
    new = spark.range(10_000).selectExpr("'hot' as k", "cast(id + 5000 as int) as v", "'x' as w")
    copies = spark.range(9_001).selectExpr("cast(null as string) as k", "1 as v", "'copy' as w")
    feed = change_feed(old.unionByName(copies), new, ["k"])
    got = rows(feed.groupBy("w", ACTION, IS_UPDATE).count())
    assert got == [
        ("copy", "DELETE", False, 9_001),
        ("x", "DELETE", True, 5_000),
        ("x", "INSERT", False, 1_000),
        ("x", "INSERT", True, 5_000),
    ]
