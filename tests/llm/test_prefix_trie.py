"""The conversation trie against sets of plain prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoplake.llm import prefix_trie
from shoplake.llm.queries import QUERIES, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, rep int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(convs):
    """``convs``: id to list of (role, text)."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    for p, m in members.items():
        ids = ",".join(str(c) for c in sorted(ends[p])) if p in ends else ""
        parent = min(members[p[:-1]]) if p else None
        yield min(m), len(p), parent, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        lent = sorted(own[base])[:h] if base in own else []
        out[c] = [t[2:] for t in lent + sorted(own[c])[h:]]
    return out


def key(row):
    return [(v is not None, v) for v in row]


def check(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    result = QUERIES["op12_conversation_trie"](spark, str(tmp_path))
    assert result.columns == COLUMNS and {f.dataType.simpleString() for f in result.schema.fields[:-1]} == {"bigint"}
    want = plain_nodes(plain_rebuilt([r[:4] for r in rows]))
    assert sorted((tuple(r) for r in result.collect()), key=key) == sorted(want, key=key)


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, 1, "user", "never"),
        (0, None, None, None),
        (0, None, "user", "a b"),
        (0, 1, "user", ""),
        (0, 1, "user", ""),
        (0, 2, "user", "x " * 60_000),
        (1, 5, "user", "a b"),
        (2, 1, "user", "a\u000b b c"),
        (3, 1, "ab", "c"),
        (4, 1, "a", "bc"),
        (27, 0, "user", "only turn, and base absent"),
        (-5, 1, "user", "below zero"),
        (41, 1, "", "日本 語"),
    ]
    check(spark, tmp_path, [(*r, 1, "z", 2) for r in rows])


def test_copies_chains_and_few_words(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for c in range(400):
        long_ = 40 if c % 50 == 7 else 8
        shape = [("u", "go")] * (c % 13) if c % 3 == 0 else [("u", rng.choice(["x", "y y"])) for _ in range(rng.randrange(long_) + 1)]
        rows += [(c, i, role, text, 0, "", 0) for i, (role, text) in enumerate(shape)]
    check(spark, tmp_path, rows)


def test_sample_table(spark, tmp_path, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    check(spark, tmp_path, [(r.conv_id, r.turn, r.role, r.text, 0, "", 0) for r in rows])


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op12_conversation_trie"](spark, str(tmp_path)).count() == 0


@pytest.fixture(scope="module")
def trie(spark):
    rng = random.Random(1)
    convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randrange(12))] for c in range(300)}
    turns = [(c, i + 1, *t) for c, ts in convs.items() for i, t in enumerate(ts)]
    parts = prefix_trie.compacted(
        spark.createDataFrame(turns, "conv_id long, pos long, role string, text string"),
        spark.createDataFrame([(c,) for c in convs], "conv_id long"),
    )
    return convs, *parts


def test_compacted_nodes_branch_or_end(trie):
    convs, nodes, paths, _, _ = trie
    text = {c: "".join(t for _, t in ts) for c, ts in convs.items()}
    every = {t[:d] for t in text.values() for d in range(len(t) + 1)}
    want = {p for p in every if p and (p in set(text.values()) or {p + "a", p + "b"} <= every)}
    got = nodes.collect()
    assert sorted(text[r.rep][: r.hi] for r in got) == sorted(want)
    for r in got:
        above = text[r.rep][: r.lo]
        assert not above or above in want
        assert not any(text[r.rep][:d] in want for d in range(r.lo + 1, r.hi))
        numbers = range(r.lo + 1, r.hi + 1)
        assert r.hd == max(numbers, key=lambda x: x & -x)


def test_fat_binary_search_finds_the_deepest_node(spark, trie):
    convs, nodes, paths, _, _ = trie
    text = {c: "".join(t for _, t in ts) for c, ts in convs.items()}
    depths = {text[r.rep][: r.hi] for r in nodes.collect()}
    # A part of the trie's nodes, closed upwards.
    closed, kept = [], {""}
    for r in sorted(nodes.collect(), key=lambda r: r.hi):
        word = text[r.rep]
        if word[: r.lo] in kept and (r.hi % 2 == 0 or r.lo == 0):
            closed.append(r)
            kept.add(word[: r.hi])
    part = spark.createDataFrame(closed, nodes.schema)
    assert 0 < len(kept) < len(depths)
    ends = paths.where("depth = n").select("conv", "n")
    for r in prefix_trie.exits(part, paths, ends).collect():
        word = text[r.conv]
        above = [d for d in range(len(word) + 1) if d == 0 or word[:d] in kept]
        chain = max(above)
        assert r.l == chain


def test_long_conversations_and_large_groups_are_taken_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    convs = {c: [("u", "w" * (1 + (i * c) % 3)) for i in range(30)] for c in range(3)} | {c: [("u", "same")] for c in range(10, 40)}
    turns = [(c, i + 1, *t) for c, ts in convs.items() for i, t in enumerate(ts)]
    got = prefix_trie.trie_nodes(
        spark.createDataFrame(turns, "conv_id long, pos long, role string, text string"),
        spark.createDataFrame([(c,) for c in convs], "conv_id long"),
    )
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain_nodes(convs), key=key)


def test_rebuilt_turns(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns, members = rebuilt(table)
    got = defaultdict(list)
    for r in turns.orderBy("conv_id", "pos").collect():
        got[r.conv_id].append((r.role, r.text))
        assert r.pos == len(got[r.conv_id])
    want = plain_rebuilt([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])
    assert {r.conv_id for r in members.collect()} == set(want)
    assert {c: t for c, t in want.items() if t} == dict(got)
    assert turns.where(F.col("pos") < 1).count() == 0
