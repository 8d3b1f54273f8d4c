"""The Merkle manifest against a plain recomputation."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoplake.llm import manifest
from shoplake.llm.ordering import numbered
from shoplake.llm.queries import QUERIES
from shoplake.storage import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest int, at long, n int, what string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[c] for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def way(tree, i):
    for level in tree[:-1]:
        yield i % 16, level[i - i % 16 : i - i % 16 + 16]
        i //= 16


def plain(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        groups[source].sort(key=lambda g: g[:3])
        trees[source] = levels([g[2] for g in groups[source]])
    top = levels([trees[s][-1][0] for s in sources])
    for k, source in enumerate(sources):
        for i, (known, _, digest, row) in enumerate(groups[source]):
            path = [*way(trees[source], i), *way(top, k)]
            beside = [d for at, run in path for j, d in enumerate(run) if j != at]
            seen = digest
            if known and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                seen = leaf(row, row["text"].translate(LOWER))
            for at, run in path:
                seen = sha(*[seen if j == at else d for j, d in enumerate(run)])
            yield row["doc_id"], digest, trees[source][-1][0], top[-1][0], sha(*beside), seen, seen == top[-1][0]


def key(row):
    return [(v is not None, v) for v in row]


def stored(spark, rows, folder, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.mark.parametrize("shape", ["odd", "one", "hot", "many sources"])
def test_proofs_equal_a_plain_tree(spark, tmp_path, shape):
    if shape == "odd":
        # Nulls everywhere, empty and long texts, repeated rows and ids, clashing names.
        rows = [
            (None, None, None, None, None, 1, 1, 1, "a"),
            (None, "A", "en", "", 1, 1, 1, 1, "a"),
            (-5, "Ä B", "en", None, 3, 1, 1, 1, None),
            *[(7, "A x", "de", "é", 3, i, 2, 2, "b") for i in range(40)],
            (7, None, "de", "é", 3, 1, 2, 2, "b"),
            (8, "", "de", "z", 0, 1, 2, 2, "b"),
            (10, "Q" * 300_000, "de", "z", 300_000, 1, 2, 2, "b"),
        ]
    elif shape == "one":
        rows = [(3, "A", "en", "s", 1, 0, 0, 0, "")]
    elif shape == "hot":
        rows = [(i, f"Text {i}", "en", "hot" if i % 7 else "cold", i, 0, 0, 0, "") for i in range(5_000)]
    else:
        rows = [(i, f"Text {i}", "en", f"s{i % 700}", i, 0, 0, 0, "") for i in range(1_400)]
    result = QUERIES["op13_merkle_manifest"](spark, stored(spark, rows, tmp_path))
    assert result.columns == COLUMNS
    named = [dict(zip(SCHEMA.replace(",", "").split()[::2], row)) for row in rows]
    assert sorted((tuple(r) for r in result.collect()), key=key) == sorted(plain(named), key=key)


def test_sample_table_and_other_steps_between_stored_levels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted(plain([r.asDict() for r in docs.collect()]), key=key)
    assert sorted((tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, sf_dir).collect()), key=key) == want
    for every in (1, 3):
        kept = manifest.manifest(docs, every=every)
        proofs = kept.proofs().select("what.doc_id", manifest.folded(F.col("digest"), F.col("path")).alias("up"), "root")
        rows = proofs.collect()
        assert len(rows) == len(want) and {r.up for r in rows} == {r.root for r in rows} == {want[0][3]}
        assert kept.root().first().digest == want[0][3]


def test_only_every_other_level_is_stored(spark):
    rows = [(i, "t", "en", "s", 1, 0, 0, 0, "") for i in range(1_000)]
    kept = manifest.manifest(spark.createDataFrame(rows, SCHEMA))
    # 1000 leaves make 63, 4 and 1 nodes: leaves and the four are stored, in blocks of up to 256.
    assert [sorted(len(r.nodes) for r in level.collect()) for level in kept.sources.levels] == [[232, 256, 256, 256], [4]]


def test_empty_table(spark, tmp_path):
    assert QUERIES["op13_merkle_manifest"](spark, stored(spark, [], tmp_path)).count() == 0


def test_places_do_not_gather_a_group(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("g"), (F.col("id") % 500).alias("o"), F.col("id").alias("row"))
    placed = numbered(materialize(rows, "test"), ["g"], ["o", "row"], "at", "size")
    got = placed.orderBy("at").select("at", "o", "row", "size").collect()
    assert [r.at for r in got] == list(range(20_000)) and {r["size"] for r in got} == {20_000}
    assert [(r.o, r.row) for r in got] == sorted((r.o, r.row) for r in got)
