"""Exact deduplication: binary-fuse filters of stored snapshots screen new digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.llm.common import attach, fresh, screened, slices
from shoplake.storage import materialize

#: Keys of one filter, on average; a filter takes about nine bits a key.
KEYS_PER_FILTER = 1 << 17

_FILTER = "bucket int, seed long, segment long, segments long, prints binary"


def folded(text: str | None) -> bytes:
    """The bytes that are compared: UTF-8 with A-Z in lower case; null is empty."""
    return (text or "").encode().lower()


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the folded text) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [hashlib.sha256(folded(t)).digest() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "digest"])

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, digest binary")


# --- the filter ---------------------------------------------------------------


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots of each hash, in neighbouring segments of the table."""
    span = np.uint64(segment * segments)
    # The upper half picks the first slot, so it is even over segments*segment.
    first = ((h >> np.uint64(32)) * span) >> np.uint64(32)
    low = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * segment)) ^ (h & low)
    return np.stack([first, second, third], axis=1).astype(np.int64)


def _print(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, segments and fingerprints over distinct 64-bit keys.

    Every key is stored by peeling: a slot that only one key uses fixes that key,
    whose two other slots then lose a user. A seed for which some keys never peel
    is given up for the next one.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, -(-int(n * factor) // segment) - 2 + 1)
    for seed in range(1, 1000):
        h = _mixed(keys, seed * 0x9E3779B97F4A7C15)
        at = _places(h, segment, segments)
        size = segment * (segments + 2)
        users = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)  # xor of the users' numbers
        for j in range(3):
            np.bitwise_xor.at(owner, at[:, j], np.arange(n))
        free = np.flatnonzero(users == 1).tolist()
        users, owner, rows = users.tolist(), owner.tolist(), at.tolist()
        order: list[tuple[int, int]] = []
        while free:
            slot = free.pop()
            if users[slot] != 1:
                continue
            key = owner[slot]
            order.append((key, slot))
            for other in rows[key]:
                users[other] -= 1
                owner[other] ^= key
                if users[other] == 1:
                    free.append(other)
        if len(order) == n:
            table, want = [0] * size, _print(h).tolist()
            for key, slot in reversed(order):
                a, b, c = rows[key]
                table[slot] = want[key] ^ table[a] ^ table[b] ^ table[c] ^ table[slot]
            return seed, segment, segments, bytes(table)
    raise ValueError(f"no seed peels {n} keys")


def may_contain(keys: np.ndarray, seed: int, segment: int, segments: int, prints: bytes) -> np.ndarray:
    """True for every stored key, and for about one in 256 others."""
    table = np.frombuffer(prints, dtype=np.uint8)
    h = _mixed(keys.astype(np.uint64), seed * 0x9E3779B97F4A7C15)
    at = _places(h, segment, segments)
    return table[at[:, 0]] ^ table[at[:, 1]] ^ table[at[:, 2]] == _print(h)


def _keys(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(v[8:16] for v in values), dtype=">u8").astype(np.uint64)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One static filter for each bucket of a snapshot's distinct digests."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, prints = build_filter(_keys(rows["digest"]))
        return pd.DataFrame([(key[0], seed, segment, segments, prints)], columns=["bucket", "seed", "segment", "segments", "prints"])

    dealt = snapshot.select("digest", _bucket(buckets).alias("bucket"))
    return dealt.groupBy("bucket").applyInPandas(build, _FILTER)


def screen(batch: DataFrame, stored: DataFrame, buckets: int) -> DataFrame:
    """The distinct digests of ``batch`` that the snapshot's filters let pass."""

    def test(rows: pd.DataFrame, filter_rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[["digest"]]
        if rows.empty or filter_rows.empty:
            return rows.iloc[:0]
        f = filter_rows.iloc[0]
        return rows[may_contain(_keys(rows["digest"]), int(f.seed), int(f.segment), int(f.segments), f.prints)]

    dealt = batch.select("digest", _bucket(buckets).alias("bucket"))
    return dealt.groupBy("bucket").cogroup(stored.groupBy("bucket")).applyInPandas(test, "digest binary")


# --- the operator ---------------------------------------------------------------


def exact_dedup(docs: DataFrame, in_snapshot: Column) -> DataFrame:
    """Which rows of ``docs`` stay: doc_id, digest, keep_id, group_size, kept.

    Rows where ``in_snapshot`` (an expression over doc_id) holds are an immutable
    snapshot; the others arrive as a batch. Texts are equal when their bytes are,
    after lower-casing A-Z; null counts as empty. Of equal texts the largest doc_id
    stays, null ids being least; of repeated rows of that id, one. One row is
    returned per input row, other columns are not read, and an empty table gives
    an empty result.

    Digests are stored once. A snapshot is grouped when it is made, the batch on
    its own; a batch digest that the snapshot's filter lets pass then meets the
    snapshot's exact buckets. Wherever a digest has several rows their texts are
    compared byte by byte, and unequal texts under one SHA-256 raise an error.
    """
    known = F.coalesce(in_snapshot, F.lit(True))
    rows = digests(docs).withColumn("known", known).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "digests")
    grouped = rows.groupBy("known", "digest").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    grouped = materialize(grouped, "digest-groups")
    snapshot, batch = grouped.where("known").drop("known"), grouped.where("not known").drop("known")
    # As the batch may be far larger than the snapshot, or the reverse, the larger one decides.
    buckets = max(1, -(-max(snapshot.count(), batch.count()) // KEYS_PER_FILTER))
    stored = materialize(filters(snapshot, buckets), "fuse-filters")
    passed = screen(batch, stored, buckets)
    found = passed.join(snapshot, "digest").select("digest", F.col("keep").alias("old"), F.col("n").alias("old_n"))
    joined = batch.join(found, "digest", "left").select(
        "digest",
        F.greatest("keep", "old").alias("keep"),
        (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n"),
    )
    alone = snapshot.join(found.select("digest"), "digest", "left_anti").select("digest", "keep", "n")
    classes = materialize(joined.unionByName(alone), "digest-classes")
    _compare_bytes(docs, rows, classes)
    return attach(rows.drop("known"), classes, "digest", "n").select(
        "doc_id",
        "digest",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("keep.row") == F.col("row")).alias("kept"),
    )


def kept_documents(docs: DataFrame, in_snapshot: Column) -> DataFrame:
    """The rows of ``docs``, unchanged, that `exact_dedup` keeps: one of each class of equal texts."""
    name, own, wanted, nth = (fresh(docs, n) for n in ("digest", "id", "kept", "n"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashlib.sha256(folded(t.as_py())).digest() for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, name])

    kept = exact_dedup(docs, in_snapshot).where("kept").select(F.col("doc_id").alias(own), F.col("digest").alias(wanted))
    marked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())]))
    met = marked.join(kept, (F.col(name) == F.col(wanted)) & F.col("doc_id").cast("long").eqNullSafe(F.col(own)), "left_semi")
    # Repeated rows of the id that stays: one is enough.
    order = Window.partitionBy(name).orderBy(F.lit(0))
    return met.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*docs.columns)


def _compare_bytes(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> None:
    """Raise unless all texts of a digest with several rows are the same bytes.

    Rows without an id can't be looked up again; their digests count as they are.
    """
    several = attach(rows.drop("known"), classes.where("n > 1").select("digest", "n"), "digest", "n", "inner")
    wanted = several.select(F.col("doc_id").alias("id"), "digest").distinct()
    fold = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = materialize(wanted, "suspects")
    maybe, _ = screened(texts, "doc_id", wanted.where("id is not null").select("id"))
    # Rows of one id may hold several texts, so a text meets only its own digest.
    hashed = maybe.select("doc_id", fold.alias("folded")).withColumn("found", F.unhex(F.sha2("folded", 256)))
    met = hashed.join(wanted, (F.col("doc_id") == F.col("id")) & (F.col("found") == F.col("digest"))).select("digest", "folded")
    apart = met.groupBy("digest", "folded").agg(F.lit(1).alias("one")).groupBy("digest").agg(F.count("one").alias("texts"))
    if apart.where("texts > 1").limit(1).count():
        raise ValueError("different texts have the same SHA-256 digest")
