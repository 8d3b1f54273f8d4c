"""What several operators share: words, batches, hot keys, running totals, labels."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.storage import materialize

#: Text that one step of a Python task holds at once, unless a single text is longer.
SLICE_BYTES = 8 << 20

#: A key is hot from one row in so many; there are at most so many hot keys.
HOT_SHARE = 1000


#: Bits of a screen, which is broadcast.
SCREEN_BITS = 1 << 25


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``limit`` bytes of ``column`` (or one row) and ``rows`` rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            stop = min(stop, start + (rows or len(ends)))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Give memory that is free in a Python worker back to the system: workers outlive tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have, in any case of letters."""
    return "_" * (1 + max(map(len, rows.columns), default=0)) + name


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and values of each text's words.

    A-Z are lower-cased; words are runs of characters other than U+0020 and
    U+0009-U+000D. A null text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    values, offsets = lists.flatten(), lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(values), 0)
    upto = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    return upto[offsets - offsets[0]], values.filter(real)


def attach(rows: DataFrame, classes: DataFrame, key: str, weight: str, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``classes`` (one row per ``key``).

    ``weight`` is the number of ``rows`` of the key. Keys with a thousandth of all
    rows, a thousand at most, are broadcast, so no task gets a hot key's rows; the
    others meet in a shuffle. ``rows`` is read several times: store it first.
    """
    total = rows.count()
    hot = F.col(weight) * HOT_SHARE >= F.lit(total)
    heavy, light = classes.where(hot), classes.where(~hot)
    met = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, how)
    return met.unionByName(rest)


def screened(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` (a long) may be in ``wanted`` (one column), and those whose key is surely not.

    A bitmap of hashes of the wanted keys, 4 MB however many there are, is broadcast.
    It only saves shuffling rows: an exact join must follow for the first part. A
    null key is surely not wanted.
    """
    slot = "pmod(xxhash64({0}), {1}L)".format
    bucket, bits = fresh(rows, "bucket"), fresh(rows, "bits")
    of_wanted = slot(f"`{wanted.columns[0]}`", SCREEN_BITS)
    maps = wanted.groupBy(F.expr(f"bitmap_bucket_number({of_wanted})").alias(bucket)).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({of_wanted}))").alias(bits)
    )
    at = slot(f"cast(`{key}` as bigint)", SCREEN_BITS)
    met = rows.join(F.broadcast(maps), F.expr(f"bitmap_bucket_number({at})") == F.col(bucket), "left")
    byte = f"cast(conv(hex(substring({bits}, cast(bitmap_bit_position({at}) div 8 + 1 as int), 1)), 16, 10) as int)"
    hit = F.expr(f"`{key}` is not null and {bits} is not null and (shiftright({byte}, cast(bitmap_bit_position({at}) % 8 as int)) & 1) = 1")
    return met.where(hit).select(*rows.columns), met.where(~hit).select(*rows.columns)


def running(rows: DataFrame, group: list[str], order: list[str], value: Column, name: str, per_chunk: int = 4_000) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the group's rows before this one.

    The order is by chunk (a hash of ``order``), then by ``order``, which must tell
    rows apart. Only one total per group and chunk is added up in sequence, so a
    group of any size is spread over tasks. ``rows`` is read twice: store it first.
    """
    chunks = max(1, -(-rows.count() // per_chunk))
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks))).withColumn("_value", value)
    keys = [*group, "_chunk"]
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy(*keys)
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .select("_base", *[F.col(k).alias(f"_of{k}") for k in keys])
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys])
    return (
        dealt.join(bases, same)
        .drop(*[f"_of{k}" for k in keys])
        .withColumn(name, (F.col("_base") + F.coalesce(F.sum("_value").over(within), F.lit(0))).cast("long"))
        .drop("_chunk", "_value", "_base")
    )


def labels(edges: DataFrame) -> DataFrame:
    """Smallest node reachable, for each node of ``edges`` (a long, b long): columns node, label.

    Each round hangs every node and its label under the least label next to it and
    then follows labels once more, so the way to the least node shrinks by half or
    more a round. Rounds are stored in the shared folder, which cuts lineage. Sums
    are partial before they are shuffled; a node with very many neighbours is left to
    Spark's adaptive splitting of skewed joins.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = materialize(both, "edges")
    state = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    state = materialize(state.select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        known = state.withColumnRenamed("node", "b")
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        met = state.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        # A label's own node must hear of smaller labels that its followers have met.
        told = met.select("node", "least").union(met.select(F.col("label").alias("node"), "least"))
        hung = materialize(told.groupBy("node").agg(F.min("least").alias("to")), "labels")
        tops = hung.select(F.col("node").alias("to"), F.col("to").alias("top"))
        jumped = hung.join(tops, "to", "left").select("node", F.coalesce("top", "to").alias("label"))
        new = materialize(jumped.join(state.withColumnRenamed("label", "old"), "node"), "labels")
        moved = new.where("label <> old").limit(1).count()
        state = new.drop("old")
        if not moved:
            return state
