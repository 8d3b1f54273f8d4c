"""Sharding: groups of equal texts go to the least-loaded shard, largest first."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import running
from shoplake.storage import materialize

#: Bytes that every document counts beside its text.
OVERHEAD = 16

#: A group is scheduled by itself from this part of a shard's share; smaller ones in bundles.
LARGE = 1000

#: Bundles of small groups for each shard.
BUNDLES = 256


def least_loaded(weights: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Longest processing time first: the shard of each item (weight, name)."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for weight, name in sorted(weights, key=lambda item: (-item[0], item[1])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + weight, shard))
    return placed


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, shard, slot.

    A document's size is its UTF-8 bytes plus 16. Equal texts stay together; a null
    text equals an empty one and has crc32 0. Shards get near equal bytes, as far as
    a group larger than a shard allows. Slots are gapless from 0 in each shard.
    Repeated rows get a slot each; an empty table gives an empty result; other
    columns are not read.

    The heap must see items in sequence, so it sees at most 1256 a shard: groups of
    at least a thousandth of a shard's share (there can't be more than 1000 a shard)
    and bundles, by digest, of all smaller ones. Both maps are broadcast, which
    their number bounds; rows are never joined by a hot digest.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    ).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "sizes")
    spark = docs.sparkSession
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("weight")), "text-groups")
    total = groups.agg(F.sum("weight")).first()[0] or 0
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * BUNDLES)).cast("string")
    is_large = F.col("weight") * (shards * LARGE) >= F.lit(total)
    large = groups.where(is_large).select("weight", F.hex("digest").alias("item"))
    small = groups.where(~is_large).groupBy(bundle.alias("item")).agg(F.sum("weight").alias("weight"))
    items = large.select("weight", F.concat(F.lit("g"), "item").alias("item")).unionByName(
        small.select("weight", F.concat(F.lit("b"), "item").alias("item"))
    )
    placed = least_loaded([(int(w), name) for w, name in items.collect()], shards)
    maps = {
        kind: spark.createDataFrame([(k[1:], v) for k, v in placed.items() if k[0] == kind], f"{kind}_item string, {kind}_shard int")
        for kind in "gb"
    }
    named = rows.withColumn("g_item", F.hex("digest")).withColumn("b_item", bundle)
    found = named.join(F.broadcast(maps["g"]), "g_item", "left").join(F.broadcast(maps["b"]), "b_item", "left")
    dealt = found.select("row", "doc_id", "size", "text_crc32", F.coalesce("g_shard", "b_shard").alias("shard"))
    return running(materialize(dealt, "shards"), ["shard"], ["doc_id", "row"], F.lit(1), "slot").drop("row")
