"""Join a large table to one with a single row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import add, and_
from typing import Literal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

# A side is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 128 << 20

# A key is heavy from this part of one partition's fair share. Lighter keys that meet in a
# partition hardly double it; there are at most so many heavy keys for each partition.
_SHARE = 16

# Rows of a heavy key are dealt to so many routes for each fair share that they hold.
_ROUTES = 64

# Counters of the sketch for each key it may report; the sketch takes a million at most.
_COUNTERS, _MOST_COUNTERS = 4, 1_000_000


def all_set(keys: Sequence[str]) -> Column:
    """Whether no key column is NULL."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def byte_size(df: DataFrame) -> Column:
    """Aggregate: bytes that the rows of ``df`` need, by row count and the lengths of texts and nested values."""
    texts = [F.col(f.name) for f in df.schema if isinstance(f.dataType, StringType | BinaryType)]
    # Nested values count by their text; the struct takes in a value of any kind.
    texts += [F.to_json(F.struct(f.name)) for f in df.schema if isinstance(f.dataType, ArrayType | MapType | StructType | VariantType)]
    fixed = F.lit(16 * len(df.columns)).cast("bigint")
    width = reduce(add, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], fixed)
    return F.coalesce(F.sum(width), F.lit(0).cast("bigint"))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against ``limit`` bytes."""
    return limit > 0 and df.agg(byte_size(df).alias("bytes")).first().bytes <= limit


def heavy_keys(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> list[dict[int, int]]:
    """For each set of key columns the digests of its heavy keys, and how many routes each needs.

    One pass over ``df`` for all sets. The sketches of the tasks are merged; they are
    wrong by less than a part of the least heavy key, and only choose routes: a key
    that is missed, or reported in vain, changes no result.
    """
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    counters = min(_COUNTERS * _SHARE * partitions, _MOST_COUNTERS)
    wanted = min(_SHARE * partitions, counters)
    aggregates = []
    for i, keys in enumerate(key_sets):
        known = F.when(all_set(keys), F.xxhash64(*keys)).alias(f"_d{i}")
        df = df.withColumn(f"_d{i}", known)
        aggregates += [F.expr(f"approx_top_k(_d{i}, {wanted}, {counters})").alias(f"top{i}"), F.count(f"_d{i}").alias(f"rows{i}")]
    found = df.agg(*aggregates).first()
    out = []
    for i in range(len(key_sets)):
        share = found[f"rows{i}"] / partitions
        top = {t.item: t["count"] for t in found[f"top{i}"] or [] if t.item is not None}
        out.append({d: ceil(_ROUTES * n / share) for d, n in top.items() if n * _SHARE > share})
    return out


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: Literal["left", "inner"] = "left",
    broadcast_limit: int = BROADCAST_BYTES,
    fits: bool | None = None,
    heavy_from: DataFrame | None = None,
    heavy: dict[int, int] | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key; NULL keys never match.

    A right side within ``broadcast_limit`` bytes is broadcast and ``left`` is
    not shuffled. Otherwise both sides shuffle by key, with a route as an extra join
    key: a digest of the key. Left rows of a heavy key are dealt to many routes, by a
    digest of their content and map partition, and the key's right row is copied to each.
    Left rows with a NULL key take a route of their own content, as they meet nothing.
    A route does not depend on the order of rows, so a task that is run again
    sends each row where it went before. The number of copies is bounded by the number of
    partitions; what is broadcast then is two numbers for each heavy key.
    ``fits`` skips the measurement when the caller has done it, ``heavy`` the search
    for heavy keys. ``heavy_from`` names a cheaper table with the same keys to look for them
    in, such as the stored table that ``left`` is derived from.
    """
    keys = list(keys)
    values = [c for c in right.columns if c not in keys]
    columns = [*left.columns, *values]
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            # Equal values of two types would have two digests.
            raise ValueError(f"both sides need one type for {k}")
    if how == "inner":
        left = left.where(all_set(keys))
    if fits is None:
        fits = fits_broadcast(right, broadcast_limit)
    if fits:
        return left.join(F.broadcast(right), keys, how).select(*columns)

    if heavy is None:
        heavy = heavy_keys(left if heavy_from is None else heavy_from, [keys])[0]
    content = [f.name for f in left.schema if not isinstance(f.dataType, VariantType | MapType)]
    scattered = F.xxhash64(F.spark_partition_id(), *content)
    digest = F.xxhash64(*keys)
    cold = right.where(all_set(keys))
    if heavy:
        listed = pa.table({"_digest": pa.array(heavy, pa.int64()), "_routes": pa.array(heavy.values(), pa.int32())})
        routes = left.sparkSession.createDataFrame(listed)
        left = left.withColumn("_digest", digest).join(F.broadcast(routes), "_digest", "left")
        salted = F.xxhash64("_digest", F.pmod(scattered, F.col("_routes")).cast("int"))
        route = F.when(F.col("_routes").isNotNull(), salted).otherwise(F.col("_digest"))
        routed = left.withColumn("_route", F.when(all_set(keys), route).otherwise(scattered))
        copies = F.sequence(F.lit(0), F.coalesce("_routes", F.lit(1)) - 1)
        cold = cold.withColumn("_digest", digest).join(F.broadcast(routes), "_digest", "left").withColumn("_copy", F.explode(copies))
        to = F.when(F.col("_routes").isNotNull(), F.xxhash64("_digest", "_copy")).otherwise(F.col("_digest"))
        cold = cold.withColumn("_route", to).select("_route", *keys, *values)
    else:
        routed = left.withColumn("_route", F.when(all_set(keys), digest).otherwise(scattered))
        cold = cold.withColumn("_route", digest)
    # The hint keeps an underestimate from broadcasting what was measured as too large.
    # The route comes first: both sides then sort by a number, not by texts.
    return routed.join(cold.hint("merge"), ["_route", *keys], how).select(*columns)


def lookups(
    left: DataFrame,
    dims: Sequence[tuple[DataFrame, str]],
    broadcast_limit: int = BROADCAST_BYTES,
    heavy_from: DataFrame | None = None,
) -> DataFrame:
    """LEFT ``lookup`` of several dimensions, each with its key column.

    Dimensions that are too large to broadcast share one search for heavy keys.
    """
    fits = [fits_broadcast(dim, broadcast_limit) for dim, _ in dims]
    large = [key for (_, key), small in zip(dims, fits) if not small]
    heavy = dict(zip(large, heavy_keys(left if heavy_from is None else heavy_from, [[k] for k in large]))) if large else {}
    for (dim, key), small in zip(dims, fits):
        left = lookup(left, dim, [key], "left", broadcast_limit, fits=small, heavy=heavy.get(key))
    return left
