"""Surrogate keys without a global window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from shoplake.storage import materialize

# monotonically_increasing_id keeps the row's place in its partition in 33 bits.
_ROW_BITS = (1 << 33) - 1

#: Rows that one task sorts when keys are dense.
ROWS_PER_RANGE = 250_000

# Equal rows of a task are told apart in runs of 2 ** 10, so that they can go to several ranges.
_RUN_BITS = 10


def assign_surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[str] | None = None,
    start: int = 1,
    ranges: int | None = None,
) -> DataFrame:
    """Add a unique BIGINT column ``name`` as the first column.

    Without ``order_by`` the keys are unique but have gaps, and cost neither a
    shuffle nor a pass. Write the result before shuffling it: a re-run task may
    number its rows differently.

    With ``order_by`` the keys are dense from ``start`` in that order (NULLs
    last, ties by the remaining columns). ``df`` is evaluated once, into storage.
    Borders of ranges are drawn from a sample of what is stored; rows are
    range-partitioned, sorted and written with their place in the partition; each
    partition then needs only the number of rows before it, one number per
    partition. ``ranges`` fixes how many there are; by default the number of rows
    decides, as copies compress so well that their bytes say nothing.
    """
    if not order_by:
        key = F.monotonically_increasing_id() + F.lit(start)
        return df.select(key.alias(name), "*")

    ties = [
        f.name
        for f in df.schema
        if f.name not in order_by and not isinstance(f.dataType, MapType | VariantType)
    ]
    # Equal rows are told apart by where they come from, so a large group of copies
    # spreads over several ranges.
    order = [*[F.col(c).asc_nulls_last() for c in [*order_by, *ties]], F.col("_origin").asc()]
    # The number of a row within its task, in runs, tells the copies of one task apart.
    origin = F.shiftright(F.monotonically_increasing_id(), _RUN_BITS)
    held = materialize(df.withColumn("_origin", origin), f"unkeyed-{name}")
    if ranges is None:
        ranges = max(1, -(-held.count() // ROWS_PER_RANGE))
    placed = (
        held.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .drop("_origin")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    stored = materialize(placed, f"keys-{name}")
    sizes = sorted(stored.groupBy("_part").agg((F.max("_row") + 1).alias("rows")).collect())
    firsts = accumulate((size.rows for size in sizes), initial=start)
    before = df.sparkSession.createDataFrame(
        pa.table(
            {
                "_part": pa.array([size._part for size in sizes], pa.int32()),
                "_first": pa.array([first for _, first in zip(sizes, firsts)], pa.int64()),
            }
        )
    )
    numbered = stored.join(F.broadcast(before), "_part")
    return numbered.select((F.col("_first") + F.col("_row")).alias(name), *df.columns)
