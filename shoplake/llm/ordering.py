"""Places of rows in an order, without gathering a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.storage import materialize


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Whether the rows agree in ``keys``; null agrees with null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys], F.lit(True))


def meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` by ``keys``, where null agrees with null; left's keys stay."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def numbered(rows: DataFrame, group: list[str], order: list[str], place: str, size: str) -> DataFrame:
    """``rows`` with their ``place`` in the group, from 0, and the group's ``size``.

    Rows ascend by ``order``, nulls first and texts by their bytes; ``order`` must tell
    the rows of a group apart. Rows are range-partitioned by group and order, so a large
    group covers many tasks; what is added up in sequence is one count per group and
    task. The result reads files.
    """
    keys = [*group, *order]
    at = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", at)
    dealt = materialize(ranged, "ordered").withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        dealt.groupBy(*group, "_part")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
        .withColumn(size, F.sum("_n").over(Window.partitionBy(*group)))
        .drop("_n", "_first")
    )
    met = meet(dealt, runs, [*group, "_part"])
    return met.withColumn(place, F.col("_base") + F.col("_at")).drop("_base", "_at", "_part")
