"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order`` ascending, NULLs last; ties fall to the other columns.

    Both steps aggregate before they shuffle: copies collapse first, then each
    task sends at most one candidate per key, so a key that holds a large share
    of the rows never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [*order, *rest]
    rank = F.struct(
        *[
            part
            for i, name in enumerate(ranked)
            for part in (F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}"))
        ]
    )
    best = df.distinct().groupBy(*keys).agg(F.min(rank).alias("_best"))
    values = {name: F.col(f"_best.v{i}") for i, name in enumerate(ranked)}
    return best.select(*[values.get(c, F.col(c)).alias(c) for c in df.columns])
