from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

_WIDE = DecimalType(38, 9)


def rounded_int(text: Column, kind: DataType) -> Column:
    """Text to a whole number, halves away from zero; text that is no number fails."""
    return F.round(text.cast(_WIDE), 0).cast(kind)


def ratio(total: Column, count: Column) -> Column:
    """``total / count``, NULL for a zero count."""
    return total / F.nullif(count, F.lit(0))


def margin_pct(margin: Column, revenue: Column) -> Column:
    """Margin in percent of revenue; 0 for zero revenue, NULL for unknown revenue."""
    return F.when(revenue == 0, F.lit(0)).otherwise(
        margin / F.nullif(revenue, F.lit(0).cast("decimal(1,0)")) * 100
    )
