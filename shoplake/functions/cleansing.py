from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Card methods (upper case) and their codes.
PAYMENT_CODES = {"CREDIT CARD": "CC", "DEBIT CARD": "DC"}


def floor_at_zero(value: Column, kind: DataType) -> Column:
    """``value`` if positive, otherwise (NULL too) zero."""
    return F.when(value > 0, value).otherwise(F.lit(0)).cast(kind)


def payment_code(method: Column) -> Column:
    """Short code of a card method in any letter case; every other method unchanged."""
    code = method
    for name, short in PAYMENT_CODES.items():
        code = F.when(F.upper(method) == name, F.lit(short)).otherwise(code)
    return code


def null_tokens(text: Column, tokens: Sequence[str]) -> Column:
    """NULL where the whole text is one of ``tokens``."""
    return F.when(~text.isin(*tokens), text)
