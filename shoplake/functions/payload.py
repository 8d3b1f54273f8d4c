from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplake.functions.numbers import rounded_int


def payload_text(payload: Column, path: str) -> Column:
    """Text at ``path`` of a variant; a missing field and a JSON null give NULL."""
    return F.variant_get(payload, path, "string")


def payload_int(payload: Column, path: str) -> Column:
    """Whole number at ``path`` of a variant, halves away from zero."""
    return rounded_int(F.variant_get(payload, path, "decimal(38,9)"), "int")
