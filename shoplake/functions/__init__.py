"""Column expressions shared by the plans."""

from shoplake.functions.calendar import calendar_columns, date_key
from shoplake.functions.cleansing import floor_at_zero, null_tokens, payment_code
from shoplake.functions.numbers import margin_pct, ratio, rounded_int
from shoplake.functions.payload import payload_int, payload_text
from shoplake.functions.audit import run_time

__all__ = [
    "calendar_columns",
    "date_key",
    "floor_at_zero",
    "margin_pct",
    "null_tokens",
    "payload_int",
    "payload_text",
    "payment_code",
    "ratio",
    "rounded_int",
    "run_time",
]
