"""DataFrame operators the plans are composed of."""

from shoplake.operators.changes import (
    ACTION,
    IS_UPDATE,
    append_feed,
    change_feed,
    insert_absent,
    merge,
)
from shoplake.operators.dedupe import first_per_key
from shoplake.operators.lookup import BROADCAST_BYTES, fits_broadcast, heavy_keys, lookup, lookups
from shoplake.operators.surrogate import assign_surrogate_key

__all__ = [
    "ACTION",
    "BROADCAST_BYTES",
    "IS_UPDATE",
    "append_feed",
    "assign_surrogate_key",
    "change_feed",
    "first_per_key",
    "fits_broadcast",
    "heavy_keys",
    "insert_absent",
    "lookup",
    "lookups",
    "merge",
]
