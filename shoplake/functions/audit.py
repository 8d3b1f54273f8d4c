from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_time(run_ts: datetime | None) -> Column:
    """Audit timestamp: the given one, or the time of the query."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
