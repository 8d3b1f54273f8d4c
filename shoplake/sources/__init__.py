"""Readers of the three feeds, for batches and for streams."""

from shoplake.sources.formats import CsvFormat, JsonFormat, ParquetFormat
from shoplake.sources.iot_json import read_event_payloads, read_json_events
from shoplake.sources.pos_csv import read_csv_pos
from shoplake.sources.erp_parquet import read_parquet_erp

__all__ = [
    "CsvFormat",
    "JsonFormat",
    "ParquetFormat",
    "read_csv_pos",
    "read_event_payloads",
    "read_json_events",
    "read_parquet_erp",
]
