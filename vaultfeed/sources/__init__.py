"""Reading the warehouse, decoding stored lookups, and writing extracts."""

from vaultfeed.sources.lookups import json_lookup, json_number
from vaultfeed.sources.sinks import (
    append_audit,
    discard,
    publish,
    read_csv,
    scratch_path,
    write_csv,
    write_envelopes,
    write_json_lines,
)
from vaultfeed.sources.warehouse import TABLES, Warehouse, current_rows

__all__ = [
    "TABLES",
    "Warehouse",
    "append_audit",
    "current_rows",
    "discard",
    "json_lookup",
    "json_number",
    "publish",
    "read_csv",
    "scratch_path",
    "write_csv",
    "write_envelopes",
    "write_json_lines",
]
