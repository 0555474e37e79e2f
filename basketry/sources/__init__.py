from .load import Loaded, load_extracts, load_raw
from .raw import RAW_COLUMNS, RawTables, from_star, raw_extracts, read_raw, source
from .tables import as_view, footer_bounds, read_table, write_table

__all__ = [
    "Loaded",
    "RAW_COLUMNS",
    "RawTables",
    "as_view",
    "footer_bounds",
    "from_star",
    "load_extracts",
    "load_raw",
    "raw_extracts",
    "read_raw",
    "read_table",
    "source",
    "write_table",
]
