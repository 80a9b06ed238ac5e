"""Extract, check, sync and query tabular data with Spark."""

from .operators.paging import number_rows, page, plan_chunks, row_cap
from .operators.upsert import upsert, upsert_outcomes
from .plans.copy import copy_query
from .plans.sync import copy_table, sync_query
from .sinks.parts import verify_parts, write_parts
from .sinks.tables import ManagedTables
from .sources.library import DataLibrary, open_data_library

__all__ = [
    "DataLibrary",
    "ManagedTables",
    "copy_query",
    "copy_table",
    "number_rows",
    "open_data_library",
    "page",
    "plan_chunks",
    "row_cap",
    "sync_query",
    "upsert",
    "upsert_outcomes",
    "verify_parts",
    "write_parts",
]
