"""Reading pages, writing tables, and the cursor of incremental loads."""

from stockflow.sources.envelope import latest_cursor, normalise_phones, to_envelope, updated_since
from stockflow.sources.pages import cap_pages, page_items, read_page_files, read_pages
from stockflow.sources.state import CursorTable
from stockflow.sources.tables import LoadResult, TableStore

__all__ = [
    "CursorTable",
    "LoadResult",
    "TableStore",
    "cap_pages",
    "latest_cursor",
    "normalise_phones",
    "page_items",
    "read_page_files",
    "read_pages",
    "to_envelope",
    "updated_since",
]
