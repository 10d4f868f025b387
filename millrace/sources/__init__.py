from millrace.sources.files import (
    csv_headers,
    read_csv,
    read_csv_by_name,
    read_event_files,
    read_finished_runs,
    read_in_batches,
    read_json,
    read_parquet,
    read_published,
    read_runs,
)
from millrace.sources.memory import from_lines, from_rows
from millrace.sources.object_store import object_store_conf
from millrace.sources.tables import (
    JdbcDatabase,
    equal_bounds,
    even_predicates,
    range_predicates,
    read_jdbc,
    read_table,
)

__all__ = [
    "JdbcDatabase",
    "csv_headers",
    "equal_bounds",
    "even_predicates",
    "from_lines",
    "from_rows",
    "object_store_conf",
    "range_predicates",
    "read_csv",
    "read_csv_by_name",
    "read_event_files",
    "read_finished_runs",
    "read_in_batches",
    "read_jdbc",
    "read_json",
    "read_parquet",
    "read_published",
    "read_runs",
    "read_table",
]
