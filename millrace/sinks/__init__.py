from millrace.sinks.files import (
    adopt_run,
    all_runs,
    by_size,
    land_raw_csv,
    publish,
    run_path,
    write_csv,
    write_json,
    write_parquet,
    write_run_csv,
)
from millrace.sinks.jdbc import load_jdbc_table, replace_jdbc_table
from millrace.sinks.raw import broken_ranges, land_bytes, landed_bytes
from millrace.sinks.tables import load_table, replace_table

__all__ = [
    "adopt_run",
    "all_runs",
    "broken_ranges",
    "by_size",
    "land_bytes",
    "land_raw_csv",
    "landed_bytes",
    "load_jdbc_table",
    "load_table",
    "publish",
    "replace_jdbc_table",
    "replace_table",
    "run_path",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_run_csv",
]
