"""Readers and writers: CSV by header name, Parquet staging, tables, pages."""

from .csv import (append_records, fill_defaults, file_headers,  # noqa: F401
                  read_csv_by_name, read_csv_inferred, snapshot_csv, write_csv)
from .files import (ensure_database, ensure_table, parquet_profile,  # noqa: F401
                    read_stage, replace_stage, save_table, with_computed_column,
                    write_parquet)
from .pages import read_pages  # noqa: F401
