"""Sources and sinks."""

from prefspark.sources.csv_records import read_csv
from prefspark.sources.files import path_exists
from prefspark.sources.readers import read_prompt_lines, read_prompts, read_sessions, table_row_id
from prefspark.sources.writers import (
    metrics_frame,
    read_responses,
    write_metrics,
    write_prepared,
    write_responses,
    write_sessions,
)

__all__ = [
    "metrics_frame",
    "path_exists",
    "read_csv",
    "read_prompt_lines",
    "read_prompts",
    "read_responses",
    "read_sessions",
    "table_row_id",
    "write_metrics",
    "write_prepared",
    "write_responses",
    "write_sessions",
]
