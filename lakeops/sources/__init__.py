"""Sources and sinks: files, JDBC, the table catalog, and the test bindings."""

from lakeops.sources.bronze import Lake, publish_table, publish_view, row_counts, write_bronze
from lakeops.sources.files import read_csv_typed, read_json_array
from lakeops.sources.jdbc import read_jdbc

__all__ = [
    "Lake",
    "publish_table",
    "publish_view",
    "row_counts",
    "write_bronze",
    "read_csv_typed",
    "read_json_array",
    "read_jdbc",
]
