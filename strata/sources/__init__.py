"""Sources: CSV landing files, Parquet/catalog tables, SQL views, JDBC."""

from strata.sources.csv import (csv_headers, scan_csv, scan_csv_folder, scan_csv_inferred,
                                string_schema)
from strata.sources.jdbc import scan_jdbc, scan_jdbc_active, scan_jdbc_query
from strata.sources.tables import filter_active, scan_table, sql_view_scan

__all__ = [
    "csv_headers", "scan_csv", "scan_csv_folder", "scan_csv_inferred", "string_schema",
    "scan_jdbc", "scan_jdbc_active", "scan_jdbc_query", "filter_active", "scan_table",
    "sql_view_scan",
]
