"""strata: layered tables (bronze, silver, gold) as plain Spark DataFrame jobs.

The most used functions are re-exported here; each lives in a subpackage:
``functions`` (column rules), ``sources`` (scans), ``operators`` (row-set
operators), ``plans`` (layer jobs) and ``streaming`` (load-once ingest).
"""

from strata.functions import (cast_by_type_name, normalize_headers, parse_date_ladder,
                              parse_zoned_timestamp, try_cast_by_type)
from strata.mapping import ColumnMapping
from strata.operators import (add_column_at, append, cast_by_mapping, conform_to_schema,
                              dedupe_any, dedupe_latest, fill_nulls, full_reload,
                              left_join_fanout, left_join_unique, project_to_target,
                              rename_by_mapping, select_alias, stable_keys, surrogate_key,
                              upsert, upsert_actions, upsert_counts, with_audit, write_table)
from strata.plans import (active_objects, bronze_load, dim_appointment, fact_sales, silver_job,
                          silver_load)
from strata.sources import scan_csv, scan_csv_folder, scan_jdbc, scan_table
from strata.streaming import incremental_ingest, read_ingested

__version__ = "0.1.0"

__all__ = [
    "ColumnMapping", "active_objects", "add_column_at", "append", "bronze_load",
    "cast_by_mapping", "cast_by_type_name", "conform_to_schema", "dedupe_any", "dedupe_latest",
    "dim_appointment", "fact_sales", "fill_nulls", "full_reload", "incremental_ingest",
    "left_join_fanout", "left_join_unique", "normalize_headers", "parse_date_ladder",
    "parse_zoned_timestamp", "project_to_target", "read_ingested", "rename_by_mapping",
    "scan_csv", "scan_csv_folder", "scan_jdbc", "scan_table", "select_alias", "silver_job",
    "silver_load", "stable_keys", "surrogate_key", "try_cast_by_type", "upsert",
    "upsert_actions", "upsert_counts", "with_audit", "write_table",
]
