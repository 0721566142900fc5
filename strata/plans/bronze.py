"""Landing CSV -> bronze: read as text, normalise headers, stamp, fit, append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.functions.headers import normalize_headers
from strata.operators.conform import conform_to_schema, with_audit
from strata.operators.load import write_table
from strata.sources.csv import scan_csv_folder


def conform_bronze(raw: DataFrame, target_schema: StructType, run_id: str, run_ts=None,
                   headers_normalized: bool = False) -> DataFrame:
    """One landing batch to the bronze schema: headers normalised,
    ``ADDED_BY``/``ADDED_ON`` stamped, columns matched case-insensitively,
    cast to the target types, in target order; extra columns dropped; a target
    column the files lack raises. Narrow only: no shuffle."""
    df = raw if headers_normalized else normalize_headers(raw)
    df = with_audit(df, run_id, run_ts, columns=("ADDED_BY", "ADDED_ON"))
    return conform_to_schema(df, target_schema)


def bronze_load(spark: SparkSession, folder: str, target_schema: StructType, run_id: str,
                run_ts=None, glob: str = "*.csv") -> DataFrame:
    """Every CSV file of the folder in one read per header variant (not one
    job per file), conformed to bronze."""
    raw = scan_csv_folder(spark, folder, glob, normalize=True)
    return conform_bronze(raw, target_schema, run_id, run_ts, headers_normalized=True)


def bronze_append(spark: SparkSession, folder: str, table_path: str, target_schema: StructType,
                  run_id: str, run_ts=None, glob: str = "*.csv") -> int:
    """Append a folder's files to a bronze Parquet table; returns rows written."""
    batch = bronze_load(spark, folder, target_schema, run_id, run_ts, glob)
    return write_table(batch, table_path, mode="append")
