"""Catalog tables, Parquet folders and SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a folder of ``fmt`` files by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def sql_view_scan(spark: SparkSession, df: DataFrame, view: str, query: str,
                  args: dict | None = None) -> DataFrame:
    """Register ``df`` as a temp view and run parameterised SQL on it; values
    travel as named parameters (``:name``), never pasted into the text."""
    df.createOrReplaceTempView(view)
    return spark.sql(query, args=args or {})


def filter_active(df: DataFrame, flag: str = "IS_RUN") -> DataFrame:
    """Rows whose run flag is 1; pushed into the scan by Catalyst."""
    from pyspark.sql import functions as F
    return df.filter(F.col(flag) == 1)
