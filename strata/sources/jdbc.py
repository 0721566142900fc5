"""Metadata and tables from a JDBC database.

Large tables are read in parallel by a numeric, date or timestamp column
(``partition_column`` + bounds + ``num_partitions``); filters and column
selections on the result are pushed into the database by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetchsize: int = 10_000) -> DataFrame:
    """A whole table (``dbtable``)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need bounds and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", num_partitions))
    return reader.load()


def scan_jdbc_query(spark: SparkSession, url: str, query: str,
                    properties: dict | None = None) -> DataFrame:
    """The result of a query run by the database (``query`` option)."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def scan_jdbc_active(spark: SparkSession, url: str, table: str,
                     properties: dict | None = None, flag: str = "IS_RUN") -> DataFrame:
    """Active configuration rows: the ``flag = 1`` filter reaches the database
    as a pushed filter instead of hand-written query text."""
    return scan_jdbc(spark, url, table, properties).filter(F.col(flag) == 1)
