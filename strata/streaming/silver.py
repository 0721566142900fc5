"""Silver from new bronze only: bronze as a stream of files, merged batch by batch.

The checkpoint remembers which bronze files were merged. A batch that fails after
its merge runs again, an ingest batch that was redone arrives as new files, and
deliveries come late: the table keeps the load time of every stored row
(``VERSION_COLUMN``), and the merge lets the newer version win, so each of these
leaves the table as it should be. No ids of merged batches need to be kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from strata.mapping import ColumnMapping
from strata.operators._commit import exists
from strata.operators.conform import conform_to_schema
from strata.operators.load import full_reload, write_table
from strata.operators.partitioned import recover_partitioned, upsert_partitioned
from strata.operators._util import resolve, split_keys
from strata.plans.silver import silver_batch
from strata.schemas import VERSION_COLUMN
from strata.streaming.ingest import BATCH_COLUMN, DEFAULT_MAX_FILES_PER_TRIGGER, MAX_FILE_AGE


def incremental_silver(spark: SparkSession, bronze_path: str, bronze_schema: StructType,
                       silver_path: str, silver_schema: StructType, checkpoint_path: str,
                       mapping: ColumnMapping, keys, partition_by, run_id: str, run_ts=None,
                       max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                       on_batch=None) -> dict:
    """Merge every bronze file not merged yet into the partitioned silver table.

    ``bronze_path`` is a table of :func:`incremental_ingest`, ``bronze_schema`` its
    columns without the batch id. ``silver_schema`` must have ``VERSION_COLUMN``
    (see :func:`strata.schemas.versioned`); the table is made by the first batch.
    A run reads the new bronze files and rewrites the partitions they touch,
    nothing else. ``on_batch(batch_id, partitions)`` is called after each merge; if
    it raises, the batch is not committed and the next run merges it again.
    Returns ``{"batches": n, "partitions": rewritten}`` for this run.
    """
    columns = silver_schema.fieldNames()
    if VERSION_COLUMN not in columns:
        raise ValueError(f"the silver schema needs {VERSION_COLUMN}: batches may come twice or late")
    stats = {"batches": 0, "partitions": 0}
    if not exists(spark, bronze_path):
        return stats
    reader = (spark.readStream.schema(StructType([*bronze_schema.fields,
                                                  StructField(BATCH_COLUMN, LongType())]))
              .option("maxFileAge", MAX_FILE_AGE)
              # a redone ingest batch replaces its files; the new ones come in a later batch
              .option("ignoreMissingFiles", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = silver_batch(batch.drop(BATCH_COLUMN), mapping, keys, columns)
        if exists(spark, silver_path):
            n = upsert_partitioned(spark, silver_path, rows, keys, partition_by, run_id, run_ts,
                                   schema=silver_schema, newest_by=VERSION_COLUMN)
        else:
            first = conform_to_schema(full_reload(rows, run_id, run_ts), silver_schema,
                                      missing="null")
            homes = resolve(first, split_keys(partition_by))
            write_table(first, silver_path, partition_by=homes)
            n = spark.read.schema(silver_schema).parquet(silver_path).select(homes).distinct().count()
        stats["batches"] += 1
        stats["partitions"] += n
        if on_batch is not None:
            on_batch(int(batch_id), n)

    query = (reader.parquet(bronze_path).writeStream.foreachBatch(merge)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return stats


def read_silver(spark: SparkSession, silver_path: str, silver_schema: StructType) -> DataFrame:
    """The silver table, after finishing a merge that a failed run left half done."""
    recover_partitioned(spark, silver_path)
    return spark.read.schema(silver_schema).parquet(silver_path).select(silver_schema.fieldNames())
