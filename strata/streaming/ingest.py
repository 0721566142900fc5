"""Load-once ingestion of a landing folder with Structured Streaming.

The file source's checkpoint remembers which files were loaded, so a rerun
adds nothing; ``cleanSource=archive`` moves loaded CSV files to the archive
folder (lazily, once a later batch has committed); other files stay.

``foreachBatch`` is at-least-once: after a failure the last batch may run
again. Each batch therefore overwrites its own ``BATCH_ID`` partition, so a
retried batch replaces its first attempt instead of appending twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.plans.bronze import conform_bronze
from strata.sources.csv import header_groups, scan_csv_groups

BATCH_COLUMN = "BATCH_ID"
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


#: The file source forgets, and then never loads, files older than this. Landing
#: folders receive copies with old times, so no real file may be that old.
MAX_FILE_AGE = "36500d"
_LISTING = StructType([StructField("path", StringType()),
                       StructField("modificationTime", TimestampType()),
                       StructField("length", LongType()), StructField("content", BinaryType())])


def _folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path))


def incremental_ingest(spark: SparkSession, source_dir: str, table_path: str,
                       checkpoint_path: str, archive_dir: str, target_schema: StructType,
                       run_id: str, run_ts=None, glob: str = "*.csv",
                       max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                       on_batch=None) -> dict:
    """Run the stream until every file present is loaded (``availableNow``).

    The stream carries file names only; each batch reads its files by their own
    headers, grouped by column layout, so files with other column orders, in one
    backlog or a later delivery, load alike. Files of any age load. A missing or
    empty folder is skipped. A backlog is split into batches of at most
    ``max_files_per_trigger`` files, so one batch never grows with the backlog
    and a retry redoes one bounded batch. ``on_batch(batch_id, rows)`` is called
    after each batch is written (metrics, logging); if it raises, the stream
    stops and the batch is not committed, so the next run redoes it over its own
    partition.

    A file whose path was loaded before is not loaded again, even with other
    content: deliver a correction under a new name.
    Returns ``{"batches": n, "rows": m}`` for this run.
    """
    stats = {"batches": 0, "rows": 0}
    if not _folder_exists(spark, source_dir):
        return stats
    reader = (spark.readStream.format("binaryFile").schema(_LISTING)
              .option("pathGlobFilter", glob).option("maxFileAge", MAX_FILE_AGE)
              .option("cleanSource", "archive").option("sourceArchiveDir", archive_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir).select("path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # at most max_files_per_trigger names
        paths = [r["path"] for r in batch.collect()]
        groups = header_groups(spark, paths, glob) if paths else []
        if not groups:          # nothing but empty files
            return
        out = conform_bronze(scan_csv_groups(spark, groups), target_schema, run_id, run_ts,
                             headers_normalized=True)
        out = out.withColumn(BATCH_COLUMN, F.lit(int(batch_id)))
        obs = Observation(f"ingest-{batch_id}")
        (out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN)
         .parquet(table_path))
        n = int(obs.get["rows"])
        stats["batches"] += 1
        stats["rows"] += n
        if on_batch is not None:
            on_batch(int(batch_id), n)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return stats


def read_ingested(spark: SparkSession, table_path: str, keep_batch_id: bool = False,
                  since_batch: int | None = None) -> DataFrame:
    """The ingested table; with ``since_batch`` only batches after it, read by
    partition pruning (an incremental silver run reads only new bronze)."""
    df = spark.read.parquet(table_path)
    if since_batch is not None:
        df = df.filter(F.col(BATCH_COLUMN) > F.lit(int(since_batch)))
    return df if keep_batch_id else df.drop(BATCH_COLUMN)


def last_batch(spark: SparkSession, table_path: str) -> int | None:
    """Highest batch id in the ingested table (a one-row aggregate)."""
    return spark.read.parquet(table_path).agg(F.max(BATCH_COLUMN).alias("m")).first()["m"]
