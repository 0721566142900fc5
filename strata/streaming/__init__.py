"""Structured Streaming: load-once ingestion of landing folders, silver from new bronze."""

from strata.streaming.ingest import incremental_ingest, last_batch, read_ingested
from strata.streaming.silver import incremental_silver, read_silver

__all__ = ["incremental_ingest", "incremental_silver", "last_batch", "read_ingested",
           "read_silver"]
