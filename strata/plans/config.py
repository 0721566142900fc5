"""Object configuration rows (one per object) as typed values.

The config table is metadata: one row per object, so collecting the active
rows is bounded by the number of objects. The caller decides which job runs
for each object; ``silver_job`` maps one config row to ``silver_load``
arguments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators._util import split_keys


@dataclass(frozen=True)
class ObjectConfig:
    object_name: str
    source_name: str | None
    bronze_table: str | None
    silver_table: str | None
    operation: str
    keys: tuple[str, ...]
    full_load: bool
    source_path: str | None = None
    archive_path: str | None = None


def active_objects(config: DataFrame, flag: str = "IS_RUN") -> list[ObjectConfig]:
    """Active rows (``flag = 1``, pushed into the source) as ``ObjectConfig``,
    ordered by object name. An operation other than upsert raises."""
    rows = config.filter(F.col(flag) == 1).orderBy("OBJECT_NAME").collect()
    out = []
    for r in rows:
        d = r.asDict()
        op = str(d.get("OPERATION_TYPE") or "")
        if op.lower() != "upsert":
            raise ValueError(f"unsupported operation type {op!r} for {d.get('OBJECT_NAME')}")
        out.append(ObjectConfig(
            object_name=d["OBJECT_NAME"], source_name=d.get("SOURCE_NAME"),
            bronze_table=d.get("BRONZE_TABLE_NAME"), silver_table=d.get("SILVER_TABLE_NAME"),
            operation=op, keys=tuple(split_keys(d.get("KEY_COLUMN_NAME") or "")),
            full_load=int(d.get("IS_FULL_LOAD") or 0) == 1,
            source_path=d.get("SOURCE_FILE_PATH"), archive_path=d.get("ARCHIVE_PATH")))
    return out


def silver_job(cfg: ObjectConfig, bronze: DataFrame, mapping_table: DataFrame, run_id: str,
               run_ts=None, target: DataFrame | None = None, target_schema=None) -> DataFrame:
    """``silver_load`` for one configured object (mapping fetched for it)."""
    from strata.mapping import ColumnMapping
    from strata.plans.silver import silver_load
    mapping = ColumnMapping.from_frame(mapping_table, cfg.object_name, cfg.source_name)
    return silver_load(bronze, mapping, list(cfg.keys), run_id, run_ts, target=target,
                       full_load=cfg.full_load or target is None, operation=cfg.operation,
                       target_schema=target_schema)
