"""Bronze -> silver: rename, fill, cast (metadata driven), dedupe, project,
then full reload or upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from strata.mapping import ColumnMapping
from strata.operators._util import q, resolve, split_keys
from strata.operators.conform import (cast_by_mapping, conform_to_schema, fill_nulls,
                                      project_to_target, rename_by_mapping)
from strata.operators.dedupe import dedupe_any, dedupe_latest
from strata.operators.load import full_reload, upsert
from strata.schemas import AUDIT_COLUMNS, VERSION_COLUMN


def conform_silver(bronze: DataFrame, mapping: ColumnMapping, keys, target_columns,
                   dedupe: str = "latest", order_by=("ADDED_ON",)) -> DataFrame:
    """rename -> fill NULLs -> cast -> one row per key -> target columns.

    Fill runs before the cast, so defaults are text cast with the column.
    ``dedupe="latest"`` keeps the newest row per key (by ``order_by``);
    ``"any"`` keeps an arbitrary one. If the target has ``VERSION_COLUMN`` it gets
    the first ``order_by`` value, and rows of one load time are told apart by the
    target's columns alone, as the upsert does between two deliveries.
    """
    df = rename_by_mapping(bronze, mapping.renames)
    df = fill_nulls(df, mapping.defaults)
    df = cast_by_mapping(df, mapping.types)
    keys = split_keys(keys)
    if _versioned(target_columns):
        if dedupe != "latest":
            raise ValueError(f"a target with {VERSION_COLUMN} needs dedupe='latest'")
        by_upper = {c.upper(): c for c in df.columns}
        order = resolve(df, [order_by] if isinstance(order_by, str) else list(order_by))
        written = {c.upper() for c in [*mapping.target_columns, *keys]} - {
            a.upper() for a in (*AUDIT_COLUMNS, VERSION_COLUMN)}
        wanted = [c for c in target_columns if c.upper() in by_upper and c.upper() in written]
        df = df.select(*[q(by_upper[c.upper()]).alias(c) for c in wanted],
                       q(order[0]).alias(VERSION_COLUMN))
        return dedupe_latest(df, keys, [VERSION_COLUMN])
    if dedupe == "latest":
        df = dedupe_latest(df, keys, order_by)
    elif dedupe == "any":
        df = dedupe_any(df, keys)
    else:
        raise ValueError("dedupe must be 'latest' or 'any'")
    return project_to_target(df, target_columns)


def _versioned(columns) -> bool:
    return VERSION_COLUMN in {c.upper() for c in columns}


def silver_batch(bronze: DataFrame, mapping: ColumnMapping, keys, target_columns,
                 dedupe: str = "latest") -> DataFrame:
    """The conformed batch with the columns a load writes: mapped ones, keys and the
    version, whatever else bronze and target share."""
    batch = conform_silver(bronze, mapping, keys, target_columns, dedupe)
    mapped = {c.lower() for c in [*mapping.target_columns, *split_keys(keys), VERSION_COLUMN]}
    return batch.select([q(c) for c in batch.columns if c.lower() in mapped])


def silver_load(bronze: DataFrame, mapping: ColumnMapping, keys, run_id: str, run_ts=None,
                target: DataFrame | None = None, full_load: bool = False,
                operation: str = "upsert", target_schema: StructType | None = None,
                dedupe: str = "latest", method: str = "auto") -> DataFrame:
    """The new silver snapshot for one object.

    ``full_load``: the conformed batch with all audit columns from this run.
    Otherwise an upsert of the batch into ``target`` on ``keys``. Columns are
    those of ``target_schema``, else of ``target``, else the mapping's target
    columns plus the audit columns; columns that are neither mapped nor keys
    keep the target's values (NULL in inserted and reloaded rows).
    If those columns include ``VERSION_COLUMN``, the newest row per key wins
    across deliveries too: it stores the bronze load time, and a row of an older
    delivery never replaces a newer one. Without it the upsert is unconditional.
    Only the ``upsert`` operation exists; anything else raises.
    """
    if str(operation).lower() != "upsert":
        raise ValueError(f"unsupported operation type {operation!r}")
    if target_schema is not None:
        cols = target_schema.fieldNames()
    elif target is not None:
        cols = target.columns
    else:  # first load without a schema: the mapped columns and the audit columns
        cols = mapping.target_columns + list(AUDIT_COLUMNS)
    batch = silver_batch(bronze, mapping, keys, cols, dedupe)
    shape = target_schema if target_schema is not None else target and target.schema
    if full_load or target is None:
        out = full_reload(batch, run_id, run_ts)
        return out if shape is None else conform_to_schema(out, shape, missing="null")
    if target_schema is not None:       # columns added since the target was written
        target = conform_to_schema(target, target_schema, missing="null")
    return upsert(target, batch, keys, run_id, run_ts, method=method,
                  newest_by=VERSION_COLUMN if _versioned(cols) else None)
