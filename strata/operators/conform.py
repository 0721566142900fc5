"""Projections that fit a frame to a target: rename, fill, cast, project,
conform to a schema, audit columns, schema evolution.

Every operator is one ``select`` (a single Project node), never a chain of
``withColumn`` calls.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from strata.functions.casts import cast_by_type_name, cast_to
from strata.schemas import AUDIT_COLUMNS


def _q(name: str) -> Column:
    """Column by exact name, safe for names with dots or spaces."""
    return F.col(f"`{name.replace('`', '``')}`")


def _check_unique(names: list[str]) -> None:
    seen: dict[str, str] = {}
    for n in names:
        k = n.upper()
        if k in seen:
            raise ValueError(f"columns {seen[k]!r} and {n!r} collide")
        seen[k] = n


def rename_by_mapping(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename source to target names, all at once (a swap stays a swap).

    Matching is case-insensitive; names not in the frame are ignored; two
    columns ending with the same name raise.
    """
    lookup = {k.upper(): v for k, v in renames.items()}
    new_names = [lookup.get(c.upper(), c) for c in df.columns]
    _check_unique(new_names)
    return df.select([_q(c).alias(n) for c, n in zip(df.columns, new_names)])


def fill_nulls(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Replace NULL (and NaN in float columns) by a per-column default.

    Defaults are text, cast to the column's type (a default that does not fit
    raises under ANSI); a column not in the frame raises.
    """
    if not defaults:
        return df
    by_upper = {c.upper(): c for c in df.columns}
    resolved = {}
    for name, value in defaults.items():
        if name.upper() not in by_upper:
            raise ValueError(f"cannot fill column {name!r}: not in {df.columns}")
        resolved[by_upper[name.upper()]] = value
    return df.na.fill(resolved)


def cast_by_mapping(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast each mapped column by its type name (date ladder, zoned timestamp
    or try_cast); columns without a mapping, and mapped names absent from the
    frame, are left alone."""
    lookup = {k.upper(): v for k, v in types.items()}
    cols = []
    for c in df.columns:
        t = lookup.get(c.upper())
        text = isinstance(df.schema[c].dataType, StringType)
        cols.append(cast_by_type_name(_q(c), t, text).alias(c) if t else _q(c))
    return df.select(cols)


def project_to_target(df: DataFrame, target_columns) -> DataFrame:
    """Keep columns that exist in the target (case-insensitive), source order."""
    wanted = {c.upper() for c in target_columns}
    return df.select([_q(c) for c in df.columns if c.upper() in wanted])


def conform_to_schema(df: DataFrame, schema: StructType, on_error: str = "fail",
                      case_insensitive: bool = True, missing: str = "fail") -> DataFrame:
    """Select every target field, cast and aliased, in target order; extra
    columns are dropped. A missing column raises (``missing="fail"``) or is
    NULL of the target type (``missing="null"``)."""
    by_name = {(c.upper() if case_insensitive else c): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_name.get(f.name.upper() if case_insensitive else f.name)
        if src is None:
            if missing == "null":
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            raise ValueError(f"column {f.name!r} missing; frame has {df.columns}")
        cols.append(cast_to(_q(src), f.dataType, on_error).alias(f.name))
    return df.select(cols)


def with_audit(df: DataFrame, run_id: str, run_ts: datetime | Column | None = None,
               columns=AUDIT_COLUMNS) -> DataFrame:
    """Set ``*_BY`` to the run id and ``*_ON`` to the run time.

    ``run_ts`` defaults to ``current_timestamp()``; pass a fixed value to make
    results reproducible.
    """
    if not run_id:
        raise ValueError("run_id is required")
    ts = run_ts if isinstance(run_ts, Column) else (
        F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp"))
    values = {}
    for c in columns:
        values[c] = F.lit(run_id).cast("string") if c.upper().endswith("_BY") else ts
    keep = [_q(c) for c in df.columns if c.upper() not in {v.upper() for v in values}]
    return df.select(keep + [v.alias(k) for k, v in values.items()])


def add_column_at(df: DataFrame, name: str, data_type: DataType | str,
                  after: str | None = None) -> DataFrame:
    """Schema evolution: a NULL column of a type at a position (after a
    column, or first when ``after`` is None)."""
    if name.upper() in {c.upper() for c in df.columns}:
        raise ValueError(f"column {name!r} already exists")
    new = F.lit(None).cast(data_type).alias(name)
    if after is None:
        return df.select([new] + [_q(c) for c in df.columns])
    pos = [c.upper() for c in df.columns].index(after.upper()) + 1
    cols = [_q(c) for c in df.columns]
    return df.select(cols[:pos] + [new] + cols[pos:])


def select_alias(df: DataFrame, pairs) -> DataFrame:
    """Pick and rename: ``pairs`` is a list of ``(source, target)`` or names."""
    cols = []
    for p in pairs:
        src, dst = (p, p) if isinstance(p, str) else p
        cols.append(_q(src).alias(dst))
    return df.select(cols)
