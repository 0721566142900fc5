"""Table loads without a row-level table format: append, full reload, upsert.

``upsert`` returns the new snapshot of the target as a DataFrame; write it to
a new folder (``write_table``), never over the folder being read.

Audit rules (both layers): an updated row keeps ``ADDED_*`` and gets
``MODIFIED_*`` = this run; an inserted row gets all four from this run; a
kept row is unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType, StringType

from strata.operators._util import (COMPRESSION, all_not_null, and_all, any_null, fits_budget,
                                    fixed_row_bytes, materialize, nested, q, resolve,
                                    split_keys)
from strata.operators.conform import conform_to_schema, with_audit
from strata.operators.joins import BROADCAST_BUDGET_BYTES
from strata.schemas import AUDIT_COLUMNS
from strata.session import scratch_path

NULL_KEY_SALT_BUCKETS = 4096


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append as a query: the target's rows plus the batch's, by column name;
    duplicates are kept."""
    return target.unionByName(batch.select([q(c) for c in resolve(batch, target.columns)])
                              .toDF(*target.columns))


def full_reload(batch: DataFrame, run_id: str, run_ts=None, schema=None) -> DataFrame:
    """The new table content of a full reload: the batch, paired to the target
    by column name, with all four audit columns from this run."""
    out = with_audit(batch, run_id, run_ts)
    return conform_to_schema(out, schema) if schema is not None else out


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by=None) -> int:
    """Write ``df`` as Parquet and return the number of rows written, taken from
    an observation on the write itself (no second pass)."""
    obs = Observation("rows_written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)
    return int(obs.get["rows"])


def _audit_present(target: DataFrame) -> dict[str, str]:
    by_upper = {c.upper(): c for c in target.columns}
    return {a: by_upper[a] for a in AUDIT_COLUMNS if a in by_upper}


def _plan_columns(target, source, keys, update_columns):
    keys = resolve(target, split_keys(keys))
    src_keys = resolve(source, keys)
    audit = _audit_present(target)
    audit_cols = set(audit.values())
    src_upper = {c.upper(): c for c in source.columns}
    if update_columns is None:
        upd = [c for c in target.columns
               if c not in keys and c not in audit_cols and c.upper() in src_upper]
    else:
        upd = resolve(target, update_columns)
    src_upd = [src_upper[c.upper()] for c in upd]
    return keys, src_keys, upd, src_upd, audit


def _check_source(source, src_keys, null_keys, check_unique):
    kcols = [q(k) for k in src_keys]
    if null_keys == "reject":
        if source.filter(any_null(kcols)).limit(1).count():
            raise ValueError(f"source has NULL in key columns {src_keys}")
    elif null_keys != "merge":
        raise ValueError("null_keys must be 'merge' or 'reject'")
    if check_unique:
        dup = (source.filter(all_not_null(kcols)).groupBy(*kcols).count()
               .filter(F.col("count") > 1).limit(1).collect())
        if dup:
            raise ValueError(f"source is not unique on {src_keys}: {dup[0].asDict()}")


def _ts(run_ts) -> Column:
    if isinstance(run_ts, Column):
        return run_ts
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def upsert(target: DataFrame, source: DataFrame, keys, run_id: str, run_ts=None,
           update_columns=None, check_unique: bool = True, null_keys: str = "merge",
           method: str = "auto", broadcast_budget: int = BROADCAST_BUDGET_BYTES,
           with_action: bool = False, materialize_source: bool = True,
           newest_by=None) -> DataFrame:
    """MERGE-as-snapshot on one or more key columns.

    Matched rows take the source's values of ``update_columns`` (default: every
    target column the source has, except keys and audit columns; a NULL in the
    source overwrites). Unmatched source rows are inserted (target-only columns
    NULL). NULL keys never match, as in MERGE. The source must be unique on its
    non-NULL keys.

    ``method``: ``broadcast`` scans the target once with the source broadcast
    (plus a key-only scan) and never shuffles the target; ``shuffle`` is a
    left outer sort-merge join of target and source plus an anti join of the
    source against the distinct target keys (AQE may split hot target
    partitions; NULL target keys are salted); ``auto`` picks ``broadcast``
    when the source is proven to fit ``broadcast_budget``; ``bucketed`` is
    ``shuffle`` on the keys alone, for a target stored in buckets of them, whose
    rows then stay where they are (see :mod:`strata.operators.bucketed`).

    ``materialize_source`` writes the (projected) source once to the shared
    checkpoint folder, so the checks and the joins read it instead of
    recomputing it (a deduplicated batch would otherwise shuffle again per
    pass); the size observed on that write (rows, and the real bytes of the
    string columns) decides the strategy.

    ``newest_by`` names columns that order the versions of a row; both sides
    must have them and the target stores them (they are update columns). A
    matched row is then updated only if the source's version is the greater
    one, else it is kept as it is. Equal versions are decided by the other
    update columns, so there is one total order (NULL is the smallest value, as
    in ``dedupe_latest``): deliveries may come late, repeated or in any order,
    and the target ends with the same values.
    """
    out, _ = upsert_changes(target, source, keys, run_id, run_ts, update_columns, check_unique,
                            null_keys, method, broadcast_budget, materialize_source, newest_by)
    return out if with_action else out.drop("__action")


def upsert_changes(target, source, keys, run_id, run_ts=None, update_columns=None,
                   check_unique=True, null_keys="merge", method="auto",
                   broadcast_budget=BROADCAST_BUDGET_BYTES, materialize_source=True,
                   newest_by=None) -> tuple[DataFrame, bool]:
    """The snapshot of :func:`upsert` with its ``__action``, and false if it is known, from the
    versions, to be the target as it is."""
    if not run_id:
        raise ValueError("run_id is required")
    keys, src_keys, upd, src_upd, audit = _plan_columns(target, source, keys, update_columns)
    version = _version_columns(target, newest_by, keys, upd)
    src = source.select([q(c).alias(k) for c, k in zip(src_keys + src_upd, keys + upd)])
    n_bytes = None
    if materialize_source:
        src, _, n_bytes = materialize(src, "upsert-source")
    if method == "auto":
        small = (n_bytes <= broadcast_budget if n_bytes is not None
                 else fits_budget(src, broadcast_budget))
        method = "broadcast" if small else "shuffle"
    by_version = bool(version) and method == "shuffle" and _comparable(target, src, keys, version)
    _check_source(src, keys, null_keys, check_unique and not by_version)
    if by_version:
        return _upsert_versions(target, src, keys, upd, audit, run_id, _ts(run_ts), version,
                                check_unique, broadcast_budget)
    if method == "broadcast":
        out = _upsert_broadcast(target, src, keys, upd, audit, run_id, _ts(run_ts), version)
    elif method in ("shuffle", "bucketed"):
        out = _upsert_shuffle(target, src, keys, upd, audit, run_id, _ts(run_ts), version,
                              salted=method == "shuffle")
    else:
        raise ValueError("method must be 'auto', 'broadcast', 'shuffle' or 'bucketed'")
    return out, True


def _version_columns(target: DataFrame, newest_by, keys, upd) -> list[str]:
    """The columns that decide between two versions of a row, most telling first."""
    if newest_by is None:
        return []
    first = resolve(target, split_keys(newest_by))
    if lost := [c for c in first if c not in upd]:
        raise ValueError(f"newest_by columns {lost} are not among the updated columns {upd}")
    maps = [f.name for f in target.schema.fields if isinstance(f.dataType, MapType)]
    return first + [c for c in upd if c not in first and c not in maps]


def _wins(target: DataFrame, version: list[str]) -> Column:
    """Whether the joined row's source version is greater than the target's."""
    if not version:
        return F.lit(True)
    mine = F.struct(*[q(f"__s_{c}").cast(target.schema[c].dataType).alias(c) for c in version])
    return mine > F.struct(*[q(f"__t_{c}").alias(c) for c in version])


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([q(c).alias(prefix + c) for c in df.columns])


def _assemble(target_cols, keys, upd, audit, has_t: Column, has_s: Column, run_id, ts):
    """Output columns from a joined row of ``__t_*`` / ``__s_*`` columns."""
    by_audit = {v: k for k, v in audit.items()}
    out = []
    for c in target_cols.fields:
        dt, c = c.dataType, c.name
        t, s = F.col(f"`__t_{c}`"), F.col(f"`__s_{c}`").cast(dt)
        if c in keys or c in upd:
            out.append(F.when(has_s, s).otherwise(t).alias(c))
        elif c in by_audit:
            run_val = (F.lit(run_id) if by_audit[c].endswith("_BY") else ts).cast(dt)
            if by_audit[c].startswith("ADDED"):
                out.append(F.when(has_t, t).otherwise(run_val).alias(c))
            else:
                out.append(F.when(has_s, run_val).otherwise(t).alias(c))
        else:
            out.append(t.alias(c))
    action = (F.when(has_t & has_s, F.lit("updated"))
              .when(has_s, F.lit("inserted")).otherwise(F.lit("kept")))
    return out + [action.alias("__action")]


def _joined(target, src, keys, upd, audit, run_id, ts, version, salted=True):
    """Kept and updated rows by a sort-merge join."""
    # kept + updated: the target left-joined to the batch. AQE may split a hot
    # target partition (the left side of a left outer join), so copies of one
    # key in the target do not pile onto one task; the batch side is unique.
    # Target rows with a NULL key never match: a deterministic salt spreads
    # them over many reducers even where AQE cannot split.
    t = _prefixed(target, "__t_")
    kcols = [q(f"__t_{k}") for k in keys]
    t = t.select("*", F.when(any_null(kcols), F.pmod(F.xxhash64(*[q(c) for c in t.columns]),
                                                   F.lit(NULL_KEY_SALT_BUCKETS)))
                 .otherwise(F.lit(0)).alias("__t__salt"))
    s = _prefixed(src, "__s_").select("*", F.lit(0).alias("__s__salt"),
                                      F.lit(True).alias("__in_s"))
    cond = and_all([q(f"__t_{k}") == q(f"__s_{k}") for k in keys]
                   + ([F.col("__t__salt") == F.col("__s__salt")] if salted else []))
    updated = F.col("__in_s").isNotNull() & _wins(target, version)
    return t.join(s, cond, "left_outer").select(_assemble(
        target.schema, keys, upd, audit, F.lit(True), updated, run_id, ts))


def _upsert_shuffle(target, src, keys, upd, audit, run_id, ts, version, salted=True):
    old = _joined(target, src, keys, upd, audit, run_id, ts, version, salted)
    # inserted: batch rows whose key is not in the target; the target's keys
    # are made distinct first (combined on the map side)
    target_keys = target.select([q(k) for k in keys]).distinct()
    return old.unionByName(_inserted(target, src.join(target_keys, keys, "left_anti"), keys, upd,
                                     audit, run_id, ts))


def _comparable(target, src, keys, version) -> bool:
    """Whether keys and versions can be compared ahead of the rows: plain types, keys of one type."""
    return (not nested(target.select([q(c) for c in [*keys, *version]]))
            and all(src.schema[k].dataType == target.schema[k].dataType for k in keys))


def _kept(target):
    return target.select("*", F.lit("kept").alias("__action"))


def _compare_versions(target, src, keys, version):
    """The keys that do something with their ``__state``, and the number of keys by state.

    A key is inserted if the target lacks it, and may be updated unless its source row
    surely loses: by a first version column that is NULL or less than that of all target
    rows of the key, or by being the same version as the only one. Sameness is told by a
    64-bit hash of all version columns and their NULLs, so that no other column is shuffled.
    NULL keys never match; they are left out here. Copies of a key fold before the shuffle.
    """
    kcols = [q(k) for k in keys]

    def narrow(df, columns, prefix, *more):
        cells = [q(c).cast(target.schema[c].dataType) for c in columns]
        # xxhash64 passes over NULLs, so where they are is hashed too
        return (df.where(all_not_null(kcols))
                .select(*[q(k).alias(f"__{prefix}k{i}") for i, k in enumerate(keys)],
                        cells[0].alias("v"),
                        F.xxhash64(*cells, *[c.isNull() for c in cells]).alias("h"))
                .groupBy(*[f"__{prefix}k{i}" for i in range(len(keys))])
                .agg(*[e.alias(f"__{prefix}_{n}") for n, e in more]))

    v, h, rows = F.col("v"), F.col("h"), F.count(F.lit(1))
    # bytes that differ lie side by side, which the shuffle's compression likes
    s = narrow(src, version, "s", ("h", F.max(h)), ("v", F.max(v)), ("n", rows))
    t = narrow(target, version, "t", ("h", F.max(h)), ("v", F.min(v)), ("n", rows),
               ("null", F.max(v.isNull())))
    same = and_all([F.col(f"__sk{i}") == F.col(f"__tk{i}") for i in range(len(keys))])
    found = F.col("__t_n").isNotNull()
    loses = ((~F.col("__t_null") & (F.col("__s_v").isNull() | (F.col("__s_v") < F.col("__t_v"))))
             | ((F.col("__t_n") == 1) & (F.col("__t_h") == F.col("__s_h"))))
    state = (F.when(F.col("__s_n") > 1, "twice").when(~found, "new").when(loses, "lost")
             .otherwise("maybe"))
    seen = Observation("upsert-versions")
    path = scratch_path(src.sparkSession, "upsert-versions")
    (s.join(t, same, "left").select(*[F.col(f"__sk{i}") for i in range(len(keys))],
                                    state.alias("__state"))
     .observe(seen, *[F.count(F.when(F.col("__state") == x, 1)).alias(x) for x in
                      ("twice", "new", "lost", "maybe")])
     .where("__state <> 'lost'").write.option("compression", COMPRESSION).parquet(path))
    return src.sparkSession.read.parquet(path), seen.get


def _upsert_versions(target, src, keys, upd, audit, run_id, ts, version, check_unique,
                     broadcast_budget):
    """``_upsert_shuffle`` of the source rows that do something, found by their versions, and
    whether there are any."""
    touched, n = _compare_versions(target, src, keys, version)
    names = [f"__sk{i}" for i in range(len(keys))]
    if n["twice"]:
        if check_unique:
            dup = touched.where("__state = 'twice'").select(names).first()
            raise ValueError(f"source is not unique on {keys}: {dict(zip(keys, dup))}")
        return _upsert_shuffle(target, src, keys, upd, audit, run_id, ts, version), True

    def rows_of(state: str) -> DataFrame:
        wanted = touched.where(F.col("__state") == state).select(names)
        if not _texts(wanted) and n[state] * fixed_row_bytes(wanted) <= broadcast_budget:
            wanted = F.broadcast(wanted)
        return src.join(wanted, and_all([q(k) == F.col(m) for k, m in zip(keys, names)]),
                        "left_semi")

    fresh = src.where(any_null([q(k) for k in keys]))
    if not n["new"] and not n["maybe"] and fresh.isEmpty():
        return _kept(target), False
    if n["new"]:
        fresh = fresh.unionByName(rows_of("new"))
    old = _kept(target)
    if n["maybe"]:
        mine, small = src, False
        if 2 * n["maybe"] <= sum(n.values()):       # else the others may come along
            mine, _, n_bytes = materialize(rows_of("maybe"), "upsert-maybe")
            small = n_bytes <= broadcast_budget and not nested(mine)
        old = (_looked_up if small else _joined)(target, mine, keys, upd, audit, run_id, ts, version)
    return old.unionByName(_inserted(target, fresh, keys, upd, audit, run_id, ts)), True


def _texts(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, (StringType, BinaryType)) for f in df.schema.fields)


def _inserted(target, new_rows, keys, upd, audit, run_id, ts):
    """Batch rows to insert, shaped like the target, audit from this run."""
    by_audit = {v: k for k, v in audit.items()}
    cols = []
    for c in target.columns:
        dt = target.schema[c].dataType
        if c in keys or c in upd:
            cols.append(q(c).cast(dt).alias(c))
        elif c in by_audit:
            val = F.lit(run_id) if by_audit[c].endswith("_BY") else ts
            cols.append(val.cast(dt).alias(c))
        else:
            cols.append(F.lit(None).cast(dt).alias(c))
    return new_rows.select(cols + [F.lit("inserted").alias("__action")])


def _looked_up(target, src, keys, upd, audit, run_id, ts, version):
    """Kept and updated rows by one pass over the target."""
    t = _prefixed(target, "__t_")
    s = _prefixed(src, "__s_").select("*", F.lit(True).alias("__in_s"))
    cond = and_all([q(f"__t_{k}") == q(f"__s_{k}") for k in keys])
    tj = t.join(F.broadcast(s), cond, "left_outer")
    updated = F.col("__in_s").isNotNull() & _wins(target, version)
    return tj.select(_assemble(target.schema, keys, upd, audit, F.lit(True), updated, run_id, ts))


def _upsert_broadcast(target, src, keys, upd, audit, run_id, ts, version):
    old = _looked_up(target, src, keys, upd, audit, run_id, ts, version)
    # source rows with no target row: anti join against the matched keys,
    # found by a key-only scan of the target semi-joined to the source keys
    src_keys = src.select([q(k) for k in keys])
    # made distinct, so copies of one target key fold to one row before they are shuffled
    matched = (target.select([q(k) for k in keys]).join(F.broadcast(src_keys), keys, "left_semi")
               .distinct())
    new_rows = src.join(matched, keys, "left_anti")
    return old.unionByName(_inserted(target, new_rows, keys, upd, audit, run_id, ts))


def upsert_actions(target: DataFrame, source: DataFrame, keys, method: str = "auto",
                   broadcast_budget: int = BROADCAST_BUDGET_BYTES) -> DataFrame:
    """Keys with the MERGE action each gets: ``updated`` (in both),
    ``inserted`` (source only, NULL keys included) or ``kept`` (target only).

    The match part of :func:`upsert` on key columns alone, so it shares its
    strategies (broadcast of a proven-small source, else a left outer join
    plus an anti join against the distinct target keys). As in MERGE, the
    source must be unique on its non-NULL keys.
    """
    keys = resolve(target, split_keys(keys))
    src_keys = resolve(source, keys)
    snap = upsert(target.select([q(k) for k in keys]),
                  source.select([q(sk).alias(k) for sk, k in zip(src_keys, keys)]),
                  keys, run_id="actions", update_columns=[], method=method,
                  broadcast_budget=broadcast_budget, with_action=True)
    return snap.select([q(k) for k in keys] + [F.col("__action").alias("action")])


def upsert_counts(snapshot_with_action: DataFrame) -> DataFrame:
    """Rows per action of an ``upsert(..., with_action=True)`` result."""
    return (snapshot_with_action.groupBy(F.col("__action").alias("action"))
            .agg(F.count(F.lit(1)).alias("row_count")))
