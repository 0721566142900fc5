"""Deduplication by (composite) key.

Both forms are aggregations, so a hot key is folded on the map side
(partial aggregation) before the shuffle: a key holding a third of all rows
still leaves each map task with one row for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators._util import q, resolve, split_keys


def dedupe_any(df: DataFrame, keys) -> DataFrame:
    """One arbitrary row per key; NULL is one key value. Only the key columns
    are deterministic."""
    return df.dropDuplicates(resolve(df, split_keys(keys)))


def dedupe_latest(df: DataFrame, keys, order_by=("ADDED_ON",), newest: bool = True) -> DataFrame:
    """The newest row per key: greatest ``order_by`` value, ties broken by the
    greatest remaining columns, so the survivor is fully deterministic.

    NULL order values lose to any value (as ``desc nulls last`` would). With
    ``newest=False`` the oldest row wins instead.
    """
    keys, packed = _packed(df, keys, order_by)
    pick = F.max(packed) if newest else F.min(packed)
    return _unpacked(df, df.groupBy(*[q(k) for k in keys]).agg(pick.alias("__row")), keys)


def dedupe_ends(df: DataFrame, keys, order_by=("ADDED_ON",), flag: str = "NEWEST") -> DataFrame:
    """The newest row per key (``flag`` true) and the oldest (false), as ``dedupe_latest`` picks
    them, by one aggregation instead of two."""
    keys, packed = _packed(df, keys, order_by)
    both = df.groupBy(*[q(k) for k in keys]).agg(
        F.array(*[F.struct(end.alias("row"), F.lit(newest).alias("newest"))
                  for newest, end in ((True, F.max(packed)), (False, F.min(packed)))])
        .alias("__ends"))
    rows = both.select(*[q(k) for k in keys], F.explode("__ends").alias("__end")).select(
        *[q(k) for k in keys], F.col("__end.row").alias("__row"),
        F.col("__end.newest").alias(flag))
    return _unpacked(df, rows, keys, flag)


def _packed(df: DataFrame, keys, order_by):
    """The keys, and a struct of all other columns in the order that decides."""
    keys = resolve(df, split_keys(keys))
    order = resolve(df, [order_by] if isinstance(order_by, str) else list(order_by))
    rest = [c for c in df.columns if c not in keys and c not in order]
    return keys, F.struct(*[q(c) for c in order + rest])


def _unpacked(df: DataFrame, rows: DataFrame, keys, *more) -> DataFrame:
    return rows.select(*[q(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns],
                       *more)
