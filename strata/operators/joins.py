"""Left lookups of a dimension and the match part of MERGE.

Broadcast is used only for a side whose measured size fits a budget; beyond
it the join is left to sort-merge with AQE skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, TimestampNTZType, TimestampType)

from strata.operators._util import and_all, materialize, nested, q, resolve

BROADCAST_BUDGET_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType,
                TimestampType, TimestampNTZType, BooleanType)


def broadcast_if_small(df: DataFrame, budget_bytes: int = BROADCAST_BUDGET_BYTES) -> DataFrame:
    """``df`` written once to the shared folder; a broadcast side if the size
    observed on that write (rows and string bytes) fits the budget, else left
    to a sort-merge join with AQE. Nested columns, whose size is not known
    without looking inside, are never broadcast."""
    out, _, n_bytes = materialize(df, "lookup")
    return F.broadcast(out) if not nested(df) and n_bytes <= budget_bytes else out


def _eq(left_on, right_on) -> object:
    return and_all([q(a) == q(b) for a, b in zip(left_on, right_on)])


def _check_names(left: DataFrame, right_cols) -> None:
    clash = sorted({c.upper() for c in right_cols} & {c.upper() for c in left.columns})
    if clash:
        raise ValueError(f"right columns {clash} already exist on the left; alias them first")


def left_join_fanout(left: DataFrame, right: DataFrame, left_on, right_on,
                     right_cols) -> DataFrame:
    """Left equi-join to a right side that is *not* unique on the key: each left
    row repeats once per matching right row; unmatched and NULL-key left rows
    keep NULL right columns.

    Written as ``inner`` join plus ``left_anti`` against the *distinct* right
    keys: AQE can split a hot key on either side of the inner join (it cannot
    split the right side of a left outer join), and the distinct keys fold a hot
    key to one row before they are shuffled. Each input is read by both
    branches: cheap for table scans; write an expensive input first.
    """
    left_on = resolve(left, left_on)
    right_on = resolve(right, right_on)
    right_cols = resolve(right, right_cols)
    _check_names(left, right_cols)
    r_names = [f"__r{i}" for i in range(len(right_on))]
    r = right.select([q(c).alias(n) for c, n in zip(right_on, r_names)] + [q(c) for c in right_cols])
    matched = left.join(r, _eq(left_on, r_names), "inner").select(
        [left[f"`{c}`"] for c in left.columns] + [q(c) for c in right_cols])
    keys = r.select(r_names).distinct()
    unmatched = left.join(keys, _eq(left_on, r_names), "left_anti").select(
        [q(c) for c in left.columns]
        + [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols])
    return matched.unionByName(unmatched)


def left_join_unique(left: DataFrame, right: DataFrame, left_on, right_on, right_cols,
                     pick: str = "min", broadcast_budget: int = BROADCAST_BUDGET_BYTES) -> DataFrame:
    """Left lookup that never multiplies left rows: the right side is first cut
    to one row per key (the smallest, or greatest, ``right_cols`` tuple), then
    left-joined; broadcast when the cut side's measured size is small. The cut
    side is computed and written once, when this is called."""
    left_on = resolve(left, left_on)
    right_on = resolve(right, right_on)
    right_cols = resolve(right, right_cols)
    _check_names(left, right_cols)
    if pick not in ("min", "max"):
        raise ValueError("pick must be 'min' or 'max'")
    r_names = [f"__r{i}" for i in range(len(right_on))]
    grouped = (right.filter(and_all([q(c).isNotNull() for c in right_on]))
               .groupBy(*[q(c).alias(n) for c, n in zip(right_on, r_names)]))
    if len(right_cols) == 1 and isinstance(right.schema[right_cols[0]].dataType, _FIXED_WIDTH):
        # one fixed-width column: the same pick (NULL orders first, as in a
        # struct) from count/min/max, which a hash aggregate computes
        c = q(right_cols[0])
        if pick == "min":
            value = F.when(F.count(F.lit(1)) > F.count(c), F.lit(None)).otherwise(F.min(c))
        else:
            value = F.max(c)
        one = grouped.agg(value.cast(right.schema[right_cols[0]].dataType).alias(right_cols[0]))
    else:
        agg = F.min if pick == "min" else F.max
        one = (grouped.agg(agg(F.struct(*[q(c) for c in right_cols])).alias("__pick"))
               .select(*r_names, *[F.col("__pick")[c].alias(c) for c in right_cols]))
    one = broadcast_if_small(one, broadcast_budget)
    return left.join(one, _eq(left_on, r_names), "left").select(
        [left[f"`{c}`"] for c in left.columns] + [q(c) for c in right_cols])
