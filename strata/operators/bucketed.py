"""Co-located tables: a target or dimension stored in buckets of its key.

A table that is merged into, or looked up, run after run is the large side of the
same join every time. Stored in buckets of the key, its rows lie where the join
wants them: a merge or a lookup then shuffles the batch alone, into the table's
buckets, and reads the table in place. A new snapshot keeps the buckets without
moving the old rows either.

Buckets are chosen once, for the table's size (a few hundred MB each). Rows with a
NULL key share a bucket, and so do copies of one key: use it for tables with one
row per key, as silver tables and lookups are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators._util import and_all, q, resolve, split_keys
from strata.operators.load import upsert


def write_bucketed(df: DataFrame, table: str, path: str, keys, buckets: int,
                   placed: bool = False) -> DataFrame:
    """Write ``df`` as catalog table ``table`` at ``path`` in ``buckets`` buckets of ``keys``.

    ``placed`` says that the rows come out of a join on the buckets, so that they are
    written as they lie; else they are first brought together, one file a bucket.
    """
    keys = resolve(df, split_keys(keys))
    rows = df if placed else df.repartition(buckets, *[q(k) for k in keys])
    (rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .saveAsTable(table))
    return df.sparkSession.table(table)


def buckets_of(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """(number of buckets, their columns) of a catalog table; (0, []) if it has none."""
    facts = {r["col_name"]: r["data_type"] for r in
             spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect()}
    n = int(facts.get("Num Buckets") or 0)
    columns = facts.get("Bucket Columns") or ""
    return n, [c.strip().strip("`") for c in columns.strip("[]").split(",")] if n else []


def _table(spark: SparkSession, table: str, keys) -> tuple[DataFrame, list[str], int]:
    df = spark.table(table)
    keys = resolve(df, split_keys(keys))
    n, columns = buckets_of(spark, table)
    if not n or sorted(columns) != sorted(keys):
        raise ValueError(f"{table} is bucketed by {columns}, not by {keys}")
    return df, keys, n


def merge_bucketed(spark: SparkSession, table: str, source: DataFrame, keys, run_id: str,
                   run_ts=None, into: tuple[str, str] | None = None, **options) -> DataFrame:
    """MERGE ``source`` into the bucketed ``table``; the new snapshot.

    Rules and ``options`` are those of ``upsert``. ``into`` (table name, path) also
    writes the snapshot as a bucketed table of its own and returns that, so the next
    run finds the same buckets. Of the target's rows none is shuffled.
    """
    target, keys, n = _table(spark, table, keys)
    snapshot = upsert(target, source, keys, run_id, run_ts, method="bucketed", **options)
    if into is None:
        return snapshot
    if into[0] == table:
        raise ValueError("a snapshot cannot replace the table it is read from")
    return write_bucketed(snapshot, *into, keys, n, placed=True)


def left_join_bucketed(left: DataFrame, table: str, left_on, right_on, right_cols) -> DataFrame:
    """The lookup of ``left_join_unique`` in a table bucketed by ``right_on``.

    The cut to one row per key (the smallest ``right_cols``) happens inside the
    buckets; only ``left`` is shuffled.
    """
    right, right_on, _ = _table(left.sparkSession, table, right_on)
    left_on = resolve(left, left_on)
    right_cols = resolve(right, right_cols)
    if clash := {c.upper() for c in right_cols} & {c.upper() for c in left.columns}:
        raise ValueError(f"right columns {sorted(clash)} already exist on the left")
    one = (right.where(and_all([q(c).isNotNull() for c in right_on])).groupBy(*[q(c) for c in right_on])
           .agg(F.min(F.struct(*[q(c).alias(f"__p{i}") for i, c in enumerate(right_cols)]))
                .alias("__pick"))
           .select(*[q(c).alias(f"__r{i}") for i, c in enumerate(right_on)],
                   *[F.col("__pick")[f"__p{i}"].alias(c) for i, c in enumerate(right_cols)]))
    same = and_all([q(c) == F.col(f"__r{i}") for i, c in enumerate(left_on)])
    return left.join(one, same, "left").select(*[left[f"`{c}`"] for c in left.columns],
                                               *[q(c) for c in right_cols])
