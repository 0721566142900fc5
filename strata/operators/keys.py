"""Surrogate keys: dense 1..N numbers over a total order.

``surrogate_key`` gives the same numbers as ``row_number()`` over an
unpartitioned window, without moving all rows into one partition:

0. large groups of exact copies are looked for in a sample of the rows; their rows,
   if there are any, are counted (``groupBy`` on every column, combined on
   the map side) and re-expanded with a copy index, so identical rows get
   distinct sort keys too; a very large group of copies is expanded in
   chunks spread over many tasks. Few copies of a row do no harm in one partition,
   and any numbering of them gives the same rows;
1. range-partition and sort by the total order (``orderBy``), so rows are
   spread evenly even when one leading value holds most of them, because
   tie-break columns (and the copy index) make every sort key distinct;
2. tag each row with its partition id and a per-partition position, and write
   the tagged rows once to the shared checkpoint folder (this fixes partition
   contents, so a recomputation after a lost executor cannot renumber rows);
3. count rows per partition (one row per partition), turn counts into
   running offsets and broadcast them (size bound: the partition count);
4. key = offset of the partition + position inside it + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType

from strata.operators._util import COMPRESSION, and_all, materialize, nested, q, resolve
from strata.operators.joins import BROADCAST_BUDGET_BYTES, broadcast_if_small
from strata.session import scratch_path

COPY_CHUNK = 100_000          # rows one task emits per chunk of a large copy group
COPY_COLUMN = "__sk_copy"
SAMPLED = 1 / 256             # share of the rows in which large groups of copies are looked for
SAMPLED_COPIES = 40           # copies in the sample that make a group large: some 10,000 rows
_LARGEST = {"byte": 2**7 - 1, "tinyint": 2**7 - 1, "short": 2**15 - 1, "smallint": 2**15 - 1,
            "int": 2**31 - 1, "integer": 2**31 - 1, "bigint": 2**63 - 1, "long": 2**63 - 1}


def _orderable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (MapType, ArrayType, StructType))


def total_order(df: DataFrame, order_by, tie_break="all") -> list[Column]:
    """Order columns (ascending, NULLs first) plus tie-breaks.

    ``tie_break="all"`` appends every other orderable column, so rows that
    still tie are identical and any numbering of them gives the same rows.
    """
    names = resolve(df, [order_by] if isinstance(order_by, str) else list(order_by))
    if tie_break == "all":
        extra = [c for c in df.columns if c not in names and _orderable(df, c)]
    else:
        extra = resolve(df, list(tie_break or []))
    return [q(c).asc_nulls_first() for c in names + [c for c in extra if c not in names]]


def _negative_zeros(df: DataFrame) -> list[tuple[str, Column]]:
    """(name, test) per floating column: grouping makes ``-0.0`` and ``0.0`` equal."""
    return [(f.name, (q(f.name) == 0) & q(f.name).cast("string").startswith("-"))
            for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` with their number of copies (``__sk_n``), from a
    map-side-combined aggregate on every column. ``-0.0`` and ``0.0`` stay
    apart and keep their sign; all NaN are one value."""
    zeros = _negative_zeros(df)
    flags = [F.coalesce(test, F.lit(False)).alias(f"__sk_z{i}")
             for i, (_, test) in enumerate(zeros)]
    n = df.groupBy(*[q(c) for c in df.columns], *flags).agg(F.count(F.lit(1)).alias("__sk_n"))
    signed = {c: F.when(F.col(f"__sk_z{i}"), F.lit(-0.0).cast(df.schema[c].dataType))
              .otherwise(q(c)).alias(c) for i, (c, _) in enumerate(zeros)}
    return n.select(*[signed.get(c, q(c)) for c in df.columns], "__sk_n")


def expand_copies(counted: DataFrame, columns) -> DataFrame:
    """Rows again from ``count_copies`` output, each with a copy index
    (0..n-1 among identical rows). Groups above ``COPY_CHUNK`` copies are cut
    into chunks that are hashed over the shuffle partitions before expanding,
    so no task emits a large group alone."""
    cols = [q(c) for c in columns]
    n = F.col("__sk_n")
    small = counted.filter(n <= COPY_CHUNK).select(
        *cols, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias(COPY_COLUMN))
    chunk = F.col("__sk_chunk")
    big = (counted.filter(n > COPY_CHUNK)
           .select(*cols, n, F.explode(F.sequence(
               F.lit(0).cast("long"), ((n - 1) / COPY_CHUNK).cast("long"))).alias("__sk_chunk"))
           .repartition(F.xxhash64(chunk, *cols))
           .select(*cols, F.explode(F.sequence(
               chunk * COPY_CHUNK, F.least(n, (chunk + 1) * COPY_CHUNK) - 1)).alias(COPY_COLUMN)))
    return small.unionByName(big)


def spread_copies(df: DataFrame) -> DataFrame:
    """``df`` plus a copy index among identical rows (see ``count_copies`` and
    ``expand_copies``)."""
    return expand_copies(count_copies(df), df.columns)


def large_copy_groups(df: DataFrame) -> DataFrame | None:
    """Distinct rows that have about ``SAMPLED_COPIES / SAMPLED`` copies or more, none missed
    that has several times as many; None if there are none. A group that a sample shows or
    does not show changes the spread of the rows, never the numbers given."""
    named = df.select([q(c).alias(f"__sk_c{i}") for i, c in enumerate(df.columns)])
    groups = named.sample(SAMPLED, seed=7).groupBy(*named.columns).agg(
        F.count(F.lit(1)).alias("__sk_n")).where(F.col("__sk_n") >= SAMPLED_COPIES).drop("__sk_n")
    path = scratch_path(df.sparkSession, "surrogate-groups")
    groups.write.parquet(path)
    found = df.sparkSession.read.schema(groups.schema).parquet(path)
    return None if found.isEmpty() else found


def _with_copy_index(df: DataFrame) -> DataFrame:
    """``df`` plus a copy index: 0 but for rows of large groups of copies."""
    zero = F.lit(0).cast("long").alias(COPY_COLUMN)
    groups = large_copy_groups(df)
    if groups is None:
        return df.select("*", zero)
    same = _same(df.columns, "__sk_c")
    # both expansion branches read the counts: written once to the shared folder
    path = scratch_path(df.sparkSession, "surrogate-copies")
    count_copies(df.join(F.broadcast(groups), same, "left_semi")).write.parquet(path)
    copies = expand_copies(df.sparkSession.read.parquet(path), df.columns)
    return df.join(F.broadcast(groups), same, "left_anti").select("*", zero).unionByName(copies)


def surrogate_key(df: DataFrame, order_by, name: str, tie_break="all", start: int = 1,
                  key_type: str = "int", num_partitions: int | None = None,
                  copies: str = "spread", unique_by=None) -> DataFrame:
    """Dense keys ``start..start+N-1`` over a total order, without a
    single-partition step (see the module text). The jobs that fix the order
    run when this is called; a key that ``key_type`` cannot hold raises.

    ``copies="spread"`` (default) first looks for large groups of identical rows in a
    sample, then counts and re-expands those, so
    that even a group of exact copies holding a large share of the rows is
    spread over many range partitions. Frames with map, array or struct columns
    cannot be grouped: they need ``"assume_few"``, which skips that
    (one pass less) and is right for inputs without large groups of copies.
    ``unique_by`` names columns that together are unique, as the caller knows:
    they break all ties and no copies are looked for.
    """
    spark = df.sparkSession
    if copies not in ("spread", "assume_few"):
        raise ValueError("copies must be 'spread' or 'assume_few'")
    if unique_by is not None:
        copies, tie_break = "assume_few", unique_by
    if copies == "spread" and not all(_orderable(df, c) for c in df.columns):
        raise ValueError("nested columns cannot be grouped; pass copies='assume_few'")
    work = _with_copy_index(df) if copies == "spread" else df
    order = total_order(work, order_by, tie_break)
    if unique_by is None and tie_break != "all":
        # rows that still tie may be many: a hash of the row spreads them, and the copy index
        plain = [q(c) for c in df.columns if _orderable(df, c)]
        order.append(F.xxhash64(*plain).asc())
        if copies == "spread":
            order.append(F.col(COPY_COLUMN).asc())
    sorted_df = (work.repartitionByRange(num_partitions, *order) if num_partitions
                 else work.repartitionByRange(*order)).sortWithinPartitions(*order)
    tagged = sorted_df.select(
        "*", F.spark_partition_id().alias("__sk_part"),
        F.monotonically_increasing_id().alias("__sk_pos"))
    path = scratch_path(spark, "surrogate-key")
    tagged.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    fixed = spark.read.parquet(path)
    per_part = fixed.groupBy("__sk_part").agg(
        F.count(F.lit(1)).alias("__sk_n"), F.min("__sk_pos").alias("__sk_first"))
    most = _LARGEST.get(key_type.strip().lower())
    if most is not None:
        rows = per_part.agg(F.sum("__sk_n").alias("n")).first()["n"] or 0
        if start + rows - 1 > most:
            raise OverflowError(f"{rows} keys from {start} on do not fit {key_type}")
    offsets = per_part.select(
        "__sk_part", "__sk_first",
        F.coalesce(F.sum("__sk_n").over(
            Window.orderBy("__sk_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("__sk_offset"))
    keyed = fixed.join(F.broadcast(offsets), "__sk_part")
    key = (F.col("__sk_offset") + F.col("__sk_pos") - F.col("__sk_first") + F.lit(start))
    return keyed.select([q(c) for c in df.columns] + [key.cast(key_type).alias(name)])


def _same(columns, prefix: str) -> Column:
    return and_all([q(c).eqNullSafe(F.col(f"{prefix}{i}")) for i, c in enumerate(columns)])


def _renamed(df: DataFrame, columns, prefix: str, *more) -> DataFrame:
    return df.select(*[q(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)], *more)


def _numbered_copies(df: DataFrame, keys, order_by, index: str) -> DataFrame:
    """``df``, a written table, with the number (0..) of each row among those with equal ``keys``.

    Keys that occur once, which is nearly all of them, are told by one aggregate
    and need no order. Only the rows of the others get a dense position over
    (keys, order), less the group's smallest: no group is gathered in one task,
    and NULL keys are a group like any other.
    """
    several = df.groupBy(*[q(k).alias(f"__st_{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("__st_size")).where("__st_size > 1").drop("__st_size")
    several, n, _ = materialize(several, "stable-copies")
    zero = F.lit(0).cast("bigint").alias(index)
    if not n:
        return df.select("*", zero)
    several = broadcast_if_small(several)
    same = _same(keys, "__st_")
    alone = df.join(several, same, "left_anti").select("*", zero)
    placed = surrogate_key(df.join(several, same, "left_semi"), [*keys, *order_by], "__st_pos",
                           key_type="bigint")
    first = placed.groupBy(*[q(k).alias(f"__st_{i}") for i, k in enumerate(keys)]).agg(
        F.min("__st_pos").alias("__st_first"))
    return alone.unionByName(placed.join(first, same).select(
        *[q(c) for c in df.columns], (F.col("__st_pos") - F.col("__st_first")).alias(index)))


def _small_distinct(batch: DataFrame, keys, n_bytes: int) -> DataFrame | None:
    """The distinct ``keys`` of a written batch as a broadcast side; None if they are too many."""
    names = _renamed(batch, keys, "__b_")
    if nested(names):
        return None
    if n_bytes > BROADCAST_BUDGET_BYTES:
        size = names.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(
            F.xxhash64(*names.columns)).alias("d")).first()
        if n_bytes * size["d"] > BROADCAST_BUDGET_BYTES * size["n"]:
            return None
        return broadcast_if_small(names.distinct())
    return F.broadcast(names.distinct())


def _in_order(batch: DataFrame, touched: DataFrame, nk, dim_nk, rest, key_col: str) -> DataFrame:
    """``batch`` with ``__d_key``, the key of the n-th dimension row for the n-th of the rows with
    its natural keys. Both sides are written tables."""
    dim = _renamed(_numbered_copies(touched, dim_nk, [key_col], "__st_n"), dim_nk, "__d_",
                   F.col("__st_n").alias("__d_n"), q(key_col).alias("__d_key"))
    same = _same(nk, "__d_") & (F.col("__st_n") == F.col("__d_n"))
    return _numbered_copies(batch, nk, rest, "__st_n").join(dim, same, "left").select(
        *[q(c) for c in batch.columns], "__d_key")


def _matched(batch: DataFrame, dimension: DataFrame, nk, dim_nk, rest, key_col: str) -> DataFrame:
    """``batch``, a written table, with the key ``__d_key`` that its rows have in ``dimension``.

    One aggregation by natural keys over both sides tells each row its key where the
    natural keys occur once in the batch and at most once in the dimension, which is nearly
    everywhere; NULL is a value like any other. Rows of the other natural keys alone
    are numbered and joined in order.
    """
    spark = batch.sparkSession
    if nested(batch.select([q(c) for c in nk])) or any(
            batch.schema[a].dataType != dimension.schema[b].dataType for a, b in zip(nk, dim_nk)):
        touched, _, _ = materialize(dimension, "stable-touched")
        return _in_order(batch, touched, nk, dim_nk, rest, key_col)
    others = [c for c in batch.columns if c not in nk]
    # grouping makes -0.0 and 0.0 equal: the sign of a batch row is carried along
    zeros = _negative_zeros(batch.select([q(c) for c in nk]))
    signs = F.lit(0)
    for i, (_, test) in enumerate(zeros):
        signs = signs + F.when(test, F.lit(2 ** i)).otherwise(F.lit(0))
    row = F.struct(signs.alias("signs"), *[q(c).alias(f"o{i}") for i, c in enumerate(others)])
    key_type = dimension.schema[key_col].dataType
    both = _renamed(batch, nk, "__g", row.alias("__row"), F.lit(None).cast("int").alias("__d"),
                    F.lit(None).cast(key_type).alias("__d_key")).unionByName(
        _renamed(dimension, dim_nk, "__g", F.lit(1).alias("__d"), q(key_col).alias("__d_key")),
        allowMissingColumns=True)
    groups = both.groupBy(*[f"__g{i}" for i in range(len(nk))]).agg(
        F.first("__row", ignorenulls=True).alias("__row"), F.min("__d_key").alias("__d_key"),
        F.count("__row").alias("__rows"), F.count("__d").alias("__keys")).where("__rows > 0")
    sign = {c: i for i, (c, _) in enumerate(zeros)}
    negative = {c: (F.col("__row.signs").bitwiseAND(2 ** i) != 0) for c, i in sign.items()}
    natural = {c: F.col(f"__g{i}") for i, c in enumerate(nk)}
    cells = [F.when(negative[c], F.lit(-0.0).cast(batch.schema[c].dataType))
             .otherwise(natural[c]).alias(c) if c in sign else
             natural[c].alias(c) if c in natural else
             F.col(f"__row.o{others.index(c)}").alias(c) for c in batch.columns]
    alone = (F.col("__rows") == 1) & (F.col("__keys") <= 1)
    seen, path = Observation("stable-groups"), scratch_path(spark, "stable-groups")
    (groups.select(*cells, "__d_key", alone.alias("__alone"))
     .observe(seen, F.count(F.when(F.col("__alone"), None).otherwise(1)).alias("several"))
     .write.option("compression", COMPRESSION).parquet(path))
    found = spark.read.parquet(path)
    matched = found.where("__alone").drop("__alone")
    if not seen.get["several"]:
        return matched
    several = broadcast_if_small(_renamed(found.where("NOT __alone"), nk, "__w_"))
    touched, _, _ = materialize(dimension.join(several, _same(dim_nk, "__w_"), "left_semi"),
                                "stable-touched")
    copies, _, _ = materialize(batch.join(several, _same(nk, "__w_"), "left_semi"),
                               "stable-copies-of-batch")
    path = scratch_path(spark, "stable-keys")
    (_in_order(copies, touched, nk, dim_nk, rest, key_col)
     .write.option("compression", COMPRESSION).parquet(path))
    return matched.unionByName(spark.read.parquet(path))


def high_water(dimension: DataFrame, key_col: str) -> int:
    """The largest key given so far (0 for none): one pass over the key column alone."""
    top = dimension.agg(F.coalesce(F.max(q(key_col)), F.lit(0)).cast("long").alias("m"))
    return int(top.first()["m"])


def stable_keys(rows: DataFrame, dimension: DataFrame, natural_keys, key_col: str,
                order_by, tie_break="all", key_type: str = "int",
                keep_vanished: bool = True, last_key: int | None = None) -> DataFrame:
    """Keep the keys of rows already in ``dimension``; number new rows from
    ``max(key) + 1`` in ``order_by`` order. Output: ``rows`` columns plus
    ``key_col``.

    Rows match null-safely on ``natural_keys``, one to one: the n-th of several
    rows with equal natural keys takes the n-th smallest key of those in the
    dimension, so no row multiplies and no key is given twice. Dimension rows
    that match nothing stay in the output (columns the dimension lacks are
    NULL), as an upsert would keep them: facts may point to them, and their
    keys are never given to others. ``keep_vanished=False`` leaves them out;
    the caller must then keep the largest key ever given in ``dimension``.

    The work follows ``rows``, the batch: if the measured size of its natural keys
    allows, the dimension is cut to them by a broadcast semi-join, so that it is read but
    not shuffled; else its natural keys and keys alone are shuffled, once. Only
    rows that share their natural keys with others are ordered and numbered. ``last_key``, the high-water mark that the caller
    stores, spares the pass over the key column that finds it.
    """
    nk = resolve(rows, natural_keys if not isinstance(natural_keys, str) else [natural_keys])
    dim_nk = resolve(dimension, nk)
    rest = [c for c in rows.columns if c not in nk and _orderable(rows, c)]
    batch, _, n_bytes = materialize(rows, "stable-batch")
    known = dimension.select(*[q(k) for k in dim_nk], q(key_col))
    wanted = _small_distinct(batch, nk, n_bytes)
    if wanted is not None:
        known = known.join(wanted, _same(dim_nk, "__b_"), "left_semi")
    matched = _matched(batch, known, nk, dim_nk, rest, key_col)
    columns = [q(c) for c in rows.columns]
    existing = matched.where("__d_key IS NOT NULL").select(
        *columns, F.col("__d_key").cast(key_type).alias(key_col))
    top = high_water(dimension, key_col) if last_key is None else int(last_key)
    fresh = surrogate_key(matched.where("__d_key IS NULL").select(columns), order_by, key_col,
                          tie_break, start=top + 1, key_type=key_type)
    out = existing.unionByName(fresh)
    if not keep_vanished:
        return out
    by_upper = {c.upper(): c for c in dimension.columns}
    used = broadcast_if_small(matched.where("__d_key IS NOT NULL").select(
        F.col("__d_key").alias("__st_used")))
    gone = dimension.join(used, q(key_col) == F.col("__st_used"), "left_anti")
    return out.unionByName(gone.select(
        *[(q(by_upper[c.upper()]) if c.upper() in by_upper else F.lit(None))
          .cast(rows.schema[c].dataType).alias(c) for c in rows.columns],
        q(key_col).cast(key_type).alias(key_col)))
