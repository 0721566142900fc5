"""Registered queries: one per operator of the inventory, each on an analogue
built from the driver's tables (see ``fixtures.analogues``).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise a sink write to a fresh folder below the shared checkpoint folder and
return the written table read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, FloatType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

from fixtures import analogues as A
from strata.functions import (cast_to, normalize_headers, parse_date_ladder,
                              parse_zoned_timestamp, try_cast_by_type)
from strata.functions.infer import merge_evidence, narrowest, type_evidence
from strata.mapping import ColumnMapping, mapping_frame
from strata.operators import (add_column_at, append, cast_by_mapping, conform_to_schema,
                              dedupe_any, dedupe_latest, fill_nulls, full_reload,
                              left_join_bucketed, left_join_fanout, left_join_unique,
                              merge_bucketed, project_to_target,
                              rename_by_mapping, select_alias, stable_keys, surrogate_key,
                              upsert, upsert_actions, upsert_by_file, upsert_counts,
                              upsert_partitioned, with_audit, write_bucketed, write_clustered,
                              write_table)
from strata.plans import (bronze_load, dim_appointment, fact_sales, fact_sales_delta,
                          silver_load)
from strata.schemas import AUDIT_COLUMNS, GOLD_DIM_APPOINTMENT, VERSION_COLUMN, versioned
from strata.session import scratch_path
from strata.sources import (filter_active, scan_csv, scan_csv_folder, scan_csv_inferred,
                            scan_table, sql_view_scan)
from strata.streaming import (incremental_ingest, incremental_silver, read_ingested,
                              read_silver)
from strata.streaming.ingest import BATCH_COLUMN

Query = Callable[[SparkSession, str], DataFrame]
T = A.table


# ---------------------------------------------------------------- sources
def q_table_scan(spark, sf):
    return scan_table(spark, f"{sf.rstrip('/')}/customer.parquet")


def q_sql_view_scan(spark, sf):
    view = "strata_orders_view"
    return sql_view_scan(
        spark, T(spark, sf, "orders"), view,
        f"SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {view} "
        "WHERE o_orderpriority = :priority", {"priority": "1-URGENT"})


def q_csv_scan_strings(spark, sf):
    return scan_csv(spark, A.write_landing(spark, sf, "landing-strings"))


def q_csv_scan_inferred(spark, sf):
    path = A.write_landing(spark, sf, "landing-inferred")
    return scan_csv_inferred(spark, f"{path}/*.csv")


def q_csv_folder_scan(spark, sf):
    return scan_csv_folder(spark, A.write_landing(spark, sf, "landing-folder", variants=True))


def q_csv_infer_types(spark, sf):
    # two deliveries, each read once; the second widens what the first one has
    folder = A.write_landing(spark, sf, "landing-types", variants=True)
    lines = A.write_typed_landing(spark, sf, "landing-lines")
    evidence = merge_evidence(type_evidence(scan_csv_folder(spark, folder)),
                              *[type_evidence(scan_csv(spark, f)) for f in lines])
    return evidence.withColumn("narrowest", narrowest())


# ---------------------------------------------------------------- sinks
def q_append_load(spark, sf):
    path = scratch_path(spark, "append")
    cust = T(spark, sf, "customer")
    write_table(cust, path, mode="append")          # first delivery
    write_table(cust, path, mode="append")          # the same file delivered again
    return spark.read.parquet(path)


def q_append_frames(spark, sf):
    cust = T(spark, sf, "customer")
    return append(cust, cust.select(*reversed(cust.columns)))


def q_full_reload_silver(spark, sf):
    mapping = ColumnMapping.from_frame(mapping_frame(spark, A.LINEITEM_MAPPING), "LINEITEM")
    snap = silver_load(A.bronze_lineitem(spark, sf), mapping, A.LINEITEM_KEYS, A.RUN_ID,
                       A.RUN_TS, full_load=True, target_schema=A.silver_lineitem_schema())
    path = scratch_path(spark, "silver-reload")
    lines = T(spark, sf, "lineitem")                # what the reload replaces
    other = with_audit(lines.select(lines.l_orderkey.alias("ORDER_KEY"),
                                    lines.l_linenumber.alias("LINE_NUMBER")),
                       A.PREV_RUN_ID, A.PREV_RUN_TS)
    write_table(conform_to_schema(other, A.silver_lineitem_schema(), missing="null"), path)
    write_table(snap, path)
    return spark.read.parquet(path)


def q_full_reload_gold(spark, sf):
    path = scratch_path(spark, "gold-reload")
    other = A.appointments(spark, sf).select(       # what the reload replaces
        F.lit(0).alias("APPOINTMENT_DATA_KEY"), "YARD_NAME",
        F.col("SALES_ORDER_TICKET_ID").alias("SALES_ORDER_ID"), "CARRIER_NAME")
    write_table(full_reload(other, A.PREV_RUN_ID, A.PREV_RUN_TS, GOLD_DIM_APPOINTMENT), path)
    dim = dim_appointment(A.appointments(spark, sf), A.PREV_RUN_ID, A.PREV_RUN_TS)
    write_table(full_reload(dim.drop(*AUDIT_COLUMNS), A.RUN_ID, A.RUN_TS, GOLD_DIM_APPOINTMENT),
                path)
    return spark.read.parquet(path)


def q_upsert_silver(spark, sf):
    return upsert(A.orders_snapshot(spark, sf), A.orders_batch(spark, sf), "CUST_KEY, ORDER_KEY",
                  A.RUN_ID, A.RUN_TS)


def q_upsert_gold(spark, sf):
    target = A.orders_snapshot(spark, sf).drop("NOTE")
    return upsert(target, A.orders_batch(spark, sf), "ORDER_KEY", A.RUN_ID, A.RUN_TS)


def q_upsert_partitioned(spark, sf):
    path = scratch_path(spark, "orders-by-year")
    write_table(A.orders_snapshot(spark, sf, by_year=True), path, partition_by="ORDER_YEAR")
    upsert_partitioned(spark, path, A.orders_batch(spark, sf, by_year=True), "ORDER_KEY",
                       "ORDER_YEAR", A.RUN_ID, A.RUN_TS)
    return spark.read.parquet(path)


def q_upsert_by_file(spark, sf):
    path = scratch_path(spark, "orders-by-file")
    write_clustered(A.orders_snapshot(spark, sf).drop("NOTE"), path, "ORDER_KEY", 16)
    upsert_by_file(spark, path, A.orders_batch(spark, sf), "ORDER_KEY", A.RUN_ID, A.RUN_TS)
    return spark.read.parquet(path)


def q_upsert_newest(spark, sf):
    # the newer delivery first, then the older one, which comes late, then both again
    # deliveries are stored files, read as often as they come
    versions = _stored(spark, A.line_versions(spark, sf), "newest-deliveries", "NEWER")
    late, early = (versions.filter(F.col("NEWER") == n).drop("NEWER") for n in (False, True))
    schema = versioned(A.silver_lineitem_schema())
    table = conform_to_schema(full_reload(early, A.PREV_RUN_ID, A.PREV_RUN_TS), schema,
                              missing="null")
    for k, delivery in enumerate((late, early, late)):
        path = scratch_path(spark, f"newest-{k}")
        write_table(table, path)
        table = upsert(spark.read.parquet(path), delivery, A.LINEITEM_KEYS, A.RUN_ID, A.RUN_TS,
                       newest_by=VERSION_COLUMN, materialize_source=False)
    return table


def q_load_metrics(spark, sf):
    snap = upsert(A.orders_snapshot(spark, sf), A.orders_batch(spark, sf), "CUST_KEY, ORDER_KEY",
                  A.RUN_ID, A.RUN_TS, with_action=True)
    return upsert_counts(snap)


def q_incremental_ingest(spark, sf):
    src = A.write_landing(spark, sf, "ingest-src")
    base = scratch_path(spark, "ingest")
    args = dict(source_dir=src, table_path=f"{base}/table", checkpoint_path=f"{base}/ckpt",
                archive_dir=f"{base}/archive", target_schema=A.BRONZE_ORDERS,
                run_id=A.RUN_ID, run_ts=A.RUN_TS)
    incremental_ingest(spark, **args)
    incremental_ingest(spark, **args)               # a rerun loads nothing twice
    return read_ingested(spark, f"{base}/table")


def q_evolve_add_column(spark, sf):
    return add_column_at(T(spark, sf, "orders"), "YARD_KEY", "int", after="o_custkey")


# ---------------------------------------------------------------- projections
def q_normalize_headers(spark, sf):
    return normalize_headers(scan_csv(spark, A.write_landing(spark, sf, "landing-headers")))


def q_conform_lenient(spark, sf):
    o = T(spark, sf, "orders")
    text = o.select(o.o_orderkey.cast("string").alias("O_ORDERKEY"),
                    o.o_custkey.cast("string").alias("O_CUSTKEY"),
                    o.o_orderstatus.alias("O_ORDERSTATUS"),
                    o.o_totalprice.cast("string").alias("O_TOTALPRICE"),
                    o.o_orderdate.cast("string").alias("O_ORDERDATE"),
                    o.o_orderpriority.alias("EXTRA_COLUMN"))
    target = StructType([StructField("o_orderkey", LongType()),
                         StructField("o_orderstatus", StringType()),
                         StructField("o_totalprice", DoubleType()),
                         StructField("o_orderdate", TimestampNTZType()),
                         StructField("o_custkey", LongType())])
    return conform_to_schema(text, target)


def q_conform_strict(spark, sf):
    o = T(spark, sf, "orders")
    src = o.select(F.when(o.o_orderstatus == "P", F.concat(o.o_orderkey.cast("string"), F.lit("x")))
                   .otherwise(o.o_orderkey.cast("string")).alias("O_ORDERKEY"),
                   o.o_totalprice.alias("O_TOTALPRICE"), o.o_orderdate.alias("O_ORDERDATE"),
                   o.o_orderstatus.alias("O_ORDERSTATUS"), o.o_custkey.alias("DROPPED"))
    target = StructType([StructField("O_ORDERKEY", IntegerType()),
                         StructField("O_TOTALPRICE", FloatType()),
                         StructField("O_ORDERDATE", DateType()),
                         StructField("O_ORDERSTATUS", StringType())])
    return conform_to_schema(src, target, on_error="null")


def q_project_to_target(spark, sf):
    return project_to_target(T(spark, sf, "lineitem"),
                             ["L_ORDERKEY", "l_linenumber", "L_SHIPDATE", "NOT_IN_SOURCE"])


def q_rename_by_mapping(spark, sf):
    return rename_by_mapping(T(spark, sf, "orders"), {
        "o_orderstatus": "o_orderpriority", "o_orderpriority": "o_orderstatus",
        "O_ORDERKEY": "ORDER_KEY", "not_a_column": "IGNORED"})


def q_fill_nulls_by_mapping(spark, sf):
    li = T(spark, sf, "lineitem")
    df = li.select(li.l_orderkey, li.l_linenumber,
                   F.nullif(li.l_returnflag, F.lit("N")).alias("RETURN_FLAG"),
                   F.nullif(li.l_linestatus, F.lit("O")).alias("LINE_STATUS"),
                   F.nullif(li.l_tax, F.lit(0.0)).alias("TAX"))
    rows = [("tpch", "LINEITEM", "L_RETURNFLAG", "RETURN_FLAG", "string", "U"),
            ("tpch", "LINEITEM", "L_LINESTATUS", "LINE_STATUS", "string", "X"),
            ("tpch", "LINEITEM", "L_TAX", "TAX", "double", "0.01"),
            ("tpch", "LINEITEM", "L_ORDERKEY", "ORDER_KEY", "bigint", None)]
    mapping = ColumnMapping.from_frame(mapping_frame(spark, rows), "LINEITEM")
    return fill_nulls(df, mapping.defaults)


def _orders_text(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(
        F.when(o.o_orderstatus == "P", F.concat(o.o_orderkey.cast("string"), F.lit("x")))
        .otherwise(o.o_orderkey.cast("string")).alias("ORDER_KEY"),
        A.date_text(o.o_orderdate).alias("ORDER_DATE"),
        o.o_totalprice.cast("decimal(12,2)").cast("string").alias("TOTAL_PRICE"),
        o.o_orderstatus.alias("ORDER_STATUS"))


def q_cast_by_mapping(spark, sf):
    rows = [("tpch", "ORDERS", "O_ORDERKEY", "ORDER_KEY", "bigint", None),
            ("tpch", "ORDERS", "O_ORDERDATE", "ORDER_DATE", "date", None),
            ("tpch", "ORDERS", "O_TOTALPRICE", "TOTAL_PRICE", "decimal(12,2)", None),
            ("tpch", "ORDERS", "O_ORDERSTATUS", "ORDER_STATUS", "string", None),
            ("tpch", "ORDERS", "O_MISSING", "NOT_PRESENT", "int", None)]
    mapping = ColumnMapping.from_frame(mapping_frame(spark, rows), "ORDERS")
    return cast_by_mapping(_orders_text(spark, sf), mapping.types)


def q_add_audit_columns(spark, sf):
    return with_audit(T(spark, sf, "orders"), A.RUN_ID, A.RUN_TS)


def q_select_alias(spark, sf):
    return select_alias(T(spark, sf, "orders"), [("o_orderkey", "SALES_ORDER_ID"),
                                                 ("o_orderpriority", "CARRIER_NAME"),
                                                 ("o_orderstatus", "STATUS")])


def q_select_side_star(spark, sf):
    s = T(spark, sf, "lineitem").alias("s")
    o = T(spark, sf, "orders").alias("o")
    return s.join(o, F.col("s.l_orderkey") == F.col("o.o_orderkey"), "inner") \
        .select("s.*", "o.o_orderdate")


# ---------------------------------------------------------------- filters
def q_filter_equals(spark, sf):
    return T(spark, sf, "orders").filter(F.col("o_orderstatus") == F.lit("F"))


def q_filter_not_null_and_equals(spark, sf):
    o = T(spark, sf, "orders").withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return o.filter(F.col("o_orderpriority").isNotNull() & (F.col("o_orderstatus") == "O"))


def q_filter_case_insensitive(spark, sf):
    return T(spark, sf, "orders").filter(
        (F.lower(F.col("o_orderstatus")) == F.lower(F.lit("f")))
        & (F.lower(F.col("o_orderpriority")) == F.lower(F.lit("1-urgent"))))


def q_filter_active(spark, sf):
    c = T(spark, sf, "customer")
    flagged = c.withColumn("IS_RUN", F.when(c.c_acctbal > 0, F.lit(1)).otherwise(F.lit(0)))
    return filter_active(flagged)


# ---------------------------------------------------------------- joins
def q_left_join_fanout(spark, sf):
    o = T(spark, sf, "orders")
    # all lines but those of each seventh order, which stays unmatched
    lines = T(spark, sf, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_orderkey") % 7 != 3, F.col("l_orderkey")))
    return left_join_fanout(o, lines, ["o_orderkey"], ["l_orderkey"],
                            ["l_linenumber", "l_quantity"])


def q_left_join_unique(spark, sf):
    c = T(spark, sf, "customer")
    o = T(spark, sf, "orders")
    return left_join_unique(c, o, ["c_custkey"], ["o_custkey"], ["o_orderdate", "o_orderkey"])


def _bucketed(spark, df, label, keys):
    path = scratch_path(spark, label)
    name = "strata_" + path.rsplit("/", 1)[1].replace("-", "_")
    return name, path, write_bucketed(df, name, path, keys, 8)


def q_merge_bucketed(spark, sf):
    name, path, _ = _bucketed(spark, A.orders_snapshot(spark, sf).drop("NOTE"), "orders-buckets",
                              "ORDER_KEY")
    return merge_bucketed(spark, name, A.orders_batch(spark, sf), "ORDER_KEY", A.RUN_ID, A.RUN_TS,
                          into=(f"{name}_next", f"{path}-next"))


def q_left_join_bucketed(spark, sf):
    orders = T(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    name, _, _ = _bucketed(spark, orders, "orders-by-customer", "o_custkey")
    return left_join_bucketed(T(spark, sf, "customer"), name, ["c_custkey"], ["o_custkey"],
                              ["o_orderdate", "o_orderkey"])


def q_merge_join_composite(spark, sf):
    return upsert_actions(A.orders_snapshot(spark, sf), A.orders_batch(spark, sf),
                          "CUST_KEY, ORDER_KEY")


# ---------------------------------------------------------------- dedupe
def q_dedupe_any(spark, sf):
    # which row of a key stays is open, so each is checked to be a whole row of the input
    lines = T(spark, sf, "lineitem")
    one = dedupe_any(lines, ["l_orderkey", "l_linenumber"])
    rows = lines.distinct().withColumn("is_input_row", F.lit(True))
    same = reduce(lambda a, b: a & b, [one[c].eqNullSafe(rows[c]) for c in lines.columns])
    return one.join(rows, same, "left").select(one["l_orderkey"], one["l_linenumber"],
                                               "is_input_row")


def q_dedupe_latest(spark, sf):
    return dedupe_latest(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                         order_by=["l_shipdate"])


# ---------------------------------------------------------------- keys, sorts
def q_surrogate_key_dim(spark, sf):
    return surrogate_key(A.appointments(spark, sf), ["YARD_NAME"], "APPOINTMENT_DATA_KEY")


def _sales_joined(spark, sf):
    dim = surrogate_key(select_alias(A.appointments(spark, sf), [
        "YARD_NAME", ("SALES_ORDER_TICKET_ID", "SALES_ORDER_ID"), "CARRIER_NAME"]),
        ["YARD_NAME"], "APPOINTMENT_DATA_KEY")
    return left_join_unique(A.sales(spark, sf), dim, ["YARD"], ["YARD_NAME"],
                            ["APPOINTMENT_DATA_KEY"])


def q_surrogate_key_fact(spark, sf):
    return surrogate_key(_sales_joined(spark, sf), ["YARD_ID", "YARD_KEY", "COMMODITY_NAME"],
                         "SALES_KEY")


def q_surrogate_key_scalable(spark, sf):
    return surrogate_key(T(spark, sf, "lineitem"), ["l_shipdate"], "LINE_KEY", key_type="bigint")


def q_surrogate_key_stable(spark, sf):
    cust = T(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    previous = surrogate_key(cust.filter(F.col("c_mktsegment") != "MACHINERY"), ["c_name"],
                             "CUSTOMER_KEY")
    return stable_keys(cust, previous, ["c_custkey"], "CUSTOMER_KEY", ["c_name"])


def q_sort_by(spark, sf):
    return T(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey")


def q_first_row(spark, sf):
    return T(spark, sf, "orders").orderBy(F.col("o_orderdate").desc(),
                                          F.col("o_orderkey").desc()).limit(1)


# ---------------------------------------------------------------- scalar functions
def q_parse_date_ladder(spark, sf):
    o = T(spark, sf, "orders")
    text = A.date_text(o.o_orderdate)
    return o.select(o.o_orderkey, text.alias("date_text"),
                    parse_date_ladder(text).alias("parsed_date"))


def zoned_text(ts):
    """Event time as zoned text: UTC ``Z`` for clicks (with a ``[UTC]`` name),
    New York offset otherwise (with ``[America/New_York]`` for views)."""
    et = F.col("event_type")
    ny = F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SS"),
                  F.lit("-05:00"))
    utc = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SS"), F.lit("Z"))
    return (F.when(et == "click", F.concat(utc, F.lit("[UTC]")))
            .when(et == "view", F.concat(ny, F.lit("[America/New_York]")))
            .otherwise(ny))


def q_parse_zoned_timestamp(spark, sf):
    e = T(spark, sf, "events")
    text = zoned_text(e.ts)
    return e.select(e.event_id, text.alias("ts_text"),
                    parse_zoned_timestamp(text, ntz=True).alias("parsed_ts"))


def q_try_cast_by_type(spark, sf):
    li = T(spark, sf, "lineitem")
    num_text = F.when(li.l_returnflag == "R", F.concat(li.l_linenumber.cast("string"), F.lit(".7"))) \
        .otherwise(F.concat(F.lit(" "), li.l_linenumber.cast("string"), F.lit(" ")))
    return li.select(li.l_orderkey, li.l_linenumber,
                     try_cast_by_type(num_text, "int").alias("as_int"),
                     try_cast_by_type(li.l_extendedprice.cast("string"), "decimal(12,2)")
                     .alias("as_decimal"),
                     try_cast_by_type(li.l_linestatus, "boolean").alias("as_boolean"))


def q_fn_coalesce(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(o.o_orderkey, F.coalesce(F.nullif(o.o_orderpriority, F.lit("5-LOW")),
                                             o.o_orderstatus).alias("v"))


def q_fn_regexp_replace(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(o.o_orderkey, F.regexp_replace(o.o_orderpriority, "[^A-Z]+", "_").alias("v"))


def q_fn_cast(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(cast_to(o.o_orderkey, "int").alias("k"),
                    cast_to(o.o_totalprice, "float").alias("price"),
                    cast_to(o.o_orderdate, "date").alias("d"))


def q_fn_lower(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(o.o_orderkey, F.lower(o.o_orderpriority).alias("v"))


def q_fn_lit(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(o.o_orderkey, F.lit(A.RUN_ID).alias("run_id"), F.lit(1).alias("one"))


def q_fn_current_timestamp(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(o.o_orderkey,
                    (F.current_timestamp() > F.lit("2020-01-01").cast("timestamp"))
                    .alias("after_2020"))


def _predicates(spark, sf):
    o = T(spark, sf, "orders")
    return o, F.nullif(o.o_orderpriority, F.lit("5-LOW"))


def q_fn_is_not_null(spark, sf):
    o, p = _predicates(spark, sf)
    return o.select(o.o_orderkey, p.isNotNull().alias("v"))


def q_fn_and(spark, sf):
    o, p = _predicates(spark, sf)
    return o.select(o.o_orderkey, (p.isNotNull() & (o.o_orderstatus == "O")).alias("v"))


def q_fn_equals(spark, sf):
    o, _ = _predicates(spark, sf)
    return o.select(o.o_orderkey, (o.o_orderstatus == F.lit("O")).alias("v"))


# ---------------------------------------------------------------- composed products
def q_bronze_load(spark, sf):
    folder = A.write_landing(spark, sf, "bronze-landing", variants=True)
    path = scratch_path(spark, "bronze")
    write_table(bronze_load(spark, folder, A.BRONZE_ORDERS, A.RUN_ID, A.RUN_TS), path,
                mode="append")
    return spark.read.parquet(path)


def q_silver_load(spark, sf):
    mapping = ColumnMapping.from_frame(mapping_frame(spark, A.LINEITEM_MAPPING), "LINEITEM")
    schema = A.silver_lineitem_schema()
    previous = silver_load(A.bronze_lineitem(spark, sf, date_before=A.OLD_BEFORE), mapping,
                           A.LINEITEM_KEYS, A.PREV_RUN_ID, A.PREV_RUN_TS, full_load=True,
                           target_schema=schema)
    # the previous run's silver table, as stored by that run
    stored = scratch_path(spark, "silver-previous")
    write_table(previous, stored)
    previous = spark.read.parquet(stored)
    return silver_load(A.bronze_lineitem(spark, sf, date_from=A.NEW_FROM), mapping,
                       A.LINEITEM_KEYS, A.RUN_ID, A.RUN_TS, target=previous)


class _Lost(Exception):
    """A delivery whose merge was done, but not committed."""


def q_silver_incremental(spark, sf):
    # three deliveries, the newest first; the second one's merge is lost and done again
    base = scratch_path(spark, "silver-stream")
    mapping = ColumnMapping.from_frame(mapping_frame(spark, A.LINEITEM_MAPPING), "LINEITEM")
    bronze = A.bronze_lineitem(spark, sf)
    schema = versioned(A.silver_lineitem_schema())

    def run(on_batch=None):
        incremental_silver(spark, f"{base}/bronze", bronze.schema, f"{base}/silver", schema,
                           f"{base}/checkpoint", mapping, A.LINEITEM_KEYS, "RETURN_FLAG",
                           A.RUN_ID, A.RUN_TS, on_batch=on_batch)

    def lose(batch_id, partitions):
        raise _Lost

    for k, days in enumerate(((A.NEW_FROM, None), (A.MIDDLE_FROM, A.NEW_FROM),
                              (None, A.MIDDLE_FROM))):
        (A.bronze_lineitem(spark, sf, *days).withColumn(BATCH_COLUMN, F.lit(k))
         .write.mode("append").partitionBy(BATCH_COLUMN).parquet(f"{base}/bronze"))
        if k == 1:
            try:
                run(lose)
            except StreamingQueryException:
                pass
        run()
    return read_silver(spark, f"{base}/silver", schema)


def q_dim_appointment(spark, sf):
    return dim_appointment(A.appointments(spark, sf), A.RUN_ID, A.RUN_TS)


def _with_copies(appointments):
    """Urgent appointments twice: exact copies are rows of their own."""
    return appointments.unionByName(appointments.filter(F.col("CARRIER_NAME") == "1-URGENT"))


def _stored(spark, df, label, partition_by=None):
    path = scratch_path(spark, label)
    write_table(df, path, partition_by=partition_by)
    return spark.read.parquet(path)


def q_dim_appointment_incremental(spark, sf):
    # appointments before the batch's first day have vanished from the source
    previous = dim_appointment(_with_copies(A.appointments(spark, sf, date_before=A.OLD_BEFORE)),
                               A.PREV_RUN_ID, A.PREV_RUN_TS)
    return dim_appointment(_with_copies(A.appointments(spark, sf, date_from=A.NEW_FROM)),
                           A.RUN_ID, A.RUN_TS, existing=_stored(spark, previous, "gold-dim"))


def q_fact_sales_incremental(spark, sf):
    dim = _stored(spark, dim_appointment(A.appointments(spark, sf), A.PREV_RUN_ID, A.PREV_RUN_TS),
                  "gold-dim")
    previous = fact_sales(A.sales(spark, sf, date_before=A.OLD_BEFORE), dim, A.PREV_RUN_ID,
                          A.PREV_RUN_TS)
    return fact_sales(A.sales(spark, sf, date_from=A.NEW_FROM), dim, A.RUN_ID, A.RUN_TS,
                      existing=_stored(spark, previous, "gold-fact"))


def q_fact_sales_delta(spark, sf):
    # low-priority appointments leave the dimension: some yards get another key
    old = _stored(spark, dim_appointment(A.appointments(spark, sf), A.PREV_RUN_ID, A.PREV_RUN_TS),
                  "gold-dim")
    sales = A.sales(spark, sf)
    fact = _stored(spark, fact_sales(sales, old, A.PREV_RUN_ID, A.PREV_RUN_TS), "gold-fact")
    return fact_sales_delta(sales, fact, old, old.where("CARRIER_NAME <> '5-LOW'"), A.RUN_ID,
                            A.RUN_TS)


def q_fact_sales(spark, sf):
    # the dimension is loaded first and the fact reads the stored table
    dim_path = scratch_path(spark, "gold-dim")
    write_table(dim_appointment(A.appointments(spark, sf), A.RUN_ID, A.RUN_TS), dim_path)
    return fact_sales(A.sales(spark, sf), spark.read.parquet(dim_path), A.RUN_ID, A.RUN_TS)


QUERIES: dict[str, Query] = {
    # sources
    "table_scan": q_table_scan,
    "sql_view_scan": q_sql_view_scan,
    "csv_scan_strings": q_csv_scan_strings,
    "csv_scan_inferred": q_csv_scan_inferred,
    "csv_folder_scan": q_csv_folder_scan,
    "csv_infer_types": q_csv_infer_types,
    # sinks
    "append_load": q_append_load,
    "append_frames": q_append_frames,
    "full_reload_silver": q_full_reload_silver,
    "full_reload_gold": q_full_reload_gold,
    "upsert_silver": q_upsert_silver,
    "upsert_gold": q_upsert_gold,
    "upsert_partitioned": q_upsert_partitioned,
    "upsert_by_file": q_upsert_by_file,
    "upsert_newest": q_upsert_newest,
    "load_metrics": q_load_metrics,
    "incremental_ingest": q_incremental_ingest,
    "evolve_add_column": q_evolve_add_column,
    # projections
    "normalize_headers": q_normalize_headers,
    "conform_lenient": q_conform_lenient,
    "conform_strict": q_conform_strict,
    "project_to_target": q_project_to_target,
    "rename_by_mapping": q_rename_by_mapping,
    "fill_nulls_by_mapping": q_fill_nulls_by_mapping,
    "cast_by_mapping": q_cast_by_mapping,
    "add_audit_columns": q_add_audit_columns,
    "select_alias": q_select_alias,
    "select_side_star": q_select_side_star,
    # filters
    "filter_equals": q_filter_equals,
    "filter_not_null_and_equals": q_filter_not_null_and_equals,
    "filter_case_insensitive": q_filter_case_insensitive,
    "filter_active": q_filter_active,
    # joins
    "left_join_fanout": q_left_join_fanout,
    "left_join_unique": q_left_join_unique,
    "left_join_bucketed": q_left_join_bucketed,
    "merge_bucketed": q_merge_bucketed,
    "merge_join_composite": q_merge_join_composite,
    # dedupe
    "dedupe_any": q_dedupe_any,
    "dedupe_latest": q_dedupe_latest,
    # keys, sorts, limits
    "surrogate_key_dim": q_surrogate_key_dim,
    "surrogate_key_fact": q_surrogate_key_fact,
    "surrogate_key_scalable": q_surrogate_key_scalable,
    "surrogate_key_stable": q_surrogate_key_stable,
    "sort_by": q_sort_by,
    "first_row": q_first_row,
    # scalar functions
    "parse_date_ladder": q_parse_date_ladder,
    "parse_zoned_timestamp": q_parse_zoned_timestamp,
    "try_cast_by_type": q_try_cast_by_type,
    "fn_coalesce": q_fn_coalesce,
    "fn_regexp_replace": q_fn_regexp_replace,
    "fn_cast": q_fn_cast,
    "fn_lower": q_fn_lower,
    "fn_lit": q_fn_lit,
    "fn_current_timestamp": q_fn_current_timestamp,
    "fn_is_not_null": q_fn_is_not_null,
    "fn_and": q_fn_and,
    "fn_equals": q_fn_equals,
    # composed products
    "bronze_load": q_bronze_load,
    "silver_load": q_silver_load,
    "silver_incremental": q_silver_incremental,
    "dim_appointment": q_dim_appointment,
    "fact_sales": q_fact_sales,
    "dim_appointment_incremental": q_dim_appointment_incremental,
    "fact_sales_incremental": q_fact_sales_incremental,
    "fact_sales_delta": q_fact_sales_delta,
}
