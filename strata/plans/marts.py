"""Silver -> gold: the appointment dimension and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.operators.conform import conform_to_schema, select_alias, with_audit
from strata.operators.joins import broadcast_if_small, left_join_fanout, left_join_unique
from strata.operators.keys import high_water, stable_keys, surrogate_key
from strata.operators.load import upsert
from strata.schemas import AUDIT_COLUMNS, GOLD_DIM_APPOINTMENT, GOLD_FACT_SALES


def _keyed_schema(schema: StructType, key_type: str) -> StructType:
    """The gold schema with its surrogate keys of ``key_type``."""
    if key_type.strip().lower() in ("int", "integer"):
        return schema
    return StructType([StructField(f.name, LongType(), f.nullable)
                       if f.name in ("APPOINTMENT_DATA_KEY", "SALES_KEY") else f
                       for f in schema.fields])


def _upsert_keyed(rows: DataFrame, existing: DataFrame, schema: StructType, key: str,
                  natural_keys, order_by, key_type: str, run_id: str, run_ts,
                  on_error: str, last_key: int | None = None) -> DataFrame:
    """``existing`` with ``rows`` upserted under stable keys: a row found there by its natural
    keys (one to one, NULL-safe) keeps its key and ``ADDED_*``, other rows get new keys, and
    rows that vanished stay as they are."""
    attributes = StructType([f for f in schema.fields if f.name not in (key, *AUDIT_COLUMNS)])
    # fitted first, so both sides are compared in the stored types
    batch = conform_to_schema(rows, attributes, on_error=on_error)
    keyed = stable_keys(batch, existing.select(*natural_keys, key), natural_keys, key, order_by,
                        key_type=key_type, keep_vanished=False, last_key=last_key)
    return conform_to_schema(upsert(existing, keyed, key, run_id, run_ts), schema,
                             on_error=on_error)


def dim_appointment(appointments: DataFrame, run_id: str, run_ts=None,
                    on_error: str = "fail", existing: DataFrame | None = None,
                    key_type: str = "int", unique_by=None,
                    last_key: int | None = None) -> DataFrame:
    """One row per appointment: yard, sales order, carrier; a dense key in
    yard order (ties broken by the other columns); audit; strict fit.

    With ``existing`` (the current dimension), rows already there keep their
    key and ``ADDED_*`` (matched one to one on all three attributes,
    NULL-safe), rows that vanished from the source stay unchanged, and new rows
    are numbered from its largest key + 1, so keys stay stable across runs. Pass the rows that
    are new or may have changed: what is shuffled follows them, while ``existing`` is
    only read (and its largest key, unless ``last_key`` says it). ``key_type="bigint"`` is for more
    than 2**31-1 rows; ``unique_by`` as in :func:`surrogate_key`.
    """
    dim = select_alias(appointments, ["YARD_NAME", ("SALES_ORDER_TICKET_ID", "SALES_ORDER_ID"),
                                      "CARRIER_NAME"])
    schema = _keyed_schema(GOLD_DIM_APPOINTMENT, key_type)
    if existing is not None:
        return _upsert_keyed(dim, existing, schema, "APPOINTMENT_DATA_KEY",
                             ["YARD_NAME", "SALES_ORDER_ID", "CARRIER_NAME"], ["YARD_NAME"],
                             key_type, run_id, run_ts, on_error, last_key)
    dim = surrogate_key(dim, ["YARD_NAME"], "APPOINTMENT_DATA_KEY", key_type=key_type,
                        unique_by=unique_by)
    return conform_to_schema(with_audit(dim, run_id, run_ts), schema, on_error=on_error)


def fact_sales(sales: DataFrame, dimension: DataFrame, run_id: str, run_ts=None,
               lookup: str = "unique", on_error: str = "fail", key_type: str = "int",
               unique_by=None, existing: DataFrame | None = None,
               last_key: int | None = None) -> DataFrame:
    """Sales with the appointment key of their yard, a dense sales key in
    ``YARD_ID, YARD_KEY, COMMODITY_NAME`` order (ties broken by the other
    columns), audit, strict fit (``YARD`` is dropped).

    ``lookup="unique"`` takes one dimension row per yard (the smallest key),
    so sales never multiply; ``"fanout"`` joins every appointment of the yard,
    as a plain left join on a non-unique dimension would: its output has the
    product of a yard's sales and appointments, so it is for small yards only.
    ``key_type`` and ``unique_by`` as in :func:`dim_appointment`. With
    ``existing`` (the current fact) the sales are upserted into it: one found
    there (all attributes but the appointment key equal, one to one) keeps its
    sales key, others get new ones, and sales no longer in the source stay; the
    work follows ``sales``, and ``last_key`` is as in :func:`dim_appointment`.
    """
    s = select_alias(sales, ["YARD_ID", "YARD_KEY", "COMMODITY_NAME", "PRICE", "SELL_PRICE",
                             "INVOICE_TOTAL", "YARD"])
    if lookup == "unique":
        joined = left_join_unique(s, dimension, ["YARD"], ["YARD_NAME"], ["APPOINTMENT_DATA_KEY"])
    elif lookup == "fanout":
        joined = left_join_fanout(s, dimension, ["YARD"], ["YARD_NAME"], ["APPOINTMENT_DATA_KEY"])
    else:
        raise ValueError("lookup must be 'unique' or 'fanout'")
    order = ["YARD_ID", "YARD_KEY", "COMMODITY_NAME"]
    schema = _keyed_schema(GOLD_FACT_SALES, key_type)
    if existing is not None:
        return _upsert_keyed(joined, existing, schema, "SALES_KEY",
                             [*order, "PRICE", "SELL_PRICE", "INVOICE_TOTAL"], order,
                             key_type, run_id, run_ts, on_error, last_key)
    keyed = surrogate_key(joined, order, "SALES_KEY", key_type=key_type, unique_by=unique_by)
    return conform_to_schema(with_audit(keyed, run_id, run_ts), schema, on_error=on_error)


def _lookup(dimension: DataFrame, name: str) -> DataFrame:
    """The appointment key that a yard's sales get: the smallest, as ``left_join_unique`` picks it."""
    key = F.col("APPOINTMENT_DATA_KEY")
    first = F.when(F.count(F.lit(1)) > F.count(key), F.lit(None)).otherwise(F.min(key))
    return (dimension.where("YARD_NAME IS NOT NULL").groupBy(F.col("YARD_NAME").alias("__yard"))
            .agg(first.alias(name)))


def fact_sales_delta(sales: DataFrame, existing: DataFrame, old_dimension: DataFrame,
                     new_dimension: DataFrame, run_id: str, run_ts=None, on_error: str = "fail",
                     key_type: str = "int") -> DataFrame:
    """The fact after the dimension has changed, without computing it anew.

    ``existing`` was made from ``sales`` with ``old_dimension``. Only yards whose
    lookup value differs between the two dimensions matter: a join of the two
    lookups, one row per yard, finds them. Their sales alone are read on from
    there (by partition, if ``sales`` is partitioned by yard), found in the fact
    by their attributes and the old value, one to one, and updated with the new
    one; all other rows, and all sales keys, stay. Equal to ``fact_sales`` with the
    new dimension but for the keys and audit columns it would give anew.
    """
    both = _lookup(old_dimension, "__old").join(_lookup(new_dimension, "__new"), "__yard",
                                                "full_outer")
    changed = broadcast_if_small(both.where(~F.col("__old").eqNullSafe(F.col("__new"))))
    attributes = ["YARD_ID", "YARD_KEY", "COMMODITY_NAME", "PRICE", "SELL_PRICE", "INVOICE_TOTAL"]
    rows = select_alias(sales, [*attributes, "YARD"]).join(
        changed, F.col("YARD") == F.col("__yard")).select(
        *attributes, F.col("__old").alias("APPOINTMENT_DATA_KEY"), "__new")
    schema = _keyed_schema(GOLD_FACT_SALES, key_type)
    stored = [f for f in schema.fields if f.name not in ("SALES_KEY", *AUDIT_COLUMNS)]
    batch = conform_to_schema(rows, StructType(
        [*stored, StructField("__new", schema["APPOINTMENT_DATA_KEY"].dataType)]), on_error=on_error)
    natural = [f.name for f in stored]
    # only rows with one of the old values can be found
    old = conform_to_schema(changed.select(F.col("__old").alias("APPOINTMENT_DATA_KEY")), StructType(
        [schema["APPOINTMENT_DATA_KEY"]]), on_error=on_error).toDF("__was")
    known = existing.select(*natural, "SALES_KEY").join(
        old, F.col("APPOINTMENT_DATA_KEY").eqNullSafe(F.col("__was")), "left_semi")
    keyed = stable_keys(batch, known, natural, "SALES_KEY", attributes, key_type=key_type,
                        keep_vanished=False, last_key=high_water(existing, "SALES_KEY"))
    moved = keyed.withColumn("APPOINTMENT_DATA_KEY", F.col("__new")).drop("__new")
    return conform_to_schema(upsert(existing, moved, "SALES_KEY", run_id, run_ts), schema,
                             on_error=on_error)
