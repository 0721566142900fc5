"""Layer-shaped frames built from the driver's TPC-H-like tables.

The sales and appointment layer tables are not in the test data, so
every registered query runs the library's real operators on an analogue:

* appointments = orders x customer x nation: the customer's nation is the yard,
  the order is the sales-order ticket, the priority is the carrier;
* sales = lineitem x supplier x nation: the supplier is the yard id, its nation
  the yard (NULL for one nation, to exercise NULL lookup keys), the part is the
  commodity, prices from the line;
* landing files = orders written as CSV with raw, messy headers and dates in
  the ladder's formats.

All of them read the whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from strata.session import scratch_path

RUN_ID = "run-0002"
RUN_TS = datetime(2024, 6, 1, 12, 0, 0)
PREV_RUN_ID = "run-0001"
PREV_RUN_TS = datetime(2024, 1, 1, 0, 0, 0)
BRONZE_RUN_ID = "bronze-0001"

NULL_YARD = "NATION_7"
OLD_BEFORE = "1998-01-01"    # previous snapshot: rows dated before this day
PENDING_YEAR = 9999
UNDATED = "1996-03-13"       # versions of this day have no date
MIDDLE_FROM = "1994-06-01"   # second of three deliveries: from this day to NEW_FROM
NEW_FROM = "1997-01-01"      # new batch: rows dated from this day (one year overlaps)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dated(df: DataFrame, column: str, date_from: str | None, date_before: str | None) -> DataFrame:
    if date_from is not None:
        df = df.filter(df[column] >= F.lit(date_from).cast("timestamp_ntz"))
    if date_before is not None:
        df = df.filter(df[column] < F.lit(date_before).cast("timestamp_ntz"))
    return df


def appointments(spark: SparkSession, sf_dir: str, date_from: str | None = None,
                 date_before: str | None = None) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    o = _dated(o, "o_orderdate", date_from, date_before)
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .select(n.n_name.alias("YARD_NAME"),
                    o.o_orderkey.cast("string").alias("SALES_ORDER_TICKET_ID"),
                    o.o_orderpriority.alias("CARRIER_NAME")))


def sales(spark: SparkSession, sf_dir: str, date_from: str | None = None,
          date_before: str | None = None) -> DataFrame:
    li, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    li = _dated(li, "l_shipdate", date_from, date_before)
    net = li.l_extendedprice * (1 - li.l_discount)
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .join(n, s.s_nationkey == n.n_nationkey)
            .select(li.l_suppkey.cast("string").alias("YARD_ID"),
                    s.s_nationkey.alias("YARD_KEY"),
                    F.nullif(n.n_name, F.lit(NULL_YARD)).alias("YARD"),
                    li.l_partkey.cast("string").alias("COMMODITY_NAME"),
                    li.l_extendedprice.alias("PRICE"),
                    net.alias("SELL_PRICE"),
                    (net * (1 + li.l_tax)).alias("INVOICE_TOTAL")))


def date_text(c) -> "F.Column":
    """The order date written in one of five formats (four parse, the last
    matches no format), chosen by the order key."""
    k = F.col("o_orderkey") % 5
    return (F.when(k == 0, F.date_format(c, "M/d/yyyy"))
            .when(k == 1, F.date_format(c, "MM-dd-yyyy"))
            .when(k == 2, F.date_format(c, "yyyy-MM-dd"))
            .when(k == 3, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.date_format(c, "yyyy/MM/dd")))


LANDING_HEADERS = ("Order Key", "Cust-Key", "order status", "Order Date", "Total Price ($)",
                   "Order Priority")
LANDING_HEADERS_ALT = ("order_priority", "TOTAL PRICE", "order-date", "ORDER STATUS",
                       "cust key", "Order#Key")
BRONZE_ORDER_COLUMNS = ("ORDER_KEY", "CUST_KEY", "ORDER_STATUS", "ORDER_DATE", "TOTAL_PRICE",
                        "ORDER_PRIORITY")
BRONZE_ORDERS = StructType([StructField(c, StringType(), True) for c in BRONZE_ORDER_COLUMNS]
                           + [StructField("ADDED_BY", StringType(), True),
                              StructField("ADDED_ON", TimestampType(), True)])


def landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the text a landing CSV holds, under raw headers."""
    o = table(spark, sf_dir, "orders")
    vals = [o.o_orderkey.cast("string"), o.o_custkey.cast("string"), o.o_orderstatus,
            date_text(o.o_orderdate), o.o_totalprice.cast("decimal(12,2)").cast("string"),
            F.nullif(o.o_orderpriority, F.lit("5-LOW"))]
    return o.select([v.alias(h) for v, h in zip(vals, LANDING_HEADERS)])


def write_landing(spark: SparkSession, sf_dir: str, label: str, variants: bool = False) -> str:
    """Write the landing files to a new shared scratch folder; return it.

    With ``variants``, finished orders use the first header layout and the
    rest a reordered, differently spelled one, in the same folder.
    """
    path = scratch_path(spark, label)
    land = landing_orders(spark, sf_dir)
    if not variants:
        land.write.option("header", True).csv(path)
        return path
    status = F.col("`order status`")
    land.filter(status == "F").write.option("header", True).csv(path)
    alt = land.filter(status != "F").select(
        [F.col(f"`{h}`").alias(a) for h, a in zip(
            ("Order Priority", "Total Price ($)", "Order Date", "order status", "Cust-Key",
             "Order Key"), LANDING_HEADERS_ALT)])
    alt.write.mode("append").option("header", True).csv(path)
    return path


def write_typed_landing(spark: SparkSession, sf_dir: str, label: str) -> list[str]:
    """Lineitem as two deliveries of text: the first without returned lines, under narrower
    texts than the second; headers in other cases. The folders."""
    li = table(spark, sf_dir, "lineitem")
    ship, price = li.l_shipdate, li.l_extendedprice.cast("decimal(12,2)").cast("string")
    returned = li.l_returnflag == "R"
    first = li.where(~returned).select(
        li.l_quantity.cast("int").cast("string").alias("Quantity"),
        (li.l_orderkey + 2000000000).cast("string").alias("Ticket"),
        price.alias("Price"), F.date_format(ship, "yyyy-MM-dd").alias("Shipped"),
        (li.l_linenumber > 2).cast("string").alias("Late"),
        li.l_partkey.cast("string").alias("Part"),
        F.lit(None).cast("string").alias("Nothing"))
    second = li.where(returned).select(
        F.concat(li.l_quantity.cast("int").cast("string"), F.lit(".250")).alias("QUANTITY"),
        (li.l_orderkey + 4000000000).cast("string").alias("TICKET"),
        F.concat(price, F.lit("e0")).alias("PRICE"),
        F.date_format(ship, "yyyy-MM-dd HH:mm:ss").alias("SHIPPED"),
        F.upper((li.l_linenumber > 2).cast("string")).alias("LATE"),
        F.concat(F.lit("P-"), li.l_partkey.cast("string")).alias("PART"))
    paths = [scratch_path(spark, f"{label}-{k}") for k in (1, 2)]
    for df, path in zip((first, second), paths):
        df.write.option("header", True).csv(path)
    return paths


def bronze_lineitem(spark: SparkSession, sf_dir: str, date_from: str | None = None,
                    date_before: str | None = None) -> DataFrame:
    """Lineitem as a bronze table: every value text (dates as M/d/yyyy), return
    flag N as NULL, load time = ship date."""
    li = _dated(table(spark, sf_dir, "lineitem"), "l_shipdate", date_from, date_before)
    return li.select(
        li.l_orderkey.cast("string").alias("L_ORDERKEY"),
        li.l_linenumber.cast("string").alias("L_LINENUMBER"),
        li.l_partkey.cast("string").alias("L_PARTKEY"),
        li.l_quantity.cast("string").alias("L_QUANTITY"),
        li.l_extendedprice.cast("string").alias("L_EXTENDEDPRICE"),
        F.nullif(li.l_returnflag, F.lit("N")).alias("L_RETURNFLAG"),
        F.date_format(li.l_shipdate, "M/d/yyyy").alias("L_SHIPDATE"),
        F.lit(BRONZE_RUN_ID).alias("ADDED_BY"),
        li.l_shipdate.cast("timestamp").alias("ADDED_ON"))


# Column mapping of the lineitem analogue:
# (source, object, source column, target column, type, default)
LINEITEM_MAPPING = [
    ("tpch", "LINEITEM", "L_ORDERKEY", "ORDER_KEY", "bigint", None),
    ("tpch", "LINEITEM", "L_LINENUMBER", "LINE_NUMBER", "int", None),
    ("tpch", "LINEITEM", "L_PARTKEY", "PART_KEY", "bigint", None),
    ("tpch", "LINEITEM", "L_QUANTITY", "QUANTITY", "double", None),
    ("tpch", "LINEITEM", "L_EXTENDEDPRICE", "EXTENDED_PRICE", "decimal(12,2)", None),
    ("tpch", "LINEITEM", "L_RETURNFLAG", "RETURN_FLAG", "string", "U"),
    ("tpch", "LINEITEM", "L_SHIPDATE", "SHIP_DATE", "date", None),
    ("tpch", "ORDERS", "O_ORDERKEY", "ORDER_KEY", "bigint", None),
]
LINEITEM_KEYS = "ORDER_KEY, LINE_NUMBER"


def silver_lineitem_schema() -> StructType:
    from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, LongType)
    return StructType([
        StructField("ORDER_KEY", LongType(), True),
        StructField("LINE_NUMBER", IntegerType(), True),
        StructField("PART_KEY", LongType(), True),
        StructField("QUANTITY", DoubleType(), True),
        StructField("EXTENDED_PRICE", DecimalType(12, 2), True),
        StructField("RETURN_FLAG", StringType(), True),
        StructField("SHIP_DATE", DateType(), True),
        StructField("NOTE", StringType(), True),
        StructField("ADDED_BY", StringType(), True),
        StructField("ADDED_ON", TimestampType(), True),
        StructField("MODIFIED_BY", StringType(), True),
        StructField("MODIFIED_ON", TimestampType(), True),
    ])


def line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as versions of its keys, the version being the ship date: the newest row
    of each key (``NEWER``), and the oldest as a delivery of its own."""
    from strata.operators import dedupe_ends
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_KEY"), F.col("l_linenumber").alias("LINE_NUMBER"),
        F.col("l_partkey").alias("PART_KEY"), F.col("l_quantity").alias("QUANTITY"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("EXTENDED_PRICE"),
        F.nullif("l_returnflag", F.lit("N")).alias("RETURN_FLAG"),
        F.to_date("l_shipdate").alias("SHIP_DATE"),
        F.nullif(F.col("l_shipdate"), F.lit(UNDATED).cast("timestamp_ntz"))
        .cast("timestamp").alias("SOURCE_ADDED_ON"))
    return dedupe_ends(li, LINEITEM_KEYS, ["SOURCE_ADDED_ON"], flag="NEWER")


def orders_snapshot(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """Previous silver snapshot of orders (dated before OLD_BEFORE), with a
    target-only NOTE column, a NULL customer for customer 0, previous audit;
    ``by_year`` adds the year of the order, to partition by."""
    o = table(spark, sf_dir, "orders")
    o = o.filter(o.o_orderdate < F.lit(OLD_BEFORE).cast("timestamp_ntz"))
    ts = F.lit(PREV_RUN_TS).cast("timestamp")
    return o.select(
        o.o_orderkey.alias("ORDER_KEY"),
        F.nullif(o.o_custkey, F.lit(0)).alias("CUST_KEY"),
        o.o_orderstatus.alias("STATUS"),
        o.o_orderpriority.alias("PRIORITY"),
        o.o_totalprice.alias("TOTAL_PRICE"),
        F.concat(F.lit("v1-"), o.o_orderstatus).alias("NOTE"),
        F.lit(PREV_RUN_ID).alias("ADDED_BY"), ts.alias("ADDED_ON"),
        F.lit(PREV_RUN_ID).alias("MODIFIED_BY"), ts.alias("MODIFIED_ON"),
        *([F.year(o.o_orderdate).alias("ORDER_YEAR")] if by_year else []))


def orders_batch(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """New orders batch (dated from NEW_FROM) with changed values; with
    ``by_year`` orders in process move to the year PENDING_YEAR."""
    o = table(spark, sf_dir, "orders")
    o = o.filter(o.o_orderdate >= F.lit(NEW_FROM).cast("timestamp_ntz"))
    return o.select(
        o.o_orderkey.alias("ORDER_KEY"),
        F.nullif(o.o_custkey, F.lit(0)).alias("CUST_KEY"),
        F.when(o.o_orderstatus == "O", F.lit("F")).otherwise(o.o_orderstatus).alias("STATUS"),
        o.o_orderpriority.alias("PRIORITY"),
        (o.o_totalprice + 1).alias("TOTAL_PRICE"),
        *([F.when(o.o_orderstatus == "P", F.lit(PENDING_YEAR)).otherwise(F.year(o.o_orderdate))
           .alias("ORDER_YEAR")] if by_year else []))
