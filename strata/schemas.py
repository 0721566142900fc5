"""Layer table schemas of the sales and appointments domain (bronze, silver, gold).

Fixed values: the column names and types below are those of the layer tables
the library reproduces; they must stay exactly as written, in this order.
"""

from __future__ import annotations

from pyspark.sql.types import (FloatType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

AUDIT_COLUMNS = ("ADDED_BY", "ADDED_ON", "MODIFIED_BY", "MODIFIED_ON")

# Bronze sales business columns, in table order.
SALES_COLUMNS = (
    "YARD_ID", "YARD", "MATERIAL_NAME", "MATERIAL_CODE", "COMMODITY_NAME",
    "COMMODITY_TYPE", "OUTBOUND_TICKET_ID", "LATEST_SHIP_DATE",
    "LATEST_PAYMENT_DATE", "INVOICE_ISSUE_DATE", "INVOICE_STATUS",
    "INVOICE_NOTES", "CUSTOMER_NAME", "SALES_ORDER_ID", "OUTBOUND_TICKET_STATUS",
    "INVOICE_ID", "TAX_RATE", "CONSUMER_GROSS", "CONSUMER_TARE",
    "CONSUMER_NET_WEIGHT", "UM", "PRICE", "SELL_PRICE", "INVOICE_SUBTOTAL",
    "INVOICE_TOTAL", "INVOICE_FREIGHT_TOTAL", "AMOUNT_PAID",
    "PAYMENT_ADJUSTMENTS", "INVOICE_GRAND_TOTAL", "INVOICE_BALANCE_REMAINING",
    "COST_OF_GOODS_SOLD", "GROSS_MARGIN_DOLLAR", "MARGIN_PERCENTAGE",
    "NET_WEIGHT_SOLD", "WEIGHT_DIFFERENTIAL", "CURRENCY", "ACCOUNT_MANAGER",
    "CONVERTED_TOTAL", "IS_EXPORT", "MILL_SCALE_NUMBER",
)

# Bronze appointment business columns, in table order.
APPOINTMENT_COLUMNS = (
    "YARD_NAME", "APPOINTMENT_NUMBER", "APPOINTMENT_TITLE", "REFERENCE_TYPE",
    "SALES_ORDER_TICKET_ID", "PURCHASE_ORDER_TICKET_ID", "INBOUND_TICKET_ID",
    "OUTBOUND_TICKET_ID", "CUSTOMER_ID", "CUSTOMER_NAME", "CARRIER_NAME",
    "DRIVER_NAME", "ORDER_FULFILLED", "APPOINTMENT_STATUS", "SCHEDULED_START",
    "SCHEDULED_END", "SHIPMENT_TYPE", "VESSEL", "SHIPPING_LINE_NAME",
    "FORWARDER_NVOCC", "ESTIMATED_TIME_OF_ARRIVAL", "ESTIMATED_TIME_OF_DEPARTURE",
    "EARLIEST_RETURN_DATE", "DOCUMENTATION_CUTOFF_DEADLINE",
    "CARGO_CUTOFF_DEADLINE", "EXPORT_REFERENCE_NUMBER", "CONTAINER_TYPE",
    "NUMBER_OF_CONTAINERS", "VOYAGE", "SCHEDULED_DURATION_HOURS",
    "APPOINTMENT_DATE", "DAY_OF_WEEK", "IS_FUTURE", "IS_ACTIVE", "CREATED_AT",
    "CREATED_BY", "CREATED_BY_EMAIL", "UPDATED_AT", "UPDATED_BY",
    "UPDATED_BY_EMAIL",
)


def _strings(names) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


_ADDED = [StructField("ADDED_BY", StringType(), True),
          StructField("ADDED_ON", TimestampType(), True)]
_MODIFIED = [StructField("MODIFIED_BY", StringType(), True),
             StructField("MODIFIED_ON", TimestampType(), True)]

BRONZE_SALES = StructType(_strings(SALES_COLUMNS) + _ADDED)
BRONZE_APPOINTMENTS = StructType(_strings(APPOINTMENT_COLUMNS) + _ADDED)

SILVER_SALES = StructType(
    [StructField("YARD_ID", StringType(), True), StructField("YARD_KEY", IntegerType(), True)]
    + _strings(SALES_COLUMNS[1:]) + _ADDED + _MODIFIED)
SILVER_APPOINTMENTS = StructType(
    _strings(c for c in APPOINTMENT_COLUMNS if c != "CUSTOMER_NAME") + _ADDED + _MODIFIED)

GOLD_DIM_APPOINTMENT = StructType(
    [StructField("APPOINTMENT_DATA_KEY", IntegerType(), True)]
    + _strings(("YARD_NAME", "SALES_ORDER_ID", "CARRIER_NAME")) + _ADDED + _MODIFIED)

GOLD_FACT_SALES = StructType([
    StructField("SALES_KEY", IntegerType(), True),
    StructField("YARD_ID", StringType(), True),
    StructField("YARD_KEY", IntegerType(), True),
    StructField("APPOINTMENT_DATA_KEY", IntegerType(), True),
    StructField("COMMODITY_NAME", StringType(), True),
    StructField("PRICE", FloatType(), True),
    StructField("SELL_PRICE", FloatType(), True),
    StructField("INVOICE_TOTAL", FloatType(), True),
] + _ADDED + _MODIFIED)

#: Silver column with the bronze load time of the stored version of a row. A silver table
#: that has it never lets an older delivery overwrite a newer row.
VERSION_COLUMN = "SOURCE_ADDED_ON"


def versioned(schema: StructType) -> StructType:
    """``schema`` with the version column before the audit columns at its end."""
    first = next((i for i, f in enumerate(schema.fields) if f.name in AUDIT_COLUMNS),
                 len(schema.fields))
    return StructType([*schema.fields[:first],
                       StructField(VERSION_COLUMN, TimestampType(), True),
                       *schema.fields[first:]])


# Metadata tables: only the fields the jobs read are known; types are ours.
OBJECT_CONFIG = StructType(_strings((
    "OBJECT_NAME", "SOURCE_NAME", "BRONZE_TABLE_NAME", "SILVER_TABLE_NAME",
    "OPERATION_TYPE", "KEY_COLUMN_NAME")) + [
    StructField("IS_FULL_LOAD", IntegerType(), True),
    StructField("IS_RUN", IntegerType(), True)] + _strings((
        "SOURCE_FILE_PATH", "SOURCE_FILE_NAME", "ARCHIVE_PATH")))

COLUMN_MAPPING = StructType(_strings((
    "SOURCE_NAME", "OBJECT_NAME", "SOURCE_COLUMN_NAME", "TARGET_COLUMN_NAME",
    "COLUMN_DATATYPE", "VALUES")))
