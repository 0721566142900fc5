"""End to end on the driver's test data: landing CSV -> bronze -> silver -> gold.

Usage: python examples/layers_demo.py [sf_dir]

Every table is written to a new folder below the shared checkpoint folder;
counts and load metrics are printed. The landing files are the orders
analogue (raw headers, dates in several formats); silver keeps the newest row
per order and is then upserted with a second delivery; gold builds the
appointment dimension (stable keys across two runs) and the sales fact.
"""

from __future__ import annotations

import os
import sys
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fixtures import analogues as A  # noqa: E402
from strata.mapping import ColumnMapping, mapping_frame  # noqa: E402
from strata.operators import upsert, upsert_counts, write_table  # noqa: E402
from strata.plans import dim_appointment, fact_sales, silver_load  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402
from strata.streaming import incremental_ingest, read_ingested  # noqa: E402

ORDER_MAPPING = [
    ("erp", "ORDERS", "ORDER_KEY", "ORDER_ID", "bigint", None),
    ("erp", "ORDERS", "CUST_KEY", "CUSTOMER_ID", "bigint", None),
    ("erp", "ORDERS", "ORDER_STATUS", "STATUS", "string", None),
    ("erp", "ORDERS", "ORDER_DATE", "ORDER_DATE", "date", None),
    ("erp", "ORDERS", "TOTAL_PRICE", "TOTAL", "decimal(12,2)", None),
    ("erp", "ORDERS", "ORDER_PRIORITY", "PRIORITY", "string", "5-LOW"),
]


def main(sf_dir: str) -> None:
    spark = build_session()
    base = scratch_path(spark, "layers-demo")
    run1, run2 = ("run-1", datetime(2024, 1, 1)), ("run-2", datetime(2024, 2, 1))

    # bronze: load the landing folder once (a rerun adds nothing)
    landing = A.write_landing(spark, sf_dir, "demo-landing", variants=False)
    args = dict(source_dir=landing, table_path=f"{base}/bronze", checkpoint_path=f"{base}/ckpt",
                archive_dir=f"{base}/archive", target_schema=A.BRONZE_ORDERS, run_id=run1[0])
    print("bronze ingest", incremental_ingest(spark, **args), incremental_ingest(spark, **args))
    bronze = read_ingested(spark, f"{base}/bronze")

    # silver: rename, fill, cast by metadata, newest row per order, full load
    mapping = ColumnMapping.from_frame(mapping_frame(spark, ORDER_MAPPING), "ORDERS")
    silver = silver_load(bronze, mapping, "ORDER_ID", *run1, full_load=True)
    print("silver v1 rows", write_table(silver, f"{base}/silver_v1"))

    # a second delivery: the same orders, finished ones re-sent as 'F'
    redelivery = (spark.read.parquet(f"{base}/silver_v1").filter(F.col("STATUS") == "O")
                  .withColumn("STATUS", F.lit("F")).drop("ADDED_BY", "ADDED_ON",
                                                        "MODIFIED_BY", "MODIFIED_ON"))
    snap = upsert(spark.read.parquet(f"{base}/silver_v1"), redelivery, "ORDER_ID", *run2,
                  with_action=True)
    write_table(snap, f"{base}/silver_v2")
    upsert_counts(spark.read.parquet(f"{base}/silver_v2")).show()

    # gold: dimension (keys kept stable on the second run) and fact
    dim1 = dim_appointment(A.appointments(spark, sf_dir), *run1)
    print("dim v1 rows", write_table(dim1, f"{base}/dim_v1"))
    dim2 = dim_appointment(A.appointments(spark, sf_dir), *run2,
                           existing=spark.read.parquet(f"{base}/dim_v1"))
    print("dim v2 rows", write_table(dim2, f"{base}/dim_v2"))
    fact = fact_sales(A.sales(spark, sf_dir), spark.read.parquet(f"{base}/dim_v2"), *run2)
    print("fact rows", write_table(fact, f"{base}/fact"))
    print("tables under", base)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
