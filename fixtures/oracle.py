"""Independent DuckDB SQL for each registered query (same column names).

Written from the intended semantics, not from the Spark code: keys are
``row_number()`` over the same total order, upserts are anti join + join +
anti join, dedupes are ``QUALIFY``, parsed values are compared with the
original typed values they were formatted from.
"""

from __future__ import annotations

from fixtures import analogues as A

RUN = f"'{A.RUN_ID}'"
RUN_TS = f"TIMESTAMP '{A.RUN_TS:%Y-%m-%d %H:%M:%S}'"
PREV = f"'{A.PREV_RUN_ID}'"
PREV_TS = f"TIMESTAMP '{A.PREV_RUN_TS:%Y-%m-%d %H:%M:%S}'"
AUDIT_RUN = f"{RUN} AS ADDED_BY, {RUN_TS} AS ADDED_ON, {RUN} AS MODIFIED_BY, {RUN_TS} AS MODIFIED_ON"

DATE_TEXT = """CASE o_orderkey % 5
        WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
        WHEN 1 THEN strftime(o_orderdate, '%m-%d-%Y')
        WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
        ELSE strftime(o_orderdate, '%Y/%m/%d') END"""


def _landing(names) -> str:
    vals = ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus",
            DATE_TEXT, "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)",
            "NULLIF(o_orderpriority, '5-LOW')"]
    return "SELECT " + ",\n  ".join(f'{v} AS "{n}"' for v, n in zip(vals, names)) + "\nFROM orders"


LANDING_RAW = _landing(A.LANDING_HEADERS)
LANDING_NORMALIZED = _landing(A.BRONZE_ORDER_COLUMNS)

APPOINTMENTS = """SELECT n.n_name AS YARD_NAME, CAST(o.o_orderkey AS VARCHAR) AS SALES_ORDER_ID,
         o.o_orderpriority AS CARRIER_NAME
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey"""

DIM = f"""dim AS (SELECT *, row_number() OVER (ORDER BY YARD_NAME NULLS FIRST,
         SALES_ORDER_ID NULLS FIRST, CARRIER_NAME NULLS FIRST) AS APPOINTMENT_DATA_KEY
  FROM ({APPOINTMENTS}))"""

SALES = f"""SELECT CAST(l.l_suppkey AS VARCHAR) AS YARD_ID, su.s_nationkey AS YARD_KEY,
         NULLIF(n.n_name, '{A.NULL_YARD}') AS YARD, CAST(l.l_partkey AS VARCHAR) AS COMMODITY_NAME,
         l.l_extendedprice AS PRICE, l.l_extendedprice * (1 - l.l_discount) AS SELL_PRICE,
         l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS INVOICE_TOTAL
  FROM lineitem l JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation n ON su.s_nationkey = n.n_nationkey"""

SALES_JOINED = f"""{DIM},
one AS (SELECT YARD_NAME, CAST(min(APPOINTMENT_DATA_KEY) AS INTEGER) AS APPOINTMENT_DATA_KEY
  FROM dim WHERE YARD_NAME IS NOT NULL GROUP BY YARD_NAME),
s AS ({SALES}),
j AS (SELECT s.*, one.APPOINTMENT_DATA_KEY FROM s LEFT JOIN one ON s.YARD = one.YARD_NAME)"""

SALES_ORDER = """ORDER BY YARD_ID NULLS FIRST, YARD_KEY NULLS FIRST, COMMODITY_NAME NULLS FIRST,
  PRICE NULLS FIRST, SELL_PRICE NULLS FIRST, INVOICE_TOTAL NULLS FIRST, YARD NULLS FIRST,
  APPOINTMENT_DATA_KEY NULLS FIRST"""

ORDERS_T = f"""t AS (SELECT o_orderkey AS ORDER_KEY, NULLIF(o_custkey, 0) AS CUST_KEY,
    o_orderstatus AS STATUS, o_orderpriority AS PRIORITY, o_totalprice AS TOTAL_PRICE,
    'v1-' || o_orderstatus AS NOTE
  FROM orders WHERE o_orderdate < TIMESTAMP '{A.OLD_BEFORE}')"""
ORDERS_S = f"""s AS (SELECT o_orderkey AS ORDER_KEY, NULLIF(o_custkey, 0) AS CUST_KEY,
    CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS STATUS,
    o_orderpriority AS PRIORITY, o_totalprice + 1 AS TOTAL_PRICE
  FROM orders WHERE o_orderdate >= TIMESTAMP '{A.NEW_FROM}')"""
COMPOSITE = "s.CUST_KEY = t.CUST_KEY AND s.ORDER_KEY = t.ORDER_KEY"

#: Orders upserted on the order key alone.
UPSERT_BY_ORDER = f"""WITH {ORDERS_T}, {ORDERS_S}
    SELECT t.ORDER_KEY, t.CUST_KEY, t.STATUS, t.PRIORITY, t.TOTAL_PRICE,
           {PREV} AS ADDED_BY, {PREV_TS} AS ADDED_ON, {PREV} AS MODIFIED_BY,
           {PREV_TS} AS MODIFIED_ON
      FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.ORDER_KEY = t.ORDER_KEY)
    UNION ALL
    SELECT s.*, {PREV}, {PREV_TS}, {RUN}, {RUN_TS}
      FROM s JOIN t ON s.ORDER_KEY = t.ORDER_KEY
    UNION ALL
    SELECT s.*, {RUN}, {RUN_TS}, {RUN}, {RUN_TS}
      FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE s.ORDER_KEY = t.ORDER_KEY)"""

BRONZE_LI = """b AS (SELECT l_orderkey AS ORDER_KEY, l_linenumber AS LINE_NUMBER,
    l_partkey AS PART_KEY, l_quantity AS QUANTITY,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS EXTENDED_PRICE,
    COALESCE(NULLIF(l_returnflag, 'N'), 'U') AS RETURN_FLAG,
    CAST(l_shipdate AS DATE) AS SHIP_DATE, 'bronze-0001' AS ADDED_BY,
    CAST(l_shipdate AS TIMESTAMP) AS ADDED_ON, l_shipdate AS SD
  FROM lineitem)"""
LATEST_LI = """QUALIFY row_number() OVER (PARTITION BY ORDER_KEY, LINE_NUMBER
    ORDER BY ADDED_ON DESC NULLS LAST, PART_KEY DESC NULLS LAST, QUANTITY DESC NULLS LAST,
    EXTENDED_PRICE DESC NULLS LAST, RETURN_FLAG DESC NULLS LAST, SHIP_DATE DESC NULLS LAST,
    ADDED_BY DESC NULLS LAST) = 1"""
LI_COLS = "ORDER_KEY, LINE_NUMBER, PART_KEY, QUANTITY, EXTENDED_PRICE, RETURN_FLAG, SHIP_DATE"


def _li_cols(alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in LI_COLS.split(","))


def _stable(previous: str, batch: str, columns: str, natural: list[str], key: str,
            order: str) -> str:
    """Rows of a table keyed by ``k``, upserted with a batch under stable keys (CTEs, then rows)."""
    same = " AND ".join(f"pn.{c} IS NOT DISTINCT FROM bn.{c}" for c in [*natural, "n"])
    by = f"PARTITION BY {', '.join(natural)}"
    cols = [c.strip() for c in columns.split(",")]
    new = ", ".join(f"coalesce(bn.{c}, pn.{c}) AS {c}" for c in cols)
    return f"""pn AS (SELECT *, row_number() OVER ({by} ORDER BY k) AS n FROM ({previous})),
        bn AS (SELECT *, row_number() OVER ({by}) AS n FROM ({batch}))
        SELECT CAST(k AS INTEGER) AS {key}, {new}, {PREV} AS ADDED_BY, {PREV_TS} AS ADDED_ON,
               CASE WHEN bn.n IS NULL THEN {PREV} ELSE {RUN} END AS MODIFIED_BY,
               CASE WHEN bn.n IS NULL THEN {PREV_TS} ELSE {RUN_TS} END AS MODIFIED_ON
          FROM pn LEFT JOIN bn ON {same}
        UNION ALL
        SELECT CAST((SELECT max(k) FROM pn) + row_number() OVER (ORDER BY {order}) AS INTEGER),
               {columns}, {RUN}, {RUN_TS}, {RUN}, {RUN_TS}
          FROM (SELECT bn.* FROM bn ANTI JOIN pn ON {same})"""


def _nulls_first(columns) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _copied(where: str) -> str:
    rows = f"SELECT * FROM ({APPOINTMENTS} WHERE o.o_orderdate {where})"
    return f"{rows} UNION ALL {rows} WHERE CARRIER_NAME = '1-URGENT'"


DIM_KEYS = ["YARD_NAME", "SALES_ORDER_ID", "CARRIER_NAME"]
DIM_INCREMENTAL = "WITH " + _stable(
    f"""SELECT *, row_number() OVER (ORDER BY {_nulls_first(DIM_KEYS)}) AS k
        FROM ({_copied(f"< TIMESTAMP '{A.OLD_BEFORE}'")})""",
    _copied(f">= TIMESTAMP '{A.NEW_FROM}'"), ", ".join(DIM_KEYS), DIM_KEYS,
    "APPOINTMENT_DATA_KEY", _nulls_first(DIM_KEYS))


def _fact(where: str) -> str:
    return f"""SELECT s.*, one.APPOINTMENT_DATA_KEY FROM ({SALES} WHERE l.l_shipdate {where}) s
        LEFT JOIN one ON s.YARD = one.YARD_NAME"""


FACT_KEYS = ["YARD_ID", "YARD_KEY", "COMMODITY_NAME", "PRICE", "SELL_PRICE", "INVOICE_TOTAL"]
FACT_GOLD = """YARD_ID, CAST(YARD_KEY AS INTEGER) AS YARD_KEY, APPOINTMENT_DATA_KEY, COMMODITY_NAME,
        CAST(PRICE AS FLOAT) AS PRICE, CAST(SELL_PRICE AS FLOAT) AS SELL_PRICE,
        CAST(INVOICE_TOTAL AS FLOAT) AS INVOICE_TOTAL"""
FACT_INCREMENTAL = f"""WITH {DIM},
        one AS (SELECT YARD_NAME, CAST(min(APPOINTMENT_DATA_KEY) AS INTEGER) AS APPOINTMENT_DATA_KEY
          FROM dim WHERE YARD_NAME IS NOT NULL GROUP BY YARD_NAME), """ + _stable(
    f"""SELECT {FACT_GOLD}, row_number() OVER ({SALES_ORDER}) AS k
        FROM ({_fact(f"< TIMESTAMP '{A.OLD_BEFORE}'")})""",
    f"""SELECT {FACT_GOLD} FROM ({_fact(f">= TIMESTAMP '{A.NEW_FROM}'")})""",
    "YARD_ID, YARD_KEY, APPOINTMENT_DATA_KEY, COMMODITY_NAME, PRICE, SELL_PRICE, INVOICE_TOTAL",
    FACT_KEYS, "SALES_KEY", _nulls_first([*FACT_KEYS[:3], "APPOINTMENT_DATA_KEY", *FACT_KEYS[3:]]))

ORDER_YEAR = "year(o_orderdate)"

ORACLE: dict[str, str] = {
    # sources
    "table_scan": "SELECT * FROM customer",
    "sql_view_scan": """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderpriority = '1-URGENT'""",
    "csv_scan_strings": LANDING_RAW,
    "csv_scan_inferred": f"""SELECT CAST(o_orderkey AS INTEGER) AS "Order Key",
        CAST(o_custkey AS INTEGER) AS "Cust-Key", o_orderstatus AS "order status",
        {DATE_TEXT} AS "Order Date",
        CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS "Total Price ($)",
        NULLIF(o_orderpriority, '5-LOW') AS "Order Priority" FROM orders""",
    "csv_folder_scan": LANDING_NORMALIZED,
    # sinks
    "csv_infer_types": f"""WITH landing AS ({LANDING_NORMALIZED}),
        texts AS (
          SELECT 'ORDER_KEY' AS c, ORDER_KEY AS v FROM landing
          UNION ALL SELECT 'CUST_KEY', CUST_KEY FROM landing
          UNION ALL SELECT 'ORDER_STATUS', ORDER_STATUS FROM landing
          UNION ALL SELECT 'ORDER_DATE', ORDER_DATE FROM landing
          UNION ALL SELECT 'TOTAL_PRICE', TOTAL_PRICE FROM landing
          UNION ALL SELECT 'ORDER_PRIORITY', ORDER_PRIORITY FROM landing
          UNION ALL SELECT 'QUANTITY', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
              || CASE WHEN l_returnflag = 'R' THEN '.250' ELSE '' END FROM lineitem
          UNION ALL SELECT 'TICKET', CAST(l_orderkey + CASE WHEN l_returnflag = 'R'
              THEN 4000000000 ELSE 2000000000 END AS VARCHAR) FROM lineitem
          UNION ALL SELECT 'PRICE', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
              || CASE WHEN l_returnflag = 'R' THEN 'e0' ELSE '' END FROM lineitem
          UNION ALL SELECT 'SHIPPED', CASE WHEN l_returnflag = 'R'
              THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(l_shipdate, '%Y-%m-%d') END FROM lineitem
          UNION ALL SELECT 'LATE', CASE WHEN l_returnflag = 'R' THEN upper(t) ELSE t END
            FROM (SELECT l_returnflag, CASE WHEN l_linenumber > 2 THEN 'true' ELSE 'false' END AS t
                  FROM lineitem)
          UNION ALL SELECT 'PART', CASE WHEN l_returnflag = 'R' THEN 'P-' ELSE '' END
              || CAST(l_partkey AS VARCHAR) FROM lineitem
          UNION ALL SELECT 'NOTHING', NULL FROM lineitem),
        counted AS (
          SELECT c AS column_name, count(v) AS n_values,
            count(*) FILTER (regexp_matches(v, '^[+-]?[0-9]+$')
              AND TRY_CAST(v AS INTEGER) IS NOT NULL) AS n_int,
            count(*) FILTER (regexp_matches(v, '^[+-]?[0-9]+$')
              AND TRY_CAST(v AS BIGINT) IS NOT NULL) AS n_bigint,
            count(*) FILTER (regexp_matches(v, '^[0-9]+([.][0-9]*)?$')) AS n_decimal,
            count(*) FILTER (regexp_matches(v, '^[0-9]+([.][0-9]*)?(e[0-9]+)?$')) AS n_double,
            count(*) FILTER (regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) AS n_date,
            count(*) FILTER (regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9:]{{8}})?$'))
              AS n_timestamp,
            count(*) FILTER (lower(v) IN ('true', 'false')) AS n_boolean,
            coalesce(max(length(ltrim(split_part(v, '.', 1), '0')))
              FILTER (regexp_matches(v, '^[0-9]+([.][0-9]*)?$')), 0) AS int_digits,
            coalesce(max(length(split_part(v, '.', 2)))
              FILTER (regexp_matches(v, '^[0-9]+([.][0-9]*)?$')), 0) AS fraction_digits
          FROM texts GROUP BY c)
        SELECT *, CASE WHEN n_values = 0 THEN 'string' WHEN n_int = n_values THEN 'int'
            WHEN n_bigint = n_values THEN 'bigint'
            WHEN n_decimal = n_values THEN 'decimal(' || CAST(int_digits + fraction_digits AS VARCHAR)
              || ',' || CAST(fraction_digits AS VARCHAR) || ')'
            WHEN n_double = n_values THEN 'double' WHEN n_date = n_values THEN 'date'
            WHEN n_timestamp = n_values THEN 'timestamp_ntz'
            WHEN n_boolean = n_values THEN 'boolean' ELSE 'string' END AS narrowest
        FROM counted""",
    "append_load": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "append_frames": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "full_reload_silver": f"""WITH {BRONZE_LI}
        SELECT {LI_COLS}, CAST(NULL AS VARCHAR) AS NOTE, {AUDIT_RUN} FROM b {LATEST_LI}""",
    "full_reload_gold": f"""WITH {DIM}
        SELECT CAST(APPOINTMENT_DATA_KEY AS INTEGER) AS APPOINTMENT_DATA_KEY, YARD_NAME,
        SALES_ORDER_ID, CARRIER_NAME, {AUDIT_RUN} FROM dim""",
    "upsert_silver": f"""WITH {ORDERS_T}, {ORDERS_S}
        SELECT t.*, {PREV} AS ADDED_BY, {PREV_TS} AS ADDED_ON, {PREV} AS MODIFIED_BY,
               {PREV_TS} AS MODIFIED_ON
          FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {COMPOSITE})
        UNION ALL
        SELECT s.ORDER_KEY, s.CUST_KEY, s.STATUS, s.PRIORITY, s.TOTAL_PRICE, t.NOTE,
               {PREV}, {PREV_TS}, {RUN}, {RUN_TS}
          FROM s JOIN t ON {COMPOSITE}
        UNION ALL
        SELECT s.*, CAST(NULL AS VARCHAR), {RUN}, {RUN_TS}, {RUN}, {RUN_TS}
          FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {COMPOSITE})""",
    "upsert_gold": UPSERT_BY_ORDER,
    "upsert_partitioned": f"""WITH
        t AS (SELECT o_orderkey AS ORDER_KEY, NULLIF(o_custkey, 0) AS CUST_KEY,
            o_orderstatus AS STATUS, o_orderpriority AS PRIORITY, o_totalprice AS TOTAL_PRICE,
            'v1-' || o_orderstatus AS NOTE, CAST({ORDER_YEAR} AS INTEGER) AS ORDER_YEAR
          FROM orders WHERE o_orderdate < TIMESTAMP '{A.OLD_BEFORE}'),
        s AS (SELECT o_orderkey AS ORDER_KEY, NULLIF(o_custkey, 0) AS CUST_KEY,
            CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS STATUS,
            o_orderpriority AS PRIORITY, o_totalprice + 1 AS TOTAL_PRICE,
            CAST(CASE WHEN o_orderstatus = 'P' THEN {A.PENDING_YEAR} ELSE {ORDER_YEAR} END
                 AS INTEGER) AS ORDER_YEAR
          FROM orders WHERE o_orderdate >= TIMESTAMP '{A.NEW_FROM}')
        SELECT t.*, {PREV} AS ADDED_BY, {PREV_TS} AS ADDED_ON, {PREV} AS MODIFIED_BY,
               {PREV_TS} AS MODIFIED_ON FROM t ANTI JOIN s ON s.ORDER_KEY = t.ORDER_KEY
        UNION ALL
        SELECT s.ORDER_KEY, s.CUST_KEY, s.STATUS, s.PRIORITY, s.TOTAL_PRICE, t.NOTE, s.ORDER_YEAR,
               CASE WHEN t.ORDER_KEY IS NULL THEN {RUN} ELSE {PREV} END,
               CASE WHEN t.ORDER_KEY IS NULL THEN {RUN_TS} ELSE {PREV_TS} END, {RUN}, {RUN_TS}
          FROM s LEFT JOIN t ON s.ORDER_KEY = t.ORDER_KEY""",
    "upsert_by_file": UPSERT_BY_ORDER,
    "upsert_newest": f"""SELECT ORDER_KEY, LINE_NUMBER, PART_KEY, QUANTITY, EXTENDED_PRICE,
          RETURN_FLAG, SHIP_DATE, CAST(NULL AS VARCHAR) AS NOTE, V AS SOURCE_ADDED_ON,
          {PREV} AS ADDED_BY, {PREV_TS} AS ADDED_ON, {PREV} AS MODIFIED_BY,
          {PREV_TS} AS MODIFIED_ON
        FROM (SELECT l_orderkey AS ORDER_KEY, l_linenumber AS LINE_NUMBER, l_partkey AS PART_KEY,
            l_quantity AS QUANTITY, CAST(l_extendedprice AS DECIMAL(12,2)) AS EXTENDED_PRICE,
            NULLIF(l_returnflag, 'N') AS RETURN_FLAG, CAST(l_shipdate AS DATE) AS SHIP_DATE,
            CAST(NULLIF(l_shipdate, TIMESTAMP '{A.UNDATED}') AS TIMESTAMP) AS V FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY ORDER_KEY, LINE_NUMBER
          ORDER BY V DESC NULLS LAST, PART_KEY DESC NULLS LAST, QUANTITY DESC NULLS LAST,
          EXTENDED_PRICE DESC NULLS LAST, RETURN_FLAG DESC NULLS LAST,
          SHIP_DATE DESC NULLS LAST) = 1""",
    "load_metrics": f"""WITH {ORDERS_T}, {ORDERS_S}
        SELECT 'kept' AS action, count(*) AS row_count
          FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {COMPOSITE})
        UNION ALL SELECT 'updated', count(*) FROM s JOIN t ON {COMPOSITE}
        UNION ALL SELECT 'inserted', count(*)
          FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {COMPOSITE})""",
    "incremental_ingest": f"""SELECT *, {RUN} AS ADDED_BY, {RUN_TS} AS ADDED_ON
        FROM ({LANDING_NORMALIZED})""",
    "evolve_add_column": """SELECT o_orderkey, o_custkey, CAST(NULL AS INTEGER) AS YARD_KEY,
        o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    # projections
    "normalize_headers": LANDING_NORMALIZED,
    "conform_lenient": """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_custkey
        FROM orders""",
    "conform_strict": """SELECT CASE WHEN o_orderstatus = 'P' THEN NULL
               ELSE CAST(o_orderkey AS INTEGER) END AS O_ORDERKEY,
        CAST(o_totalprice AS FLOAT) AS O_TOTALPRICE, CAST(o_orderdate AS DATE) AS O_ORDERDATE,
        o_orderstatus AS O_ORDERSTATUS FROM orders""",
    "project_to_target": "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem",
    "rename_by_mapping": """SELECT o_orderkey AS ORDER_KEY, o_custkey,
        o_orderstatus AS o_orderpriority, o_totalprice, o_orderdate,
        o_orderpriority AS o_orderstatus FROM orders""",
    "fill_nulls_by_mapping": """SELECT l_orderkey, l_linenumber,
        COALESCE(NULLIF(l_returnflag, 'N'), 'U') AS RETURN_FLAG,
        COALESCE(NULLIF(l_linestatus, 'O'), 'X') AS LINE_STATUS,
        COALESCE(NULLIF(l_tax, 0.0), 0.01) AS TAX FROM lineitem""",
    "cast_by_mapping": """SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END
            AS ORDER_KEY,
        CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ORDER_DATE,
        CAST(o_totalprice AS DECIMAL(12,2)) AS TOTAL_PRICE, o_orderstatus AS ORDER_STATUS
        FROM orders""",
    "add_audit_columns": f"SELECT *, {AUDIT_RUN} FROM orders",
    "select_alias": """SELECT o_orderkey AS SALES_ORDER_ID, o_orderpriority AS CARRIER_NAME,
        o_orderstatus AS STATUS FROM orders""",
    "select_side_star": """SELECT l.*, o.o_orderdate FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    # filters
    "filter_equals": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "filter_not_null_and_equals": """SELECT * FROM orders
        WHERE NULLIF(o_orderpriority, '5-LOW') IS NOT NULL AND o_orderstatus = 'O'""",
    "filter_case_insensitive": """SELECT * FROM orders
        WHERE lower(o_orderstatus) = lower('f') AND lower(o_orderpriority) = lower('1-urgent')""",
    "filter_active": """SELECT *, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS IS_RUN
        FROM customer WHERE c_acctbal > 0""",
    # joins
    "left_join_fanout": """SELECT o.*, l.l_linenumber, l.l_quantity FROM orders o
        LEFT JOIN lineitem l ON l.l_orderkey % 7 <> 3 AND o.o_orderkey = l.l_orderkey""",
    "left_join_bucketed": """SELECT c.*, o.o_orderdate, o.o_orderkey FROM customer c
        LEFT JOIN (SELECT o_custkey, o_orderdate, o_orderkey FROM orders
                   QUALIFY row_number() OVER (PARTITION BY o_custkey
                       ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) = 1) o
          ON c.c_custkey = o.o_custkey""",
    "merge_bucketed": UPSERT_BY_ORDER,
    "left_join_unique": """SELECT c.*, o.o_orderdate, o.o_orderkey FROM customer c
        LEFT JOIN (SELECT o_custkey, o_orderdate, o_orderkey FROM orders
                   QUALIFY row_number() OVER (PARTITION BY o_custkey
                       ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) = 1) o
          ON c.c_custkey = o.o_custkey""",
    "merge_join_composite": f"""WITH {ORDERS_T}, {ORDERS_S}
        SELECT t.CUST_KEY, t.ORDER_KEY, 'kept' AS action
          FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {COMPOSITE})
        UNION ALL SELECT s.CUST_KEY, s.ORDER_KEY, 'updated' FROM s JOIN t ON {COMPOSITE}
        UNION ALL SELECT s.CUST_KEY, s.ORDER_KEY, 'inserted'
          FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {COMPOSITE})""",
    # dedupe
    "dedupe_any": """SELECT DISTINCT l_orderkey, l_linenumber, true AS is_input_row
        FROM lineitem""",
    "dedupe_latest": """SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
        l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
        l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
        l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""",
    # keys, sorts, limits
    "surrogate_key_dim": f"""SELECT YARD_NAME, SALES_ORDER_ID AS SALES_ORDER_TICKET_ID,
        CARRIER_NAME, CAST(APPOINTMENT_DATA_KEY AS INTEGER) AS APPOINTMENT_DATA_KEY
        FROM (WITH {DIM} SELECT * FROM dim)""",
    "surrogate_key_fact": f"""WITH {SALES_JOINED}
        SELECT *, CAST(row_number() OVER ({SALES_ORDER}) AS INTEGER) AS SALES_KEY FROM j""",
    "surrogate_key_scalable": """SELECT *, row_number() OVER (ORDER BY l_shipdate NULLS FIRST,
        l_orderkey NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
        l_linenumber NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
        l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
        l_linestatus NULLS FIRST) AS LINE_KEY FROM lineitem""",
    "surrogate_key_stable": """WITH prev AS (SELECT c_custkey, row_number() OVER (
            ORDER BY c_name NULLS FIRST, c_custkey NULLS FIRST, c_mktsegment NULLS FIRST) AS k
          FROM customer WHERE c_mktsegment <> 'MACHINERY'),
        fresh AS (SELECT c_custkey, c_name, c_mktsegment FROM customer c
          WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.c_custkey = c.c_custkey))
        SELECT c.c_custkey, c.c_name, c.c_mktsegment, CAST(p.k AS INTEGER) AS CUSTOMER_KEY
          FROM customer c JOIN prev p ON c.c_custkey = p.c_custkey
        UNION ALL
        SELECT c_custkey, c_name, c_mktsegment,
               CAST((SELECT max(k) FROM prev) + row_number() OVER (ORDER BY c_name NULLS FIRST,
                    c_custkey NULLS FIRST, c_mktsegment NULLS FIRST) AS INTEGER)
          FROM fresh""",
    "sort_by": "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey",
    "first_row": "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
    # scalar functions
    "parse_date_ladder": f"""SELECT o_orderkey, {DATE_TEXT} AS date_text,
        CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed_date
        FROM orders""",
    "parse_zoned_timestamp": """SELECT event_id,
        CASE WHEN event_type = 'click'
               THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.') || substr(strftime(ts, '%f'), 1, 2)
                    || 'Z[UTC]'
             ELSE strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.')
                    || substr(strftime(ts, '%f'), 1, 2) || '-05:00'
                    || CASE WHEN event_type = 'view' THEN '[America/New_York]' ELSE '' END
        END AS ts_text,
        make_timestamp(epoch_us(ts) - epoch_us(ts) % 10000) AS parsed_ts
        FROM events""",
    "try_cast_by_type": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS as_int,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS as_decimal,
        CASE l_linestatus WHEN 'F' THEN false ELSE NULL END AS as_boolean FROM lineitem""",
    "fn_coalesce": """SELECT o_orderkey, COALESCE(NULLIF(o_orderpriority, '5-LOW'), o_orderstatus)
        AS v FROM orders""",
    "fn_regexp_replace": """SELECT o_orderkey, regexp_replace(o_orderpriority, '[^A-Z]+', '_', 'g')
        AS v FROM orders""",
    "fn_cast": """SELECT CAST(o_orderkey AS INTEGER) AS k, CAST(o_totalprice AS FLOAT) AS price,
        CAST(o_orderdate AS DATE) AS d FROM orders""",
    "fn_lower": "SELECT o_orderkey, lower(o_orderpriority) AS v FROM orders",
    "fn_lit": f"SELECT o_orderkey, {RUN} AS run_id, 1 AS one FROM orders",
    "fn_current_timestamp": "SELECT o_orderkey, true AS after_2020 FROM orders",
    "fn_is_not_null": """SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') IS NOT NULL AS v
        FROM orders""",
    "fn_and": """SELECT o_orderkey,
        (NULLIF(o_orderpriority, '5-LOW') IS NOT NULL AND o_orderstatus = 'O') AS v FROM orders""",
    "fn_equals": "SELECT o_orderkey, o_orderstatus = 'O' AS v FROM orders",
    # composed products
    "bronze_load": f"""SELECT *, {RUN} AS ADDED_BY, {RUN_TS} AS ADDED_ON
        FROM ({LANDING_NORMALIZED})""",
    "silver_load": f"""WITH {BRONZE_LI},
        old AS (SELECT * FROM b WHERE SD < TIMESTAMP '{A.OLD_BEFORE}' {LATEST_LI}),
        new AS (SELECT * FROM b WHERE SD >= TIMESTAMP '{A.NEW_FROM}' {LATEST_LI})
        SELECT {_li_cols('o')}, CAST(NULL AS VARCHAR) AS NOTE, {PREV} AS ADDED_BY,
               {PREV_TS} AS ADDED_ON, {PREV} AS MODIFIED_BY, {PREV_TS} AS MODIFIED_ON
          FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n
              WHERE n.ORDER_KEY = o.ORDER_KEY AND n.LINE_NUMBER = o.LINE_NUMBER)
        UNION ALL
        SELECT {_li_cols('n')}, CAST(NULL AS VARCHAR), {PREV}, {PREV_TS}, {RUN}, {RUN_TS}
          FROM new n JOIN old o ON n.ORDER_KEY = o.ORDER_KEY AND n.LINE_NUMBER = o.LINE_NUMBER
        UNION ALL
        SELECT {_li_cols('n')}, CAST(NULL AS VARCHAR), {RUN}, {RUN_TS}, {RUN}, {RUN_TS}
          FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o
              WHERE n.ORDER_KEY = o.ORDER_KEY AND n.LINE_NUMBER = o.LINE_NUMBER)""",
    "silver_incremental": f"""WITH {BRONZE_LI}
        SELECT {LI_COLS}, CAST(NULL AS VARCHAR) AS NOTE, SD AS SOURCE_ADDED_ON, {AUDIT_RUN}
        FROM (SELECT * FROM b {LATEST_LI})""",
    "dim_appointment": f"""WITH {DIM}
        SELECT CAST(APPOINTMENT_DATA_KEY AS INTEGER) AS APPOINTMENT_DATA_KEY, YARD_NAME,
        SALES_ORDER_ID, CARRIER_NAME, {AUDIT_RUN} FROM dim""",
    "dim_appointment_incremental": DIM_INCREMENTAL,
    "fact_sales_incremental": FACT_INCREMENTAL,
    "fact_sales_delta": f"""WITH {SALES_JOINED},
        later AS (SELECT YARD_NAME, CAST(min(APPOINTMENT_DATA_KEY) AS INTEGER) AS k
          FROM dim WHERE YARD_NAME IS NOT NULL AND CARRIER_NAME <> '5-LOW' GROUP BY YARD_NAME)
        SELECT CAST(row_number() OVER ({SALES_ORDER}) AS INTEGER) AS SALES_KEY, YARD_ID,
          CAST(YARD_KEY AS INTEGER) AS YARD_KEY, later.k AS APPOINTMENT_DATA_KEY, COMMODITY_NAME,
          CAST(PRICE AS FLOAT) AS PRICE, CAST(SELL_PRICE AS FLOAT) AS SELL_PRICE,
          CAST(INVOICE_TOTAL AS FLOAT) AS INVOICE_TOTAL, {PREV} AS ADDED_BY, {PREV_TS} AS ADDED_ON,
          CASE WHEN APPOINTMENT_DATA_KEY IS DISTINCT FROM later.k THEN {RUN} ELSE {PREV} END
            AS MODIFIED_BY,
          CASE WHEN APPOINTMENT_DATA_KEY IS DISTINCT FROM later.k THEN {RUN_TS} ELSE {PREV_TS} END
            AS MODIFIED_ON
        FROM j LEFT JOIN later ON j.YARD = later.YARD_NAME""",
    "fact_sales": f"""WITH {SALES_JOINED}
        SELECT CAST(row_number() OVER ({SALES_ORDER}) AS INTEGER) AS SALES_KEY, YARD_ID,
          CAST(YARD_KEY AS INTEGER) AS YARD_KEY, APPOINTMENT_DATA_KEY, COMMODITY_NAME,
          CAST(PRICE AS FLOAT) AS PRICE, CAST(SELL_PRICE AS FLOAT) AS SELL_PRICE,
          CAST(INVOICE_TOTAL AS FLOAT) AS INVOICE_TOTAL, {AUDIT_RUN}
        FROM j""",
}
