"""The registered queries in plain SQL, written independently of the plans.

Tables are read under their own names; column names match the queries.
"""

from __future__ import annotations

from tidemark.plans import scenario_sql

_EVENTS = "event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props"

_LATEST_LINE = """
    ORDER BY l_shipdate DESC NULLS LAST {prefer}, l_partkey DESC, l_suppkey DESC,
             l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
             l_returnflag DESC, l_linestatus DESC
"""
_LINE_COLUMNS = """
    l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
"""


def _latest_lines(source: str, prefer: str = "") -> str:
    return f"""
        SELECT * FROM {source}
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY l_orderkey, l_linenumber {_LATEST_LINE.format(prefer=prefer)}
        ) = 1
    """


_CORRECTED = f"""
    WITH current_lines AS ({_latest_lines("lineitem")}),
    returned AS (
        SELECT * REPLACE (CAST(0 AS DOUBLE) AS l_tax) FROM lineitem WHERE l_returnflag = 'R'
    ),
    batch AS ({_latest_lines("returned")}),
    merged AS (
        SELECT *, 0 AS side FROM current_lines
        UNION ALL BY NAME SELECT *, 1 AS side FROM batch
    )
    SELECT {_LINE_COLUMNS} FROM ({_latest_lines("merged", ", side DESC")})
"""

_FACT = """
    WITH products AS (
        SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_type
        FROM part WHERE p_retailprice > 0 AND p_type <> 'PROMO'
    ),
    fact AS (
        SELECT o_custkey AS customer_id,
               l_partkey AS product_id,
               l_orderkey * 10 + l_linenumber AS order_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount,
               p_name AS product_name,
               price AS unit_price,
               p_type AS product_category,
               split_part(c_name, '#', 1) AS customer_first_name,
               split_part(c_name, '#', 2) AS customer_last_name,
               c_name || CASE WHEN c_acctbal < -500 THEN '' ELSE '@example.com' END
                   AS customer_email,
               c_mktsegment AS customer_city,
               CAST(l_quantity AS INTEGER) * price AS net_sales,
               CAST(o_orderdate AS DATE) AS order_date
        FROM lineitem
        LEFT JOIN orders ON o_orderkey = l_orderkey
        LEFT JOIN products ON p_partkey = l_partkey
        LEFT JOIN customer ON c_custkey = o_custkey
    )
"""
_FACT_ROWS = """
    SELECT * REPLACE (
        CAST(total_amount AS DOUBLE) AS total_amount,
        CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(net_sales AS DOUBLE) AS net_sales
    ) FROM fact
"""
_DAILY_SALES = """
    SELECT order_date, product_category,
           CAST(SUM(net_sales) AS DOUBLE) AS total_revenue,
           COUNT(order_id) AS total_orders
    FROM fact GROUP BY order_date, product_category
"""

_CUSTOMER_FLAGS = """
    SELECT *,
        CASE WHEN c_custkey IS NULL THEN 'null_primary_key' END AS err_null_primary_key,
        CASE WHEN c_acctbal <= 0 OR c_acctbal IS NULL THEN 'no_credit' END AS err_no_credit,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')
             THEN 'unknown_segment' END AS err_unknown_segment
    FROM customer
"""
_PART_FLAGS = """
    SELECT *,
        CASE WHEN p_partkey IS NULL THEN 'null_primary_key' END AS err_null_primary_key,
        CASE WHEN p_retailprice <= 0 OR p_retailprice IS NULL THEN 'no_price' END AS err_no_price,
        CASE WHEN p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')
             THEN 'unknown_type' END AS err_unknown_type,
        CASE WHEN p_size > 45 THEN 'oversized' END AS err_oversized
    FROM part
"""
_LINE_BAD = "(l_quantity IS NULL OR l_quantity <= 0 OR (l_returnflag = 'R' AND l_tax = 0))"

_LINE_COUNTS = f"""
    SELECT COUNT(*) AS n,
           COUNT(*) FILTER (WHERE {_LINE_BAD}) AS bad,
           COUNT(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE NOT {_LINE_BAD}) AS kept,
           COUNT(*) FILTER (WHERE l_quantity IS NULL OR l_quantity <= 0) AS no_quantity,
           COUNT(*) FILTER (WHERE l_returnflag = 'R' AND l_tax = 0) AS untaxed_return
    FROM lineitem
"""


def _yield(kept: str, n: str) -> str:
    return f"ROUND(CAST({kept} * 10000.0 / {n} AS DECIMAL(18,6)), 0) / 100"


def _status(kept: str, n: str) -> str:
    return f"CASE WHEN {_yield(kept, n)} < 90 THEN 'FAILED_TOLERANCE' ELSE 'PROCEEDED' END"


def _breakdown(name: str, rules: tuple[str, ...], flags: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{rule}' AS rule, COUNT(err_{rule}) AS failures "
        f"FROM ({flags})"
        for rule in rules
    )


_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

ORACLE_SQL: dict[str, str] = {
    "incremental_extract": f"""
        SELECT {_EVENTS} FROM events
        WHERE ts > TIMESTAMP '2024-01-12 00:00:00' AND ts <= (SELECT MAX(ts) FROM events)
    """,
    "chunked_extract": f"""
        SELECT {_EVENTS} FROM events
        WHERE ts > TIMESTAMP '2024-01-12 00:00:00' AND ts <= (SELECT MAX(ts) FROM events)
    """,
    "bronze_roundtrip": f"SELECT {_EVENTS} FROM events",
    "source_preview": f"SELECT {_EVENTS} FROM events ORDER BY ts, event_id LIMIT 5",
    "watermark_high": "SELECT epoch_us(MAX(ts)) AS high_watermark_us FROM events",
    "watermark_default": """
        SELECT 'known' AS kind, COALESCE(MAX(o_orderkey), 0) AS value FROM orders
        UNION ALL
        SELECT 'unknown', COALESCE(MAX(o_orderkey) FILTER (WHERE o_orderkey < 0), 0) FROM orders
    """,
    "watermark_lookup": """
        SELECT name AS source_table, COALESCE(MAX(epoch_us(ts)), 0) AS low_watermark_us
        FROM (VALUES ('click'), ('purchase'), ('refund')) AS wanted(name)
        LEFT JOIN events ON event_type = name GROUP BY name
    """,
    "extract_late_rows": """
        SELECT event_type, COUNT(*) AS late_rows FROM events
        WHERE ts <= TIMESTAMP '2024-01-12 00:00:00' GROUP BY event_type
    """,
    "chunk_assignment": """
        SELECT event_id, (ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1) // 1000 + 1 AS chunk
        FROM events
    """,
    "watermark_upsert": """
        WITH stored AS (
            SELECT event_type, user_id, MAX(ts) AS mark, 'stored' AS status FROM events
            WHERE ts <= TIMESTAMP '2024-01-12 00:00:00' GROUP BY 1, 2
        ), incoming AS (
            SELECT event_type, user_id, MIN(ts) AS mark, 'incoming' AS status FROM events
            WHERE ts > TIMESTAMP '2024-01-12 00:00:00' GROUP BY 1, 2
        )
        SELECT event_type, user_id, epoch_us(mark) AS mark_us, status FROM incoming
        UNION ALL
        SELECT event_type, user_id, epoch_us(mark), status FROM stored s
        WHERE NOT EXISTS (
            SELECT 1 FROM incoming i
            WHERE i.event_type = s.event_type AND i.user_id = s.user_id
        )
    """,
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in _TABLES
    ),
    "schema_cast": """
        WITH typed AS (
            SELECT CAST(event_id AS INTEGER) AS event_id, epoch_us(ts) AS ts_us, value,
                   TRY_CAST(CASE WHEN event_type = 'error' THEN props
                            ELSE substr(props, 7, length(props) - 7) END AS INTEGER) AS code,
                   event_type
            FROM events
        )
        SELECT *, CASE WHEN code IS NULL THEN 'code' ELSE '' END AS cast_failed FROM typed
    """,
    "rule_tags": f"""
        SELECT c_custkey, err_null_primary_key, err_no_credit, err_unknown_segment,
               concat_ws(',', err_null_primary_key, err_no_credit, err_unknown_segment)
                   AS validation_errors,
               CASE WHEN err_null_primary_key IS NULL AND err_no_credit IS NULL
                     AND err_unknown_segment IS NULL THEN 1 ELSE 0 END AS is_valid
        FROM ({_CUSTOMER_FLAGS})
    """,
    "quarantine_rows": f"""
        SELECT *, concat_ws(',', err_null_primary_key, err_no_price, err_unknown_type,
                            err_oversized) AS validation_errors
        FROM ({_PART_FLAGS})
        WHERE coalesce(err_null_primary_key, err_no_price, err_unknown_type, err_oversized)
              IS NOT NULL
    """,
    "contract_rules": """
        WITH products AS (
            SELECT 'source_products' AS table_name,
                   CASE WHEN p_size <> 7 THEN p_partkey END AS row_key,
                   CASE WHEN p_size = 7 THEN 'null_primary_key' END AS r1,
                   CASE WHEN p_size = 1 OR p_retailprice <= 0 THEN 'negative_or_zero_price' END AS r2,
                   CASE WHEN p_size <> 5
                         AND p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')
                        THEN 'invalid_category_enum' END AS r3
            FROM part
        ), customers AS (
            SELECT 'source_customers' AS table_name, c_custkey AS row_key, NULL AS r1,
                   CASE WHEN c_acctbal < 500 THEN 'malformed_or_null_email' END AS r2, NULL AS r3
            FROM customer
        ), orders AS (
            SELECT 'source_orders' AS table_name, l_orderkey * 10 + l_linenumber AS row_key, NULL AS r1,
                   CASE WHEN l_linenumber = 7 OR l_quantity <= 0 THEN 'invalid_quantity' END AS r2,
                   CASE WHEN l_returnflag = 'R' AND l_tax = 0 AND l_extendedprice > 0
                        THEN 'negative_total_amount' END AS r3
            FROM lineitem
        )
        SELECT table_name, row_key, concat_ws(',', r1, r2, r3) AS validation_errors
        FROM (SELECT * FROM products UNION ALL SELECT * FROM customers UNION ALL SELECT * FROM orders)
        WHERE coalesce(r1, r2, r3) IS NOT NULL
    """,
    "clean_rows": """
        SELECT * FROM part
        WHERE p_partkey IS NOT NULL AND p_retailprice > 0 AND p_type <> 'PROMO' AND p_size <= 45
    """,
    "rule_breakdown": _breakdown(
        "customer", ("null_primary_key", "no_credit", "unknown_segment"), _CUSTOMER_FLAGS
    )
    + " UNION ALL "
    + _breakdown(
        "part", ("null_primary_key", "no_price", "unknown_type", "oversized"), _PART_FLAGS
    ),
    "quality_metrics": f"""
        SELECT 'r1' AS pipeline_run_id, 'lineitem' AS table_name,
               n AS input_records_extracted, kept AS clean_records_promoted,
               bad AS quarantined_records_isolated,
               n - bad - kept AS duplicate_records_purged,
               CAST({_yield("kept", "n")} AS DOUBLE) AS data_health_yield_percentage,
               no_quantity, untaxed_return,
               {_status("kept", "n")} AS execution_status
        FROM ({_LINE_COUNTS})
    """,
    "yield_gate": f"""
        WITH counts AS (
            SELECT 'lineitem' AS table_name, n, kept FROM ({_LINE_COUNTS})
            UNION ALL
            SELECT 'customer', COUNT(*), COUNT(*) FILTER (WHERE c_acctbal >= -500) FROM customer
            UNION ALL
            SELECT 'part', COUNT(*),
                   COUNT(*) FILTER (WHERE p_retailprice > 0 AND p_type <> 'PROMO' AND p_size <= 45)
            FROM part
        )
        SELECT table_name, CAST({_yield("kept", "n")} AS DOUBLE) AS yield_pct,
               {_status("kept", "n")} AS execution_status
        FROM counts
    """,
    "metrics_json": f"""
        WITH counts AS (
            SELECT COUNT(*) AS n,
                   COUNT(*) FILTER (WHERE coalesce(err_null_primary_key, err_no_credit,
                                                   err_unknown_segment) IS NULL) AS kept,
                   COUNT(err_null_primary_key) AS r1, COUNT(err_no_credit) AS r2,
                   COUNT(err_unknown_segment) AS r3
            FROM ({_CUSTOMER_FLAGS})
        )
        SELECT '{{"pipeline_run_id":"r1","table_name":"customer","metrics":{{'
            || '"input_records_extracted":' || n
            || ',"clean_records_promoted":' || kept
            || ',"quarantined_records_isolated":' || (n - kept)
            || ',"duplicate_records_purged":0,"data_health_yield_percentage":'
            || printf('%.2f', CAST({_yield("kept", "n")} AS DOUBLE))
            || '}},"failures_by_rule_breakdown":{{"null_primary_key":' || r1
            || ',"no_credit":' || r2 || ',"unknown_segment":' || r3
            || '}},"execution_status":"' || {_status("kept", "n")} || '"}}' AS payload
        FROM counts
    """,
    "dedup_latest": f"SELECT {_LINE_COLUMNS} FROM ({_latest_lines('lineitem')})",
    "union_by_name": """
        SELECT c_custkey AS id, c_name AS name FROM customer
        UNION ALL SELECT s_suppkey, s_name FROM supplier
    """,
    "silver_merge": f"SELECT {_LINE_COLUMNS} FROM ({_latest_lines('lineitem')})",
    "silver_merge_broadcast": _CORRECTED,
    "silver_merge_shuffled": _CORRECTED,
    "silver_merge_bucketed": _CORRECTED,
    "insert_if_absent": """
        SELECT * REPLACE (
            CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'NEW' END AS c_mktsegment
        ) FROM customer
    """,
    "append_new_keys": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "update_by_key": """
        WITH patches AS (
            SELECT l_partkey, MAX(l_extendedprice) AS price, CAST(COUNT(*) AS INTEGER) AS size
            FROM lineitem WHERE l_quantity = 50 GROUP BY l_partkey
        )
        SELECT p_partkey, p_name, p_brand, p_type,
               CASE WHEN l_partkey IS NULL THEN p_size ELSE size END AS p_size,
               CASE WHEN l_partkey IS NULL THEN p_retailprice ELSE price END AS p_retailprice
        FROM part LEFT JOIN patches ON l_partkey = p_partkey
    """,
    "next_keys": """
        SELECT (SELECT MAX(c_custkey) FROM customer) + ROW_NUMBER() OVER (ORDER BY s_suppkey)
                   AS new_key,
               s_suppkey, s_name
        FROM supplier
    """,
    "sample_keys": """
        SELECT p_partkey FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 25
    """,
    "streaming_by_watermark": f"""
        SELECT {_EVENTS} FROM (
            SELECT * FROM events WHERE ts IS NOT NULL
            QUALIFY ROW_NUMBER() OVER (
                PARTITION BY user_id ORDER BY ts DESC, event_id DESC
            ) = 1
        )
    """,
    "streaming_merge": f"""
        SELECT {_EVENTS} FROM (
            SELECT * FROM events
            QUALIFY ROW_NUMBER() OVER (
                PARTITION BY user_id ORDER BY ts DESC, event_id DESC
            ) = 1
        )
    """,
    "dim_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
               p_type AS product_category
        FROM part
    """,
    "dim_customers": """
        SELECT c_custkey AS customer_id,
               split_part(c_name, '#', 1) AS customer_first_name,
               split_part(c_name, '#', 2) AS customer_last_name,
               c_name || CASE WHEN c_acctbal < -500 THEN '' ELSE '@example.com' END
                   AS customer_email,
               c_mktsegment AS customer_city
        FROM customer
    """,
    "fact_orders": _FACT + _FACT_ROWS,
    "fact_orders_salted": _FACT + _FACT_ROWS,
    "daily_category_sales": _FACT + _DAILY_SALES,
    "daily_category_sales_presummed": _FACT + _DAILY_SALES,
    "revenue_total_amount": """
        SELECT CAST(o_orderdate AS DATE) AS order_date,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS total_revenue
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
    """,
    "distinct_orders": _FACT
    + """
        SELECT order_date, product_category, COUNT(DISTINCT order_id) AS total_orders
        FROM fact GROUP BY 1, 2
    """,
    "fact_by_date": _FACT
    + _FACT_ROWS
    + " WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'",
    "reconciliation_audit": _FACT
    + """
        , lines AS (
            SELECT l_orderkey * 10 + l_linenumber AS order_id, l_partkey AS product_id,
                   CAST(l_quantity AS INTEGER) AS quantity,
                   CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount
            FROM lineitem
        ), written AS (SELECT order_id, product_id, quantity, total_amount FROM fact),
        apart AS (
            (SELECT * FROM lines EXCEPT ALL SELECT * FROM written)
            UNION ALL (SELECT * FROM written EXCEPT ALL SELECT * FROM lines)
        )
        SELECT silver_rows, gold_rows, silver_rows - gold_rows AS discrepancy,
               CAST((SELECT COUNT(*) FROM apart) = 0 AS INTEGER) AS same_content
        FROM (SELECT (SELECT COUNT(*) FROM lines) AS silver_rows,
                     (SELECT COUNT(*) FROM written) AS gold_rows)
    """,
    "pk_null_scan": _FACT
    + """
        SELECT COUNT(*) - COUNT(order_id) AS order_id_nulls,
               COUNT(*) - COUNT(product_id) AS product_id_nulls,
               COUNT(*) - COUNT(product_name) AS product_name_nulls
        FROM fact
    """,
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count
        FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
    """,
}

ORACLE_SQL.update(scenario_sql.ORACLE_SQL)
