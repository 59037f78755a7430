"""What the whole runs leave behind, in plain SQL over the tables they read."""

from __future__ import annotations

_LAST_LINE = """
    WITH last_line AS (
        SELECT * FROM lineitem
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC
        ) = 1
    ),
    heads AS (SELECT * FROM orders LEFT JOIN last_line ON l_orderkey = o_orderkey)
"""
_GOOD_ORDER = "l_quantity > 0 AND o_totalprice >= 0"
_GOOD_PRODUCT = "p_retailprice > 0 AND p_size <= 48"
_GOOD_CUSTOMER = "c_acctbal >= -500"

_FIRST_RUN = _LAST_LINE + f"""
    , first_run AS (
        SELECT 'source_products' AS table_name, COUNT(*) AS extracted,
               COUNT(*) FILTER (WHERE {_GOOD_PRODUCT}) AS promoted FROM part
        UNION ALL
        SELECT 'source_customers', COUNT(*), COUNT(*) FILTER (WHERE {_GOOD_CUSTOMER}) FROM customer
        UNION ALL
        SELECT 'source_orders', COUNT(*), COUNT(*) FILTER (WHERE {_GOOD_ORDER}) FROM heads
    )
"""

ORACLE_SQL: dict[str, str] = {
    "medallion_refresh": """
        WITH last_line AS (
            SELECT * FROM lineitem
            QUALIFY ROW_NUMBER() OVER (
                PARTITION BY l_orderkey
                ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC
            ) = 1
        ),
        sales AS (
            SELECT CASE WHEN o_orderstatus = 'F' AND o_orderdate <= TIMESTAMP '1998-06-30'
                        THEN DATE '1998-07-01' ELSE CAST(o_orderdate AS DATE) END AS order_date,
                   p_type AS product_category, o_orderkey,
                   CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(10,2)) AS net_sales
            FROM orders
            JOIN last_line ON l_orderkey = o_orderkey
            LEFT JOIN part ON p_partkey = l_partkey AND p_size <= 48
            WHERE l_quantity > 0 AND o_totalprice >= 0
        )
        SELECT order_date, product_category, CAST(SUM(net_sales) AS DOUBLE) AS total_revenue,
               COUNT(o_orderkey) AS total_orders
        FROM sales GROUP BY 1, 2
    """,
    "gold_after_changes": _LAST_LINE
    + f"""
        , sold AS (
            SELECT o_custkey, l_partkey, o_orderkey,
                   CASE WHEN l_quantity = 50 THEN 1 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
                   CASE WHEN l_quantity = 50 THEN DATE '2002-12-31'
                        WHEN o_orderstatus = 'P' THEN DATE '2002-12-30'
                        ELSE CAST(o_orderdate AS DATE) END AS order_date
            FROM heads WHERE {_GOOD_ORDER}
        ), products AS (
            SELECT p_partkey, CASE WHEN p_size = 2 THEN 'PROMO' ELSE p_type END AS product_category,
                   CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_size = 1 THEN 1 ELSE 0 END AS price
            FROM part WHERE {_GOOD_PRODUCT}
        ), customers AS (
            SELECT c_custkey, c_acctbal > 9900 AS moved FROM customer WHERE {_GOOD_CUSTOMER}
        ), fact AS (
            SELECT order_date, product_category, quantity * price AS net_sales, o_orderkey, moved
            FROM sold LEFT JOIN products ON p_partkey = l_partkey
            LEFT JOIN customers ON c_custkey = o_custkey
        )
        SELECT order_date, product_category, CAST(SUM(net_sales) AS DOUBLE) AS total_revenue,
               COUNT(o_orderkey) AS total_orders, CAST(SUM(net_sales) AS DOUBLE) AS fact_revenue,
               COUNT(*) AS fact_rows, COUNT(*) FILTER (WHERE moved) AS moved_rows
        FROM fact GROUP BY 1, 2
    """,
    "run_ledger": _FIRST_RUN
    + """
        SELECT 'r1' AS run_id, table_name, extracted AS extracted_rows, promoted AS silver_rows,
               CAST(NULL AS BIGINT) AS gold_rows, extracted - promoted AS discrepancy, 1 AS timed
        FROM first_run
        UNION ALL
        SELECT 'r1', 'fact_orders', NULL, NULL, promoted, 0, 1
        FROM first_run WHERE table_name = 'source_orders'
        UNION ALL
        SELECT 'r2', 'source_products', extracted, NULL, NULL, extracted, 1
        FROM first_run WHERE table_name = 'source_products'
    """,
    "pending_runs": "SELECT 'r2' AS run_id, 'source_products' AS table_name",
    "run_statuses": _FIRST_RUN
    + """
        SELECT 'r1' AS run_id, 'extract' AS stage, table_name,
               CASE table_name WHEN 'source_customers' THEN 'skipped: empty source' ELSE 'SUCCESS' END
                   AS status,
               CASE table_name WHEN 'source_customers' THEN 0 ELSE extracted END AS row_count
        FROM first_run
        UNION ALL
        SELECT 'r1', 'promote', table_name,
               CASE table_name WHEN 'source_customers' THEN 'skipped: no raw batch' ELSE 'published' END,
               CASE table_name WHEN 'source_customers' THEN 0 ELSE promoted END
        FROM first_run
        UNION ALL
        SELECT 'r2', 'extract', table_name,
               CASE table_name WHEN 'source_products' THEN 'skipped: no new rows' ELSE 'SUCCESS' END,
               CASE table_name WHEN 'source_products' THEN 0 ELSE extracted END
        FROM first_run
        UNION ALL
        SELECT 'r2', 'promote', table_name,
               CASE table_name WHEN 'source_products' THEN 'skipped: no raw batch'
                               WHEN 'source_orders' THEN 'failed: MissingColumnsError'
                               ELSE 'published' END,
               CASE table_name WHEN 'source_customers' THEN promoted ELSE 0 END
        FROM first_run
    """,
    "quarantine_readback": """
        SELECT 'source_products' AS table_name, p_partkey AS row_key,
               concat_ws(',', CASE WHEN NOT p_retailprice > 0 THEN 'negative_or_zero_price' END,
                         CASE WHEN p_size > 48 THEN 'oversized_stock' END) AS validation_errors
        FROM part WHERE NOT p_retailprice > 0 OR p_size > 48
        UNION ALL
        SELECT 'source_customers', c_custkey, 'malformed_or_null_email' FROM customer WHERE c_acctbal < -500
    """,
    "extraction_state": """
        SELECT 'source_products' AS source_table, 'r1' AS pipeline_run_id, 'SUCCESS' AS status,
               epoch_us(TIMESTAMP '1995-01-01') AS watermark_us
        UNION ALL
        SELECT 'source_customers', 'r1', 'SUCCESS', epoch_us(TIMESTAMP '1995-01-01')
        UNION ALL
        SELECT 'source_orders', 'r2', 'FAILED', epoch_us(MAX(o_orderdate)) FROM orders
    """,
    "metrics_history": """
        WITH failed AS (
            SELECT COUNT(*) FILTER (WHERE NOT p_retailprice > 0) AS price,
                   COUNT(*) FILTER (WHERE p_size > 48) AS size
            FROM part WHERE p_size > 25
        ), rules AS (
            SELECT unnest(['null_primary_key', 'negative_or_zero_price', 'invalid_category_enum',
                           'oversized_stock']) AS rule,
                   unnest([0, price, 0, size]) AS failures
            FROM failed WHERE price + size > 0
        )
        SELECT 'source_products' AS table_name, 'r1' AS pipeline_run_id, rule,
               CAST(0 AS BIGINT) AS failures, CAST(NULL AS BIGINT) AS change FROM rules
        UNION ALL
        SELECT 'source_products', 'r2', rule, failures, failures FROM rules
    """,
    "lost_rows": _LAST_LINE
    + f"""
        , marked AS (
            SELECT *, COALESCE(o_orderstatus = 'O' AND l_quantity = 7, FALSE) AS late FROM heads
        ), due AS (
            SELECT * FROM marked
            WHERE o_orderdate <= (SELECT MAX(o_orderdate) FROM marked WHERE NOT late) AND {_GOOD_ORDER}
        )
        SELECT o_orderkey AS order_id,
               CASE WHEN late THEN 'missing' WHEN CAST(o_totalprice AS DECIMAL(10,2)) < 5000 THEN 'deleted' ELSE 'changed' END
                   AS difference
        FROM due
        WHERE CASE WHEN late THEN CAST(o_totalprice AS DECIMAL(10,2)) >= 5000
                   ELSE CAST(o_totalprice AS DECIMAL(10,2)) < 5000 OR l_quantity = 50 END
    """,
}
