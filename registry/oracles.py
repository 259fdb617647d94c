"""The SQL counterpart of each registered query, over the same tables, for DuckDB."""

from __future__ import annotations

_LOG = """
    log AS (
        SELECT user_id, event_type, value, ts AS commit_ts, event_id AS commit_id,
               CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op
        FROM events
    )"""


def _state(where: str) -> str:
    """The live rows of the log after the commits that ``where`` selects."""
    return f"""
    WITH {_LOG},
    versions AS (
        SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY commit_ts DESC, commit_id DESC) AS version
        FROM log WHERE {where}
    )
    SELECT user_id, event_type, value, commit_ts, commit_id
    FROM versions WHERE version = 1 AND op <> 'D'
    """


_TEN_MINUTES_AGO = "commit_ts <= (SELECT max(commit_ts) FROM log) - INTERVAL 600 SECOND"

ORACLES = {
    "top_k_bridge": """
        SELECT s_suppkey AS actor_id,
               concat(s_name, ' ', n_name) AS actor_name,
               count(l.l_orderkey) AS total_rentals
        FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) b ON b.l_suppkey = s_suppkey
        JOIN part ON p_partkey = b.l_partkey
        JOIN lineitem l ON l.l_partkey = p_partkey
        GROUP BY s_suppkey, concat(s_name, ' ', n_name)
        ORDER BY total_rentals DESC NULLS FIRST, actor_id
        LIMIT 10
    """,
    "top1_category_spend": """
        SELECT p_type AS category,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) AS total_amount
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        GROUP BY p_type
        ORDER BY total_amount DESC NULLS FIRST, p_type
        LIMIT 1
    """,
    "rank_category_hours": """
        WITH totals AS (
            SELECT n_name AS city, p_type AS category,
                   sum(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 AS hours
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN part ON l_partkey = p_partkey
            JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
            WHERE r_name ILIKE 'a%' OR o_orderpriority LIKE '%-H%'
            GROUP BY n_name, p_type
        ),
        ranked AS (
            SELECT *, rank() OVER (PARTITION BY city ORDER BY hours DESC NULLS FIRST) AS place
            FROM totals
        )
        SELECT city, category, round(CAST(hours AS DOUBLE), 2) AS total_hours
        FROM ranked WHERE place = 1 ORDER BY city, category
    """,
    "conditional_counts": """
        SELECT n_name AS city,
               CAST(count(*) FILTER (c_acctbal >= 0) AS BIGINT) AS active_customers,
               CAST(count(*) FILTER (c_acctbal < 0) AS BIGINT) AS inactive_customers
        FROM region
        JOIN nation ON n_regionkey = r_regionkey
        JOIN customer ON c_nationkey = n_nationkey
        GROUP BY n_nationkey, n_name
        ORDER BY inactive_customers DESC NULLS FIRST, city
    """,
    "count_per_category": """
        SELECT r_name AS category, count(s_nationkey) AS film_count
        FROM region
        JOIN nation ON n_regionkey = r_regionkey
        JOIN supplier ON s_nationkey = n_nationkey
        GROUP BY r_regionkey, r_name
        ORDER BY film_count DESC NULLS FIRST, category
    """,
    "anti_join": """
        SELECT c_custkey, c_name FROM customer
        LEFT JOIN (
            SELECT o_custkey FROM orders
            WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
        ) urgent ON c_custkey = o_custkey
        WHERE o_custkey IS NULL
    """,
    "orders_wide_view": """
        SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice, o_orderpriority,
               l_linenumber, l_quantity, l_extendedprice, l_discount, l_shipdate,
               s_suppkey, s_name, n_name AS supplier_nation, p_partkey, p_name, p_brand, p_type,
               c_custkey, c_name, c_mktsegment, c_acctbal
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN part ON l_partkey = p_partkey
        JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    """,
    "loyalty_metrics": """
        SELECT c_custkey, c_name, c_mktsegment,
               CAST(sum(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS total_sales,
               array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|')
                   AS order_priorities
        FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY c_custkey, c_name, c_mktsegment
    """,
    "orders_date_view": "SELECT CAST(o_orderdate AS DATE) AS date, * FROM orders",
    "star_join_rename": """
        SELECT supplier.*, n_name AS supplier_nation
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
    "join_mixed_types": """
        SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name
        FROM (SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_totalprice FROM orders)
        JOIN customer ON o_custkey = CAST(c_custkey AS DOUBLE)
    """,
    "full_scan": "SELECT * FROM part",
    "filtered_count": """
        SELECT count(*) AS row_count FROM part WHERE p_type = 'ECONOMY' AND p_size = 11
    """,
    "group_max_sorted": """
        SELECT max(p_retailprice) AS max FROM part GROUP BY p_brand ORDER BY 1 DESC NULLS FIRST
    """,
    "global_minmax_ts": "SELECT max(ts) AS max_ts, min(ts) AS min_ts FROM events",
    "cutoff_max": """
        SELECT max(ts) AS newest_expired FROM events
        WHERE ts < (SELECT max(ts) - INTERVAL 10 DAY FROM events)
    """,
    "limit_sample": "SELECT * FROM events ORDER BY ts NULLS LAST, event_id NULLS LAST LIMIT 100",
    "age_columns": """
        SELECT o_orderkey,
               CAST(2026 - year(o_orderdate) AS INTEGER) AS age,
               round(2026 / CAST(year(o_orderdate) AS DOUBLE), 6) AS age_ratio
        FROM orders
    """,
    "ts_diff_seconds": """
        SELECT event_id,
               date_diff('second', TIMESTAMP '2024-01-15 12:00:00.5', ts) AS seconds
        FROM events
    """,
    "scalar_functions": """
        SELECT c_custkey, abs(c_acctbal) AS abs_balance, upper(c_name) AS upper_name,
               concat(c_name, ' ', c_mktsegment) AS label
        FROM customer
    """,
    "scalar_fn_minmax": """
        SELECT CAST(CAST(max(p_retailprice) AS DECIMAL(5,2)) AS DOUBLE) AS max_price,
               CAST(CAST(min(p_retailprice) AS DECIMAL(5,2)) AS DOUBLE) AS min_price
        FROM part
    """,
    "scalar_fn_converted": """
        SELECT CAST(CAST(CAST(1.35 AS DECIMAL(10,4)) * CAST(max(p_retailprice) AS DECIMAL(18,4))
               AS DECIMAL(28,2)) AS DOUBLE) AS converted
        FROM part
    """,
    "winsorize": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
               CASE WHEN l_quantity > 40 THEN 40.0 WHEN l_quantity < 5 THEN 5.0
                    ELSE l_quantity END AS clamped
        FROM lineitem
    """,
    "table_fn_above": """
        SELECT p_name AS item, p_retailprice AS price FROM part WHERE p_retailprice > 995
        ORDER BY price DESC NULLS FIRST, item
    """,
    "table_fn_below": """
        SELECT p_name AS item, p_retailprice AS price FROM part WHERE p_retailprice < 905
        ORDER BY price DESC NULLS FIRST, item
    """,
    "table_fn_ilike": """
        SELECT p_name AS item, p_retailprice AS price FROM part
        WHERE p_retailprice > 950 AND p_name ILIKE '%RING%'
        ORDER BY price DESC NULLS FIRST, item
    """,
    "ilike_prefix": "SELECT c_custkey FROM customer WHERE c_mktsegment ILIKE 'bUi%'",
    "variant_extract": """
        SELECT event_id, TRY_CAST(props ->> '$.k' AS BIGINT) AS k,
               TRY_CAST(props ->> '$.missing' AS BIGINT) AS missing
        FROM events
    """,
    "variant_type": """
        SELECT event_id, json_type(props) AS object_type,
               CASE json_type(props, '$.k')
                    WHEN 'UBIGINT' THEN 'INTEGER' WHEN 'BIGINT' THEN 'INTEGER'
                    ELSE json_type(props, '$.k') END AS member_type
        FROM events
    """,
    "variant_arith": """
        SELECT event_id, CAST(props ->> '$.k' AS DOUBLE) * 2.0 AS doubled FROM events
    """,
    "ctas_variant": """
        SELECT c_custkey AS custkey, c_acctbal AS balance,
               CASE WHEN c_acctbal = trunc(c_acctbal) THEN 'INTEGER' ELSE 'DECIMAL' END
                   AS balance_type
        FROM customer
    """,
    "csv_load": "SELECT * FROM orders",
    "csv_load_incremental": "SELECT * FROM customer",
    "insert_values": """
        SELECT o_orderkey AS test_number, o_orderpriority AS test_varchar,
               o_orderstatus = 'F' AS test_boolean, CAST(o_orderdate AS DATE) AS test_date,
               true AS variant_is_null
        FROM orders
        UNION ALL
        SELECT CAST(28 AS BIGINT), 'ha!', true, DATE '2024-01-01', true
    """,
    "update_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 2 ELSE o_totalprice END
                   AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders
    """,
    "retention_delete": """
        SELECT * FROM events
        WHERE ts IS NULL OR ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM events)
    """,
    "retention_job": """
        SELECT count(*) FILTER (ts IS NULL OR ts >= cutoff) AS kept,
               count(*) FILTER (ts < cutoff) AS removed
        FROM events, (SELECT max(ts) - INTERVAL 10 DAY AS cutoff FROM events)
    """,
    "footer_row_counts": """
        SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        UNION ALL SELECT 'events', count(*) FROM events
    """,
    "csv_load_refused": """
        SELECT verdict, count(*) AS lines,
               CAST(sum(CASE WHEN verdict = 'loaded' THEN o_orderkey END) AS BIGINT) AS sum_k
        FROM (SELECT o_orderkey, CASE
                  WHEN o_orderkey % 5 = 0 OR o_orderkey % 11 = 0 THEN 'malformed'
                  WHEN length(o_orderpriority) > 10 THEN 'priority exceeds 10 characters'
                  WHEN o_orderkey % 7 = 0 THEN 'held is not JSON'
                  ELSE 'loaded' END AS verdict
              FROM orders)
        GROUP BY verdict
    """,
    "variant_stored_field": """
        SELECT event_id, TRY_CAST(props ->> '$.k' AS BIGINT) AS k FROM events
    """,
    "clone_append_counts": """
        SELECT 'orders_clone' AS table_name, 2 * count(*) AS row_count FROM orders
        UNION ALL
        SELECT 'orders', count(*) FROM orders
    """,
    "asof_timestamp": _state("commit_ts <= TIMESTAMP '2024-01-15 12:00:00'"),
    "asof_offset": _state(_TEN_MINUTES_AGO),
    "asof_before": _state(
        "commit_id < (SELECT max(commit_id) FROM log WHERE event_type = 'purchase')"
    ),
    "clone_asof": _state(_TEN_MINUTES_AGO),
    "history_prune": f"""
        WITH {_LOG},
        bounds AS (SELECT max(commit_ts) - INTERVAL 10 DAY AS cutoff FROM log),
        versions AS (
            SELECT log.*, commit_ts > cutoff AS newer, row_number() OVER (
                PARTITION BY user_id, commit_ts > cutoff
                ORDER BY commit_ts DESC, commit_id DESC) AS version
            FROM log, bounds
        )
        SELECT user_id, event_type, value, commit_ts, commit_id, op
        FROM versions WHERE newer OR version = 1
    """,
    "update_log": f"""
        SELECT user_id, event_type, CASE WHEN value > 10 THEN value / 2 ELSE value END AS value
        FROM ({_state("true")})
    """,
    "delete_log": f"""
        SELECT user_id, event_type, value FROM ({_state("true")}) WHERE (value > 10) IS NOT TRUE
    """,
    "load_then_append": "SELECT * FROM customer",
    "table_fn_above_exact": """
        SELECT p_name AS item, CAST(CAST(p_retailprice AS DECIMAL(38,4)) AS VARCHAR) AS price
        FROM part WHERE CAST(p_retailprice AS DECIMAL(38,4)) > CAST('994.99995' AS DECIMAL(38,5))
    """,
    "table_fn_below_exact": """
        SELECT p_name AS item, CAST(CAST(p_retailprice AS DECIMAL(38,4)) AS VARCHAR) AS price
        FROM part WHERE CAST(p_retailprice AS DECIMAL(38,4)) < CAST('905.00005' AS DECIMAL(38,5))
    """,
    "films_not_stocked": """
        SELECT film_id, title FROM (
            SELECT CASE WHEN p_size % 7 > 0 THEN p_partkey END AS film_id, p_name AS title FROM part)
        WHERE film_id IS NULL
           OR film_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)
    """,
    "top_spend_category": """
        SELECT r_name AS category,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS VARCHAR) AS total_amount
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_regionkey, r_name
        ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,4))) DESC, r_regionkey LIMIT 3
    """,
    "update_key_log": f"""
        SELECT user_id * 2 + CASE WHEN value > 10 THEN 1 ELSE 0 END AS user_id, event_type, value
        FROM ({_state("true")})
    """,
    "update_rounded": f"""
        SELECT user_id, event_type, CAST(round(round(value) / 2) AS BIGINT) AS value
        FROM ({_state("true")})
    """,
    "asof_stored_log": _state("commit_ts <= TIMESTAMP '2024-01-15 12:00:00'"),
    "prune_stored_log": _state("commit_ts <= TIMESTAMP '2024-01-15 12:00:00'"),
    "before_stored_log": _state(
        "commit_id < (SELECT max(commit_id) FROM log WHERE event_type = 'purchase')"
    ),
    "asof_snapshot_log": _state("commit_ts <= TIMESTAMP '2024-01-15 12:00:00'"),
    "update_snapshot_log": f"""
        SELECT user_id, event_type, CASE WHEN value > 10 THEN value / 2 ELSE value END AS value
        FROM ({_state("true")})
    """,
    "sql_orders_view": """
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey AS order_id,
               CAST(l_linenumber AS BIGINT) AS line_number, s_name AS primary_city,
               f.n_name AS franchisee_first_name, CAST(p.n_nationkey AS BIGINT) AS location_id,
               c_custkey AS customer_id, c_name AS first_name, p_name AS menu_item_name,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(38,4)) AS VARCHAR) AS price
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON o_custkey % 100 + 1 = s_suppkey
        JOIN nation f ON s_nationkey = f.n_nationkey
        JOIN nation p ON o_orderkey % 30 = p.n_nationkey
        JOIN part ON l_partkey = p_partkey
        LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    """,
    "catalog_orders_view": """
        SELECT 'orders_v' AS view, CAST(o_orderdate AS DATE) AS date, count(*) AS rows,
               count(c_custkey) AS of_members,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS VARCHAR) AS price,
               'Order Detail View' AS comment
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON o_custkey % 100 + 1 = s_suppkey
        JOIN nation f ON s_nationkey = f.n_nationkey
        JOIN nation p ON o_orderkey % 30 = p.n_nationkey
        JOIN part ON l_partkey = p_partkey
        LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
        GROUP BY 2
        UNION ALL
        SELECT 'customer_loyalty_metrics_v', NULL, count(DISTINCT c_custkey), count(DISTINCT c_custkey),
               CAST(sum(CAST(o_totalprice AS DECIMAL(38,4))) AS VARCHAR),
               'Customer Loyalty Member Metrics View'
        FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0
    """,
    "sql_prices_above": """
        SELECT p_name AS item, CAST(CAST(p_retailprice AS DECIMAL(38,4)) AS VARCHAR) AS price
        FROM part WHERE CAST(p_retailprice AS DECIMAL(38,4)) > 995
    """,
    "sql_loyalty_view": """
        SELECT c_custkey AS customer_id, c_name AS first_name,
               CAST(sum(CAST(o_totalprice AS DECIMAL(38,4))) AS VARCHAR) AS total_sales,
               count(DISTINCT o_orderkey % 30) AS places
        FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0
        GROUP BY c_custkey, c_name
    """,
    "trucks_report": """
        SELECT s_suppkey AS truck_id, s_name AS primary_city, CAST(s_nationkey AS BIGINT) AS franchise_id,
               n_name AS franchisee_first_name, 'x' AS franchisee_last_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
}
ORACLES["prune_twice_log"] = ORACLES["history_prune"]
