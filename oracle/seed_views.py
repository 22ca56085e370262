"""DuckDB SQL for the example views."""

_TIER = "CASE WHEN c_acctbal < 0 THEN 'debtor' WHEN c_acctbal < 5000 THEN 'standard' ELSE 'premium' END"
_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_PROFIT = f"{_PRICE} * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))"

SQL = {
    "v01_active_customers": "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0",
    "v02_order_summary": """
        SELECT o_orderkey, c_name, c_mktsegment, o_orderdate, o_orderstatus, o_totalprice, count(*) AS item_count
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY ALL""",
    "v03_product_stats": """
        SELECT p_partkey, p_name, p_brand, p_retailprice,
          COALESCE(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(l_quantity), 0), 0) AS avg_quantity,
          count(l_quantity) AS line_count
        FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4""",
    "v04_revenue_by_category": f"""
        SELECT p_type, count(DISTINCT o_orderkey) AS order_count, CAST(sum({_PRICE}) AS DOUBLE) AS total_revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderstatus NOT IN ('P') GROUP BY p_type""",
    "v05_daily_active_users": """
        SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS dau FROM events
        WHERE user_id IS NOT NULL GROUP BY 1""",
    "v06_error_summary": """
        SELECT event_type, CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'medium' ELSE 'high' END AS severity,
          count(*) AS occurrences, max(ts) AS last_seen
        FROM events WHERE event_type <> 'view' GROUP BY 1, 2""",
    "v07_headcount_by_department": """
        SELECT n_nationkey, n_name, count(c_custkey) AS headcount,
          CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(c_custkey), 0) AS avg_balance
        FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING' GROUP BY 1, 2""",
    "v08_active_positions": """
        SELECT s_suppkey, s_name, n_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE s_acctbal > 0""",
    "v09_monthly_sales": f"""
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
          CAST(sum({_PRICE}) AS DOUBLE) AS revenue, CAST(sum({_PROFIT}) AS DOUBLE) AS profit, count(*) AS transactions
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "v10_product_performance": f"""
        SELECT p_name, p_type, p_brand, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS units_sold,
          CAST(sum({_PRICE}) AS DOUBLE) AS revenue, CAST(sum({_PROFIT}) AS DOUBLE) AS profit
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    "v11_customer_segments": f"""
        SELECT c_mktsegment AS segment, {_TIER} AS tier, count(*) AS orders,
          CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value,
          CAST(sum(date_diff('day', CAST(o_orderdate AS DATE), DATE '2003-01-01')) AS DOUBLE) / count(*) AS avg_age_days
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "v12_channel_attribution": f"""
        SELECT n_name AS channel, count(*) AS lines,
          CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS units, CAST(sum({_PRICE}) AS DOUBLE) AS revenue,
          CAST(sum({_PRICE} * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS discount,
          CAST(sum({_PRICE} * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS tax
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
    "v13_device_health": """
        SELECT c_custkey, c_name, c_acctbal, o_orderkey, o_orderdate, o_totalprice
        FROM customer LEFT JOIN (
          SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) latest
        ON o_custkey = c_custkey AND r = 1""",
    "v14_active_alerts": """
        SELECT o_orderkey, c_name, o_orderpriority,
          COALESCE(CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority)
            AS INTEGER), 0) AS priority_rank, o_orderdate
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'""",
}
