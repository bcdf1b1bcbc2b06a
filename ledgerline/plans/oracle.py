"""Independent DuckDB SQL for every named query.

Each statement reads the driver's tables (views ``lineitem orders customer
nation part events``) through the same adapter mapping as
``ledgerline.sources.tables`` and states the query's meaning directly in
SQL. Money is DECIMAL until the output, where both sides cast to DOUBLE;
averages and growth ratios are rounded HALF_UP with integer arithmetic on
both sides, so the compared values are bit-identical.
"""

from __future__ import annotations

from ledgerline.plans.catalog import QUERY_PARAMS, REJECT_PARAMS, SILVER_STORE, STORE_ALERT

HV = str(QUERY_PARAMS.high_value_threshold)
ALERT = str(QUERY_PARAMS.sales_alert_threshold)
FLOOR = str(REJECT_PARAMS.price_floor)
FACTOR = str(QUERY_PARAMS.spike_factor)

PRELUDE = """
WITH raw_sales AS (
    SELECT CAST(l.l_orderkey AS VARCHAR) AS transaction_id,
           CAST(o.o_custkey AS VARCHAR) AS customer_id,
           CAST(l.l_partkey AS VARCHAR) AS product_id,
           'S' || CAST(l.l_suppkey % 10 AS VARCHAR) AS store_id,
           CASE WHEN l.l_quantity = floor(l.l_quantity) THEN TRY_CAST(l.l_quantity AS INTEGER) END AS quantity,
           TRY_CAST(l.l_extendedprice AS DECIMAL(12, 2)) AS price,
           o.o_orderdate AS ts
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
sales AS (
    SELECT transaction_id, customer_id, product_id, store_id, quantity, price,
           price * quantity AS revenue, ts
    FROM raw_sales
    WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
      AND price IS NOT NULL AND quantity IS NOT NULL AND price > 0 AND quantity > 0
),
customers AS (
    SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name,
           n.n_name AS city, c.c_mktsegment AS segment
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE c.c_custkey IS NOT NULL
),
products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_brand AS brand
    FROM part WHERE p_partkey IS NOT NULL
),
enriched AS (
    SELECT s.transaction_id, s.ts, s.quantity, s.price, ROUND(s.revenue, 2) AS revenue,
           c.customer_id, c.name AS customer_name, c.city, c.segment,
           p.product_id, p.category, p.brand
    FROM sales s
    JOIN customers c ON s.customer_id = c.customer_id
    JOIN products p ON s.product_id = p.product_id
),
ev AS (
    SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS customer_id,
           event_type AS product_id,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
           TRY_CAST(value AS DECIMAL(12, 2)) AS price, ts
    FROM events
),
evc AS (
    SELECT *, price * quantity AS revenue FROM ev
    WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
      AND price IS NOT NULL AND quantity IS NOT NULL AND price > 0 AND quantity > 0
),
win AS (
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           product_id,
           CAST(SUM(quantity) AS BIGINT) AS total_qty,
           CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS window_revenue
    FROM evc WHERE ts IS NOT NULL
    GROUP BY 1, 2, 3
),
emitted AS (
    SELECT * FROM win
    WHERE window_end <= (SELECT max(ts) FROM evc) - INTERVAL 5 MINUTE
)
"""


def money(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


def avg_money(total: str, count: str) -> str:
    return (
        f"(CASE WHEN ({count}) > 0 THEN CAST((CAST(({total}) * 100 AS HUGEINT) * 2 + ({count}))"
        f" // (2 * ({count})) AS DOUBLE) / CAST(100 AS DOUBLE) END)"
    )


def growth(cur: str, prev: str) -> str:
    n = f"(({cur}) - ({prev}))"
    d = f"({prev})"
    q = (
        f"((CAST(abs({n}) * 100 AS HUGEINT) * 2000000 + CAST(abs({d}) * 100 AS HUGEINT))"
        f" // (CAST(abs({d}) * 100 AS HUGEINT) * 2))"
    )
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    return (
        f"COALESCE(CASE WHEN {d} <> 0 THEN CAST({sign} * {q} AS DOUBLE) / CAST(1000000 AS DOUBLE) END,"
        f" CAST(0 AS DOUBLE))"
    )


FACT_SELECT = (
    "transaction_id, customer_id, product_id, store_id, quantity, "
    "CAST(price AS DOUBLE) AS price, CAST(revenue AS DOUBLE) AS revenue, ts AS \"timestamp\""
)

MTD = """
mtd_dated AS (SELECT CAST(ts AS DATE) AS d, revenue FROM sales),
mtd AS (
    SELECT COALESCE(SUM(revenue) FILTER (
               WHERE d BETWEEN CAST(date_trunc('month', (SELECT max(d) FROM mtd_dated)) AS DATE)
                           AND (SELECT max(d) FROM mtd_dated)), 0) AS this_sum,
           COALESCE(SUM(revenue) FILTER (
               WHERE d BETWEEN CAST(date_trunc('month', (SELECT max(d) FROM mtd_dated) - INTERVAL 1 MONTH) AS DATE)
                           AND CAST((SELECT max(d) FROM mtd_dated) - INTERVAL 1 MONTH AS DATE)), 0) AS last_sum
    FROM mtd_dated
)
"""

MONTHS = f"""
months AS (
    SELECT CAST(date_trunc('month', ts) AS DATE) AS month_start, SUM(revenue) AS revenue
    FROM sales WHERE ts IS NOT NULL GROUP BY 1
),
growth_by_month AS (
    SELECT strftime(m.month_start, '%Y-%m') AS month, {money('m.revenue')} AS revenue,
           {growth('m.revenue', 'p.revenue')} AS growth
    FROM months m LEFT JOIN months p
      ON p.month_start = CAST(m.month_start - INTERVAL 1 MONTH AS DATE)
)
"""


def _q(body: str, extra_ctes: str = "") -> str:
    prelude = PRELUDE.rstrip()
    if extra_ctes:
        prelude += ",\n" + extra_ctes.strip()
    return prelude + "\n" + body.strip()


ORACLE: dict[str, str] = {
    "revenue_by_city": _q(f"""
        SELECT c.city, {money('SUM(s.revenue)')} AS total_revenue,
               COUNT(s.transaction_id) AS total_transactions
        FROM sales s JOIN customers c ON s.customer_id = c.customer_id
        GROUP BY c.city"""),
    "clean_sales": _q(f"SELECT {FACT_SELECT} FROM sales"),
    "high_value_sales": _q(f"SELECT {FACT_SELECT} FROM sales WHERE revenue >= {HV}"),
    "rejected_rows": _q(f"""
        SELECT reason, COUNT(*) AS n FROM (
            SELECT CASE
                     WHEN transaction_id IS NULL OR customer_id IS NULL OR product_id IS NULL
                       THEN 'null_key'
                     WHEN price IS NULL OR quantity IS NULL THEN 'null_number'
                     ELSE 'non_positive' END AS reason
            FROM raw_sales
            WHERE NOT COALESCE(transaction_id IS NOT NULL AND customer_id IS NOT NULL
                               AND product_id IS NOT NULL AND price IS NOT NULL
                               AND quantity IS NOT NULL AND price > {FLOOR} AND quantity > 0, FALSE)
        ) GROUP BY reason"""),
    "product_revenue": _q(f"""
        SELECT product_id, {money('SUM(revenue)')} AS revenue FROM sales GROUP BY product_id"""),
    "top10_products": _q(f"""
        SELECT product_id, {money('SUM(revenue)')} AS revenue FROM sales GROUP BY product_id
        ORDER BY SUM(revenue) DESC, product_id ASC LIMIT 10"""),
    "enriched_sales": _q("""
        SELECT transaction_id, ts AS "timestamp", quantity, CAST(price AS DOUBLE) AS price,
               CAST(revenue AS DOUBLE) AS revenue, customer_id, customer_name, city, segment,
               product_id, category, brand
        FROM enriched"""),
    "top5_products": _q(f"""
        SELECT p.product_id, p.category, p.brand, {money('SUM(s.revenue)')} AS total_revenue
        FROM sales s JOIN products p ON s.product_id = p.product_id
        GROUP BY p.product_id, p.category, p.brand
        ORDER BY SUM(s.revenue) DESC, p.product_id ASC, p.category ASC NULLS FIRST,
                 p.brand ASC NULLS FIRST
        LIMIT 5"""),
    "monthly_trend": _q(f"""
        SELECT strftime(ts, '%Y-%m') AS month, {money('SUM(revenue)')} AS monthly_revenue,
               COUNT(transaction_id) AS num_transactions
        FROM sales WHERE ts IS NOT NULL GROUP BY 1"""),
    "gold_revenue_by_city": _q(f"""
        SELECT city, {money('SUM(revenue)')} AS total_revenue,
               COUNT(transaction_id) AS total_transactions,
               {avg_money('SUM(revenue)', 'COUNT(revenue)')} AS avg_order_value
        FROM enriched GROUP BY city"""),
    "gold_revenue_by_category": _q(f"""
        SELECT category, brand, {money('SUM(revenue)')} AS total_revenue,
               CAST(SUM(quantity) AS BIGINT) AS total_units_sold
        FROM enriched GROUP BY category, brand"""),
    "gold_customer_segments": _q(f"""
        SELECT segment, {money('SUM(revenue)')} AS total_revenue,
               COUNT(DISTINCT customer_id) AS unique_customers,
               {avg_money('SUM(revenue)', 'COUNT(revenue)')} AS avg_spend
        FROM enriched GROUP BY segment"""),
    "gold_monthly_trend": _q(f"""
        SELECT strftime(ts, '%Y-%m') AS month, {money('SUM(revenue)')} AS monthly_revenue,
               COUNT(transaction_id) AS num_transactions
        FROM enriched GROUP BY 1"""),
    "fact_sales": _q(f"SELECT {FACT_SELECT} FROM sales"),
    "daily_revenue": _q(f"""
        SELECT CAST(ts AS DATE) AS date, {money('SUM(revenue)')} AS daily_revenue
        FROM enriched GROUP BY 1"""),
    "low_sales_days": _q(f"""
        SELECT CAST(ts AS DATE) AS date, {money('SUM(revenue)')} AS daily_revenue
        FROM enriched GROUP BY 1 HAVING SUM(revenue) < {ALERT}"""),
    "bronze_profile": _q("""
        SELECT 'sales' AS table_name, COUNT(*) AS n_rows,
               COUNT(*) FILTER (WHERE transaction_id IS NULL OR customer_id IS NULL
                                 OR product_id IS NULL) AS n_null_keys
        FROM raw_sales
        UNION ALL
        SELECT 'customers', COUNT(*), COUNT(*) FILTER (WHERE customer_id IS NULL) FROM customers
        UNION ALL
        SELECT 'products', COUNT(*), COUNT(*) FILTER (WHERE product_id IS NULL) FROM products"""),
    "orphan_customers": _q("""
        SELECT s.customer_id, COUNT(*) AS n_sales FROM sales s
        WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = s.customer_id)
        GROUP BY s.customer_id"""),
    "orphan_products": _q("""
        SELECT s.product_id, COUNT(*) AS n_sales FROM sales s
        WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = s.product_id)
        GROUP BY s.product_id"""),
    "duplicate_customers": _q("""
        SELECT customer_id, COUNT(*) AS n FROM customers WHERE customer_id IS NOT NULL
        GROUP BY customer_id HAVING COUNT(*) > 1"""),
    "duplicate_products": _q("""
        SELECT product_id, COUNT(*) AS n FROM products WHERE product_id IS NOT NULL
        GROUP BY product_id HAVING COUNT(*) > 1"""),
    "silver_store_sales": _q(f"SELECT {FACT_SELECT} FROM sales WHERE store_id = '{SILVER_STORE}'"),
    "total_sales": _q(f"SELECT {money('COALESCE(SUM(revenue), 0)')} AS total_sales FROM sales"),
    "average_order_value": _q(f"""
        SELECT COALESCE({avg_money('SUM(revenue)', 'COUNT(DISTINCT transaction_id)')},
                        CAST(0 AS DOUBLE)) AS average_order_value
        FROM sales"""),
    "customer_count": _q("SELECT COUNT(DISTINCT customer_id) AS customer_count FROM sales"),
    "top_category": _q("""
        SELECT category AS top_category FROM (
            SELECT p.category, SUM(s.revenue) AS rev
            FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
            GROUP BY p.category)
        ORDER BY rev DESC, category ASC NULLS LAST LIMIT 1"""),
    "sales_growth_mtd": _q(
        f"""
        SELECT {money('this_sum')} AS this_month, {money('last_sum')} AS last_month,
               {growth('this_sum', 'last_sum')} AS growth
        FROM mtd""",
        MTD,
    ),
    "sales_growth_by_month": _q("SELECT month, revenue, growth FROM growth_by_month", MONTHS),
    "revenue_by_segment": _q(f"""
        SELECT city, segment, {money('rev')} AS revenue,
               {money('SUM(rev) OVER (PARTITION BY segment)')} AS segment_revenue
        FROM (SELECT c.city, c.segment, SUM(s.revenue) AS rev
              FROM sales s LEFT JOIN customers c ON s.customer_id = c.customer_id
              GROUP BY c.city, c.segment)"""),
    "executive_overview": _q(
        f"""
        SELECT {money('COALESCE(SUM(revenue), 0)')} AS total_sales,
               COALESCE({avg_money('COALESCE(SUM(revenue), 0)', 'COUNT(DISTINCT transaction_id)')},
                        CAST(0 AS DOUBLE)) AS average_order_value,
               (SELECT {growth('this_sum', 'last_sum')} FROM mtd) AS sales_growth,
               COUNT(DISTINCT customer_id) AS customer_count
        FROM sales""",
        MTD,
    ),
    "sales_by_city": _q(f"""
        SELECT c.city, {money('SUM(s.revenue)')} AS total_sales
        FROM sales s LEFT JOIN customers c ON s.customer_id = c.customer_id GROUP BY c.city"""),
    "sales_trend": _q(
        "SELECT month, revenue AS total_sales, growth AS sales_growth FROM growth_by_month", MONTHS
    ),
    "sales_by_brand": _q(f"""
        SELECT p.brand, {money('SUM(s.revenue)')} AS total_sales
        FROM sales s LEFT JOIN products p ON s.product_id = p.product_id GROUP BY p.brand"""),
    "sales_by_category": _q(f"""
        SELECT p.category, {money('SUM(s.revenue)')} AS total_sales
        FROM sales s LEFT JOIN products p ON s.product_id = p.product_id GROUP BY p.category"""),
    "segment_summary": _q(f"""
        SELECT c.segment, {money('SUM(s.revenue)')} AS total_sales,
               COALESCE({avg_money('SUM(s.revenue)', 'COUNT(DISTINCT s.transaction_id)')},
                        CAST(0 AS DOUBLE)) AS average_order_value,
               COUNT(DISTINCT s.customer_id) AS customer_count
        FROM sales s LEFT JOIN customers c ON s.customer_id = c.customer_id
        GROUP BY c.segment"""),
    "windowed_demand": _q("SELECT * FROM win"),
    "demand_spikes": _q(f"""
        SELECT * FROM win
        WHERE total_qty * (SELECT COUNT(*) FROM win)
              > {FACTOR} * (SELECT COALESCE(SUM(total_qty), 0) FROM win)"""),
    "stream_windowed_demand": _q("SELECT * FROM emitted"),
    "stream_demand_spikes": _q(f"""
        SELECT * FROM emitted
        WHERE total_qty * (SELECT COUNT(*) FROM emitted)
              > {FACTOR} * (SELECT COALESCE(SUM(total_qty), 0) FROM emitted)"""),
    "csv_stream_windowed_demand": _q("SELECT * FROM emitted"),
    "csv_profile": _q("""
        SELECT 'sales' AS table_name, COUNT(*) AS n_rows,
               COUNT(*) FILTER (WHERE transaction_id IS NULL OR customer_id IS NULL
                                 OR product_id IS NULL) AS n_null_keys
        FROM raw_sales
        UNION ALL
        SELECT 'customers', COUNT(*), COUNT(*) FILTER (WHERE c_custkey IS NULL) FROM customer
        UNION ALL
        SELECT 'products', COUNT(*), COUNT(*) FILTER (WHERE p_partkey IS NULL) FROM part"""),
    "bronze_sales": _q("""
        SELECT transaction_id, customer_id, product_id, store_id, CAST(quantity AS VARCHAR) AS quantity,
               CAST(price AS VARCHAR) AS price, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp"
        FROM raw_sales"""),
    "view_store_revenue": _q("""
        SELECT store_id, CAST(SUM(revenue) AS DOUBLE) AS revenue, COUNT(*) AS n FROM sales GROUP BY store_id"""),
    "orphan_orders": """
        SELECT o_orderkey AS transaction_id, COUNT(*) AS n_sales FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
        GROUP BY o_orderkey""",
    "duplicate_lines": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "dim_customer": _q("SELECT customer_id, name, city, segment FROM customers"),
    "dim_product": _q("SELECT product_id, category, brand FROM products"),
    "dim_date": _q("""
        SELECT CAST(unnest(generate_series(CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE), INTERVAL 1 DAY))
                    AS DATE) AS date FROM sales"""),
    "fact_sample": _q("""
        SELECT transaction_id, customer_id, product_id, CAST(revenue AS DOUBLE) AS revenue, city, segment, category
        FROM enriched
        ORDER BY transaction_id NULLS LAST, product_id NULLS LAST, customer_id NULLS LAST, revenue NULLS LAST,
                 city NULLS LAST, segment NULLS LAST, category NULLS LAST
        LIMIT 5"""),
}

# Sales as read from files with damaged lines (see ``damaged_lines``).
DAMAGED = """
damaged AS (
    SELECT transaction_id, product_id, TRY_CAST(transaction_id AS BIGINT) % 20 AS m, ts, price, quantity, customer_id
    FROM raw_sales
),
read_back AS (
    SELECT m, transaction_id, product_id,
           CASE WHEN m = 4 THEN NULL ELSE customer_id END AS customer_id,
           CASE WHEN m IN (1, 3) THEN NULL WHEN m = 6 THEN 0 ELSE quantity END AS quantity,
           CASE WHEN m IN (1, 5) THEN NULL ELSE price END AS price,
           CASE WHEN m IN (1, 7) THEN NULL ELSE ts END AS ts
    FROM damaged
),
judged AS (
    SELECT *, CASE
        WHEN transaction_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
             AND price > 0 AND quantity > 0 THEN 'accepted'
        WHEN m IN (1, 2, 3) THEN 'malformed'
        WHEN transaction_id IS NULL OR customer_id IS NULL OR product_id IS NULL THEN 'null_key'
        WHEN price IS NULL OR quantity IS NULL THEN 'null_number'
        ELSE 'non_positive' END AS reason
    FROM read_back
)
"""
TREND = "strftime(ts, '%Y-%m') AS month, " + money("SUM(price * quantity)") + " AS monthly_revenue, COUNT(*) AS num_transactions"
CALENDAR = """
calendar AS (
    SELECT CAST(unnest(generate_series(CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date
    FROM sales
)
"""
# The middle of the span of all events; the watermark of what arrived before it.
HALVES = """
middle AS (SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 AS us FROM events),
early AS (SELECT *, COALESCE(epoch_us(ts) < (SELECT us FROM middle), TRUE) AS is_early FROM evc)
"""


def _windows(rows: str) -> str:
    return f"""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, product_id,
           CAST(SUM(quantity) AS BIGINT) AS total_qty,
           CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS window_revenue
    FROM ({rows}) WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""


def _spikes(windows: str) -> str:
    return f"""
    SELECT * FROM {windows} WHERE total_qty * (SELECT COUNT(*) FROM {windows})
        > {FACTOR} * (SELECT COALESCE(SUM(total_qty), 0) FROM {windows})"""


LATE = HALVES.rstrip() + f""",
punctual AS (
    SELECT *, NOT (is_early AND COALESCE(CAST(transaction_id AS BIGINT), 0) % 10 = 3) AS on_time FROM early
),
watermark AS (SELECT max(ts) - INTERVAL 5 MINUTE AS late FROM punctual WHERE is_early AND on_time),
counted AS (
    SELECT * FROM punctual
    WHERE (is_early AND on_time) OR (SELECT late FROM watermark) IS NULL
       OR time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > (SELECT late FROM watermark)
),
stored AS (
    SELECT * FROM ({_windows("SELECT * FROM counted")})
    WHERE window_end <= (SELECT max(ts) FROM evc) - INTERVAL 5 MINUTE
)
"""

ORACLE |= {
    "bronze_customers": _q("""
        SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name, n.n_name AS city,
               c.c_mktsegment AS segment
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "bronze_products": _q("""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_brand AS brand FROM part"""),
    "csv_corrupt_rejects": _q("SELECT reason, COUNT(*) AS n FROM judged GROUP BY reason", DAMAGED),
    "csv_corrupt_trend": _q(
        f"""
        SELECT 'gold' AS trend, {TREND} FROM judged WHERE reason = 'accepted' GROUP BY 2
        UNION ALL
        SELECT 'sql', {TREND} FROM judged WHERE reason = 'accepted' AND ts IS NOT NULL GROUP BY 2""",
        DAMAGED,
    ),
    "layer_audit": _q(
        """
        SELECT 'silver' AS layer, COUNT(*) AS n FROM judged WHERE reason = 'accepted'
        UNION ALL
        SELECT 'rejected:' || reason, COUNT(*) FROM judged WHERE reason <> 'accepted' GROUP BY reason""",
        DAMAGED,
    ),
    "low_sales_alerts": ORACLE["low_sales_days"],
    "store_low_sales_days": _q(
        f"""
        SELECT c.date, {money('COALESCE(d.revenue, 0)')} AS daily_revenue
        FROM calendar c LEFT JOIN (
            SELECT CAST(ts AS DATE) AS date, SUM(revenue) AS revenue FROM sales
            WHERE store_id = '{SILVER_STORE}' GROUP BY 1) d ON c.date = d.date
        WHERE COALESCE(d.revenue, 0) < {STORE_ALERT}""",
        CALENDAR,
    ),
    "sales_growth_by_day": _q(
        f"""
        SELECT r.date, {money('r.revenue')} AS revenue, {money('r.mtd')} AS mtd,
               {money('COALESCE(p.mtd, 0)')} AS last_mtd, {growth('r.mtd', 'COALESCE(p.mtd, 0)')} AS growth
        FROM running r LEFT JOIN running p ON p.date = CAST(r.date - INTERVAL 1 MONTH AS DATE)""",
        CALENDAR.rstrip() + """,
by_day AS (
    SELECT c.date, CAST(COALESCE(d.revenue, 0) AS DECIMAL(38, 2)) AS revenue
    FROM calendar c LEFT JOIN (SELECT CAST(ts AS DATE) AS date, SUM(revenue) AS revenue FROM sales GROUP BY 1) d
      ON c.date = d.date
),
running AS (
    SELECT date, revenue, SUM(revenue) OVER (PARTITION BY date_trunc('month', date) ORDER BY date) AS mtd
    FROM by_day
)
""",
    ),
    "stream_resumed_demand": _q("SELECT * FROM emitted"),
    "stream_late_demand": _q("SELECT * FROM stored", LATE),
    "stream_late_report": _q(
        """
        SELECT w.window_start, w.window_end, w.product_id, w.total_qty,
               COALESCE(s.total_qty, 0) AS stored_qty, w.total_qty - COALESCE(s.total_qty, 0) AS late_qty
        FROM win w LEFT JOIN stored s USING (window_start, window_end, product_id)
        WHERE w.window_end <= (SELECT max(window_end) FROM stored) AND w.total_qty <> COALESCE(s.total_qty, 0)""",
        LATE,
    ),
    "stream_spikes_by_drain": _q(
        f"""
        SELECT 1 AS drain, * FROM ({_spikes('first_drain')})
        UNION ALL SELECT 2, * FROM ({_spikes('emitted')})""",
        HALVES.rstrip() + f""",
first_drain AS (
    SELECT * FROM ({_windows("SELECT * FROM early WHERE is_early")})
    WHERE window_end <= (SELECT max(ts) FROM early WHERE is_early) - INTERVAL 5 MINUTE
)
""",
    ),
    "stream_rate_limited": _q("SELECT *, TRUE AS several_batches FROM win"),
    "stream_bounded_wait": _q("SELECT *, TRUE AS stopped_first FROM emitted"),
}
ORACLE["csv_clean_sales"] = ORACLE["clean_sales"]
ORACLE["csv_rejected_rows"] = ORACLE["rejected_rows"]
