"""The SQL that each query must agree with, for a second engine over the same tables.

The SQL is written the plain way: full joins before aggregation, distinct counts, a window for
each key. None of the rewrites of the Spark side appear here.
"""

from __future__ import annotations

LANDED = {
    "l_customers": """
        SELECT c_custkey AS id, c_mktsegment AS first_name, c_name AS last_name,
               substr(c_mktsegment, 1, 1) AS gender,
               CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS zip_code
        FROM customer""",
    "l_products": """
        SELECT p_partkey AS id, p_name AS name, CAST(p_retailprice AS DECIMAL(16, 4)) AS price,
               CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS category_id,
               CAST(NULL AS BIGINT) AS supplier_id
        FROM part""",
    "l_category": """
        SELECT DISTINCT CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS id, p_type AS name
        FROM part""",
    "l_orders": """
        SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus AS status,
               o_orderdate AS created_at
        FROM orders""",
    "l_items": """
        SELECT row_number() OVER () AS id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(round(l_quantity) AS BIGINT) AS amount,
               nullif(CAST(round(l_discount * 100) AS BIGINT), 0) AS coupon_id
        FROM lineitem""",
    "l_coupons": """
        SELECT id, id * 10 AS discount_percent FROM (SELECT unnest(range(1, 11)) AS id)""",
    "l_coupons_in_use": """
        SELECT id, id * 10 AS discount_percent
        FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS id FROM lineitem)
        WHERE id BETWEEN 1 AND 10""",
    "l_logins": """
        SELECT event_id AS id, user_id AS customer_id, event_type <> 'error' AS login_successful,
               ts AS attempted_at
        FROM events""",
}


def keyed(select: str, key: str, *order: str) -> str:
    """One row per key, the lowest in the given order."""
    by = ", ".join(f"{column} ASC NULLS FIRST" for column in order)
    return f"{select} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {by}) = 1"


# What every item costs, with the share that its coupon takes off. Prices are exact decimals.
LINES = """
    WITH costs AS (
        SELECT l_items.id AS item_id, order_id, product_id, coupon_id, amount, price,
               CAST(amount AS DECIMAL(12, 0)) * price AS gross
        FROM l_items, l_products WHERE product_id = l_products.id),
    shares AS (
        SELECT id AS coupon_id, discount_percent,
               CAST(discount_percent AS DECIMAL(5, 0)) * CAST(0.01 AS DECIMAL(2, 2)) AS share
        FROM l_coupons)
    SELECT order_id, customer_id, product_id, costs.coupon_id, status AS order_status,
           CAST(created_at AS DATE) AS order_date, amount, price, gross AS total_amount,
           ifnull(discount_percent, 0) AS discount_percent,
           gross - ifnull(gross * share, 0) AS total_price, item_id
    FROM costs LEFT JOIN shares USING (coupon_id), l_orders WHERE order_id = l_orders.id"""

# Decimals that a query returns as they are; those assigned to a column are rounded instead.
AS_DOUBLE = "CAST({0} AS DOUBLE) AS {0}".format
ROUNDED = "CAST(round({0}, 0) AS BIGINT) AS {0}".format

SALES = f"""
    SELECT order_id, customer_id, product_id, coupon_id, order_status, order_date, amount,
           {ROUNDED("price")}, {ROUNDED("total_amount")}, discount_percent, {ROUNDED("total_price")}
    FROM ({LINES})
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {{order}}) = 1"""

STAR = {
    "dim_customers": keyed(
        "SELECT id, first_name, last_name, gender, address, zip_code FROM l_customers",
        "id", "first_name", "last_name", "gender", "address", "zip_code",
    ),
    "dim_orders": keyed(
        "SELECT id, customer_id, status, CAST(created_at AS DATE) AS created_at FROM l_orders",
        "id", "customer_id", "status", "CAST(created_at AS DATE)",
    ),
    "dim_products": keyed(
        f"SELECT id, name, {ROUNDED('price')}, category_id, supplier_id FROM l_products",
        "id", "name", "round(price, 0)", "category_id", "supplier_id",
    ),
    "dim_order_items": keyed(
        "SELECT id, order_id, product_id, amount, coupon_id FROM l_items",
        "id", "order_id", "product_id", "amount", "coupon_id",
    ),
    "dim_category": keyed("SELECT id, name FROM l_category", "id", "name"),
    "dim_coupons": "SELECT id, discount_percent FROM l_coupons",
    "fact_login_attempts": keyed(
        "SELECT id, customer_id, login_successful, attempted_at FROM l_logins",
        "id", "customer_id", "login_successful", "attempted_at",
    ),
    "fact_sales": SALES.format(order="item_id"),
}

BESIDE = {
    # Every login of a customer beside every sale of the same one.
    "beside": """
        SELECT people.*, visit.id AS login, attempted_at, order_id, amount
        FROM dim_customers AS people, fact_login_attempts AS visit
        LEFT JOIN fact_sales AS sale ON sale.customer_id = visit.customer_id
        WHERE visit.customer_id = people.id""",
    # The sales under the name of their customer.
    "named": """
        SELECT first_name, last_name, gender, fact_sales.*
        FROM fact_sales, dim_customers WHERE dim_customers.id = fact_sales.customer_id""",
}

LOGIN_PURCHASE = """
    SELECT any_value(concat(first_name, ' ', last_name)) AS customer_name,
           min(attempted_at) AS first_login, max(attempted_at) AS last_login,
           count(DISTINCT login) AS login_count, count(DISTINCT order_id) AS total_orders,
           CAST(sum(amount) AS BIGINT) AS total_items_bought
    FROM beside GROUP BY first_name, last_name"""

TRUE_ITEMS = """
    SELECT concat(n.first_name, ' ', n.last_name) AS customer_name, n.first_login, n.last_login,
           n.login_count, coalesce(b.total_orders, 0) AS total_orders, b.total_items_bought
    FROM (SELECT c.first_name, c.last_name, min(l.attempted_at) AS first_login,
                 max(l.attempted_at) AS last_login, count(*) AS login_count
          FROM dim_customers c JOIN fact_login_attempts l ON l.customer_id = c.id
          GROUP BY c.first_name, c.last_name) n
    LEFT JOIN (SELECT c.first_name, c.last_name, count(*) AS total_orders,
                      CAST(sum(s.amount) AS BIGINT) AS total_items_bought
               FROM dim_customers c JOIN fact_sales s ON s.customer_id = c.id
               WHERE c.id IN (SELECT customer_id FROM fact_login_attempts)
               GROUP BY c.first_name, c.last_name) b
      ON b.first_name IS NOT DISTINCT FROM n.first_name
     AND b.last_name IS NOT DISTINCT FROM n.last_name"""

MARTS = {
    "burn_rate": """
        SELECT date_trunc('day', CAST(s.order_date AS TIMESTAMP)) AS day,
               CAST(sum((p.price * s.amount * coalesce(c.discount_percent, 0)) // 100) AS BIGINT)
                   AS total_discount_given
        FROM fact_sales s
        JOIN dim_products p ON p.id = s.product_id
        LEFT JOIN dim_coupons c ON c.id = s.coupon_id
        GROUP BY 1 ORDER BY 1""",
    "login_purchase_correlations": LOGIN_PURCHASE + " ORDER BY login_count DESC",
    "login_purchase_true_items": TRUE_ITEMS + " ORDER BY login_count DESC",
    "rfm": """
        SELECT any_value(concat(first_name, ' ', last_name)) AS customer_name,
               CAST(max(order_date) AS TIMESTAMP) AS last_purchase_date,
               count(*) AS frequency, CAST(sum(total_amount) AS BIGINT) AS monetary
        FROM named GROUP BY first_name, last_name""",
    "top_spender": """
        SELECT any_value(concat(first_name, ' ', last_name)) AS customer_name,
               CAST(sum(total_price) AS BIGINT) AS total_spending
        FROM named GROUP BY first_name, last_name""",
    "product_sales_category": """
        SELECT p.name AS product_name, g.name AS category_name,
               CAST(sum(s.total_amount) AS BIGINT) AS total_sales
        FROM fact_sales s
        JOIN dim_products p ON p.id = s.product_id
        JOIN dim_category g ON g.id = p.category_id
        GROUP BY p.name, g.name
        ORDER BY total_sales DESC NULLS FIRST""",
    "customer_gender_sales": """
        SELECT gender, CAST(sum(total_price) AS BIGINT) AS total_sales FROM named GROUP BY gender""",
}


def _draw(values: str, label: str, seed: int) -> str:
    digest = f"md5('{label}-{seed}-' || event_id)"
    return f"({values})[1 + CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % 4]"


def activities(seed: int, timestamp: str) -> str:
    return f"""
        SELECT {_draw("['walk', 'run', 'sit', 'sleep']", "action", seed)} AS action_type,
               {timestamp} AS timestamp,
               CAST({_draw("[1, 2, 3, 4]", "person", seed)} AS BIGINT) AS person_id
        FROM events"""


MINUTE = "TIMESTAMP '2021-01-01 00:00:00' + to_minutes(event_id)"

OTHERS = {
    "fact_sales_in_batches": SALES.format(order="item_id % 3, item_id"),
    "landing_since_a_batch": """
        SELECT *, id % 4 + 1 AS landed_batch FROM l_logins WHERE id % 4 + 1 > 2""",
    "fact_sales_lines": f"""
        SELECT * EXCLUDE (item_id, price, total_amount, total_price),
               {AS_DOUBLE("price")}, {AS_DOUBLE("total_amount")}, {AS_DOUBLE("total_price")}
        FROM ({LINES})""",
    "sales_lines_join": """
        SELECT o.id AS order_id, o.customer_id, i.id AS item_id, i.product_id, i.amount,
               CAST(p.price AS DOUBLE) AS price
        FROM l_orders o
        JOIN l_items i ON i.order_id = o.id
        JOIN l_products p ON p.id = i.product_id""",
    "coupon_left_join": """
        SELECT i.id AS item_id, i.coupon_id, c.id AS known_coupon, c.discount_percent
        FROM l_items i LEFT JOIN l_coupons c ON c.id = i.coupon_id""",
    "product_category_join": """
        SELECT p.id AS product_id, p.name AS product_name, g.name AS category_name
        FROM l_products p JOIN l_category g ON g.id = p.category_id""",
    "discount_math": f"""
        SELECT item_id, {AS_DOUBLE("gross")}, percent, CAST(gross * share AS DOUBLE) AS discount,
               CAST(gross - CASE WHEN known THEN gross * share ELSE 0 END AS DOUBLE) AS net
        FROM (SELECT i.id AS item_id, CAST(i.amount AS DECIMAL(12, 0)) * p.price AS gross,
                     c.id IS NOT NULL AS known, coalesce(c.discount_percent, 0) AS percent,
                     CAST(coalesce(c.discount_percent, 0) AS DECIMAL(5, 0))
                         * CAST(0.01 AS DECIMAL(2, 2)) AS share
              FROM l_items i JOIN l_products p ON p.id = i.product_id
              LEFT JOIN l_coupons c ON c.id = i.coupon_id)""",
    "customer_full_name": """
        SELECT id, concat(first_name, ' ', last_name) AS customer_name FROM l_customers""",
    "order_day_trunc": """
        SELECT 'order' AS kind, id, CAST(date_trunc('day', created_at) AS TIMESTAMP) AS day
        FROM l_orders
        UNION ALL
        SELECT 'login', id, CAST(date_trunc('day', attempted_at) AS TIMESTAMP) FROM l_logins""",
    "conform_types": """
        SELECT CAST(l_orderkey AS INTEGER) AS order_id,
               CAST(round(l_quantity / 2, 0) AS INTEGER) AS half_quantity,
               CAST(round(l_extendedprice, 0) AS BIGINT) AS price,
               CAST(l_shipdate AS DATE) AS shipped, CAST(l_suppkey AS VARCHAR) AS supplier_code
        FROM lineitem""",
    "insert_if_absent": """
        SELECT id, customer_id, status, CAST(created_at AS DATE) AS created_at FROM l_orders
        UNION ALL
        SELECT id * 2, customer_id, lower(status), CAST(created_at AS DATE) FROM l_orders
        WHERE id * 2 NOT IN (SELECT id FROM l_orders)""",
    "load_new_order_files": f"SELECT * FROM ({STAR['dim_orders']})",
    "land_append_twice": "SELECT * FROM l_items UNION ALL SELECT * FROM l_items",
    "mart_append_twice": f"""
        SELECT * FROM ({MARTS["top_spender"]}) UNION ALL SELECT * FROM ({MARTS["top_spender"]})""",
    "replace_table": activities(2, MINUTE),
    "land_customers_csv": "SELECT * FROM l_customers",
    "land_login_attempts_json": "SELECT * FROM l_logins",
    "land_coupons_json": "SELECT * FROM l_coupons_in_use",
    "land_login_attempts_columns": "SELECT * FROM l_logins",
    "land_products": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM l_products",
    "land_product_category": "SELECT * FROM l_category",
    "land_supplier": "SELECT * FROM supplier",
    "land_supplier_csv": """
        SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
               CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal
        FROM supplier""",
    "land_orders_parquet": "SELECT * FROM l_orders",
    "land_order_items": "SELECT * FROM l_items",
    "activities_synthetic": activities(0, MINUTE),
    "activities_spine": f"SELECT {MINUTE} AS timestamp FROM events",
    "activities_job": activities(2, f"strftime({MINUTE}, '%Y-%m-%d %H:%M:%S')"),
    "activities_roundtrip": activities(0, f"strftime({MINUTE}, '%Y-%m-%d %H:%M:%S')"),
}


def _with(body: str, *groups: dict[str, str]) -> str:
    parts = [f"{name} AS ({sql})" for group in groups for name, sql in group.items()]
    return f"WITH {', '.join(parts)} {body}"


SQL = {
    **{name: _with(f"SELECT * FROM {name}", LANDED, STAR) for name in STAR},
    **{name: _with(sql, LANDED, STAR, BESIDE) for name, sql in (MARTS | OTHERS).items()},
    "dim_coupons": _with("SELECT * FROM l_coupons_in_use", LANDED),
}
