"""Declared columns of every table, as Spark DDL.

The first column of each warehouse table is its key. Mart tables have no key.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Landing types are chosen to hold any value the warehouse accepts; ids are wide.
LANDING: dict[str, str] = {
    "customers": "id BIGINT, first_name STRING, last_name STRING, gender STRING, "
    "address STRING, zip_code STRING",
    "login_attempts": "id BIGINT, customer_id BIGINT, login_successful BOOLEAN, "
    "attempted_at TIMESTAMP_NTZ",
    "coupons": "id BIGINT, discount_percent BIGINT",
    "products": "id BIGINT, name STRING, price BIGINT, category_id BIGINT, supplier_id BIGINT",
    "product_category": "id BIGINT, name STRING",
    "orders": "id BIGINT, customer_id BIGINT, status STRING, created_at TIMESTAMP_NTZ",
    "order_items": "id BIGINT, order_id BIGINT, product_id BIGINT, amount BIGINT, "
    "coupon_id BIGINT",
}

# Prices in files may have cents. They stay exact up to the assignment to a warehouse column.
FILED: dict[str, str] = {
    **LANDING,
    "products": "id BIGINT, name STRING, price DECIMAL(16,4), category_id BIGINT, "
    "supplier_id BIGINT",
}

# The column names and types the warehouse and mart tables are declared with.
WAREHOUSE: dict[str, str] = {
    "fact_sales": "order_id INT, customer_id INT, product_id INT, coupon_id INT, "
    "order_status VARCHAR(50), order_date DATE, amount INT, price INT, total_amount INT, "
    "discount_percent INT, total_price INT",
    "fact_login_attempts": "id INT, customer_id INT, login_successful BOOLEAN, "
    "attempted_at TIMESTAMP_NTZ",
    "dim_customers": "id INT, first_name VARCHAR(50), last_name VARCHAR(50), gender CHAR(1), "
    "address VARCHAR(100), zip_code VARCHAR(10)",
    "dim_orders": "id INT, customer_id INT, status VARCHAR(20), created_at DATE",
    "dim_coupons": "id INT, discount_percent INT",
    "dim_products": "id INT, name VARCHAR(30), price INT, category_id INT, supplier_id INT",
    "dim_order_items": "id INT, order_id INT, product_id INT, amount INT, coupon_id INT",
    "dim_category": "id INT, name VARCHAR(50)",
}
MARTS: dict[str, str] = {
    "burn_rate_analisis": "day TIMESTAMP_NTZ, total_discount_given INT",
    "login_purchase_correlations": "customer_name VARCHAR(50), first_login TIMESTAMP_NTZ, "
    "last_login TIMESTAMP_NTZ, login_count INT, total_orders INT, total_items_bought INT",
    "RFM_analisis": "customer_name VARCHAR(50), last_purchase_date TIMESTAMP_NTZ, "
    "frequency INT, monetary INT",
    "top_spender": "customer_name VARCHAR(50), total_spending INT",
    "product_sales_category": "product_name VARCHAR(50), category_name VARCHAR(50), "
    "total_sales INT",
    "customer_gender_sales": "gender VARCHAR(50), total_sales INT",
}


def wide(ddl: str) -> str:
    """The same columns without the INT and length limits, for ids past two billion."""
    ddl = re.sub(r"\bINT\b", "BIGINT", ddl)
    return re.sub(r"\b(?:VAR)?CHAR\(\d+\)", "STRING", ddl)


def columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a DDL string."""
    return [tuple(part.split(" ", 1)) for part in ddl.split(", ")]


def names(ddl: str) -> list[str]:
    return [name for name, _ in columns(ddl)]


def key_of(table: str) -> str:
    return names(WAREHOUSE[table])[0]


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
