"""Landing tables to the star schema.

Every function takes landing frames and gives the rows to load; ``star`` gives the tables as
they stand after one keyed load of each. Where landing frames carry the number of the batch they
came in, the rows do too, and the first landed row of a key is its first.

Prices are integers or decimals, as their column says. Amounts of integer prices are integers and
percentages of them are truncated; those of decimal prices are exact until they are assigned to an
integer column, which rounds them once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom import schemas
from storeloom.frames import Frames
from storeloom.functions import conform, net_of, product_of
from storeloom.operators.keyed import first_wins, lookup
from storeloom.operators.sinks import BATCH

Tables = Mapping[str, DataFrame]


def landed(rows: DataFrame) -> list[str]:
    """The column that orders rows by landing, if they have it."""
    return [BATCH] if BATCH in rows.columns else []


def _project(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.selectExpr(*columns, *landed(rows))


def dim_customers(landing: Tables) -> DataFrame:
    return _project(
        landing["customers"], "id", "first_name", "last_name", "gender", "address", "zip_code"
    )


def dim_orders(landing: Tables) -> DataFrame:
    return _project(
        landing["orders"], "id", "customer_id", "status", "cast(created_at as date) as created_at"
    )


def dim_coupons(landing: Tables) -> DataFrame:
    return _project(landing["coupons"], "id", "discount_percent")


def dim_products(landing: Tables) -> DataFrame:
    return _project(landing["products"], "id", "name", "price", "category_id", "supplier_id")


def dim_order_items(landing: Tables) -> DataFrame:
    return _project(
        landing["order_items"], "id", "order_id", "product_id", "amount", "coupon_id"
    )


def dim_category(landing: Tables) -> DataFrame:
    return _project(landing["product_category"], "id", "name")


def fact_login_attempts(landing: Tables) -> DataFrame:
    return _project(
        landing["login_attempts"], "id", "customer_id", "login_successful", "attempted_at"
    )


def priced_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the price of their product; an item of an unknown product is no sale."""
    return items.join(products.selectExpr("id as product_id", "price"), "product_id")


def prices_as_found(products: DataFrame) -> DataFrame:
    """Products with integer prices if every price is there and whole, as a table made from such
    cells has them. Reads the column of prices once."""
    if isinstance(products.schema["price"].dataType, T.IntegralType):
        return products
    cents = products.where("price is null or price <> floor(price)").limit(1)
    return products if cents.count() else products.withColumn("price", F.expr("cast(price as bigint)"))


def sales_lines(orders: DataFrame, items: DataFrame, coupons: DataFrame) -> DataFrame:
    """Orders with their priced items, and the discount of a known coupon."""
    whole = isinstance(items.schema["price"].dataType, T.IntegralType)
    heads = orders.selectExpr(
        "id as order_id",
        "customer_id",
        "status as order_status",
        "cast(created_at as date) as order_date",
    )
    known = coupons.selectExpr("id as known_coupon", "discount_percent as percent")
    gross = product_of("amount", "price", whole)
    return (
        heads.join(items, "order_id")
        .join(known, F.expr("coupon_id = known_coupon"), "left")
        .select(
            *["order_id", "customer_id", "product_id", "coupon_id", "order_status", "order_date"],
            *["amount", "price"],
            F.expr(gross).alias("total_amount"),
            F.expr("coalesce(percent, 0)").alias("discount_percent"),
            net_of(gross, "known_coupon", "percent", whole).alias("total_price"),
        )
    )


def fact_sales_lines(landing: Tables) -> DataFrame:
    """One row per order item, before the key of ``fact_sales`` is applied."""
    items = priced_items(landing["order_items"].drop("id"), landing["products"])
    return sales_lines(landing["orders"], items, landing["coupons"])


def fact_sales(landing: Tables) -> DataFrame:
    """One row per order: the line of its first landed and lowest item id, as the key demands.

    The items are cut to one per order before they meet the orders. At most one row per
    order and map task is shuffled, so an order with very many items is never gathered in
    one place, and the join that follows is one to one.

    Landing appends, so a file landed twice leaves copies; each other side is cut to one
    row per id first.
    """
    # The first (name, price) has the price of the row that dim_products keeps.
    products = _project(landing["products"], "id", "name", "price")
    products = lookup(products, "id", landed(products)).select("id", "price")
    items = priced_items(landing["order_items"], products)
    first_items = first_wins(items, "order_id", [*landed(items), "id"]).drop("id", BATCH)
    orders, coupons = dim_orders(landing), dim_coupons(landing)
    orders = first_wins(orders, "id", landed(orders)).drop(BATCH)
    return sales_lines(orders, first_items, lookup(coupons, "id", landed(coupons)).drop(BATCH))


LOADS = {
    "fact_sales": fact_sales,
    "fact_login_attempts": fact_login_attempts,
    "dim_customers": dim_customers,
    "dim_orders": dim_orders,
    "dim_coupons": dim_coupons,
    "dim_products": dim_products,
    "dim_order_items": dim_order_items,
    "dim_category": dim_category,
}


LOOKUPS = {"dim_products", "dim_coupons", "dim_category"}


def _assigned(rows: DataFrame, name: str) -> DataFrame:
    """Rows as the columns of the table take them, without limits of size and length."""
    return conform(rows, schemas.wide(schemas.WAREHOUSE[name]), landed(rows))


def keyed(landing: Tables, name: str) -> DataFrame:
    """One warehouse table as a single load from ``landing`` leaves it, not yet written."""
    rows = _assigned(LOADS[name](landing), name)
    if name == "fact_sales":
        return rows
    return first_wins(rows, schemas.key_of(name), landed(rows)).drop(BATCH)


def star(landing: Tables) -> Frames:
    """All warehouse tables, for marts straight from ``landing``."""

    def table(name: str) -> DataFrame:
        if name in LOOKUPS:
            rows = _assigned(LOADS[name](landing), name)
            return lookup(rows, schemas.key_of(name), landed(rows)).drop(BATCH)
        return keyed(landing, name)

    return Frames({name: lambda name=name: table(name) for name in LOADS})
