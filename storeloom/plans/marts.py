"""The star schema to the six marts.

Every mart adds up the sales of one customer or product before it joins, so that a customer
or product with a large share of all sales crosses the shuffle as one row per map task.
Ids are unique in every warehouse table; the sums below rely on that. The functions take the
tables of ``with_totals``.

Rows come sorted; ``unsorted`` gives a mart for a sink, which keeps no order. The name columns break
ties, which the sort key alone would leave in one range partition however many rows share a value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.frames import Frames
from storeloom.functions import day_of, full_name, percent_of

Tables = Mapping[str, DataFrame]
NAME = ("first_name", "last_name")


Mart = Callable[[Tables], DataFrame]


def ordered(*by: str) -> Callable[[Mart], Mart]:
    """A mart in this order: "-" before a column is descending with NULL first, "+" ascending with
    NULL last, none ascending with NULL first."""

    def key(name: str) -> Column:
        column = F.col(name.lstrip("+-"))
        if name[0] == "-":
            return column.desc_nulls_first()
        return column.asc_nulls_last() if name[0] == "+" else column.asc_nulls_first()

    def wrap(build: Mart) -> Mart:
        @wraps(build)
        def mart(star: Tables) -> DataFrame:
            return build(star).orderBy(*[key(name) for name in by])

        mart.rows = build
        return mart

    return wrap


def sales_by_customer(sales: DataFrame) -> DataFrame:
    """Totals of each customer's sales. Totals nobody reads are not computed."""
    return sales.groupBy(F.expr("customer_id as id")).agg(
        F.expr("count(order_id) as orders"),
        F.expr("sum(amount) as items"),
        F.expr("sum(total_amount) as gross"),
        F.expr("sum(total_price) as net"),
        F.expr("max(order_date) as last_order"),
    )


def logins_by_customer(logins: DataFrame) -> DataFrame:
    return logins.groupBy(F.expr("customer_id as id")).agg(
        F.expr("count(id) as logins"),
        F.expr("min(attempted_at) as first_login"),
        F.expr("max(attempted_at) as last_login"),
    )


def with_totals(star: Tables) -> Frames:
    """The warehouse tables with the per-customer totals that several marts share."""
    return Frames(
        {
            **{name: lambda name=name: star[name] for name in star},
            "sales_by_customer": lambda: sales_by_customer(star["fact_sales"]),
            "logins_by_customer": lambda: logins_by_customer(star["fact_login_attempts"]),
        }
    )


@ordered("+day")
def burn_rate(star: Tables) -> DataFrame:
    """Discount given per day, truncated for each sale before it is added."""
    sales = star["fact_sales"].select("product_id", "coupon_id", "order_date", "amount")
    prices = star["dim_products"].selectExpr("id as product_id", "cast(price as bigint) as price")
    percents = star["dim_coupons"].selectExpr("id as coupon_id", "discount_percent")
    discount = percent_of("price * amount", "coalesce(discount_percent, 0)")
    return (
        sales.join(prices, "product_id")
        .join(percents, "coupon_id", "left")
        .groupBy(day_of("order_date").alias("day"))
        .agg(F.sum(discount).alias("total_discount_given"))
    )


def _logins_and_sales(star: Tables) -> DataFrame:
    """Customers who logged in, with their login totals and, if any, their sales totals."""
    return (
        star["dim_customers"]
        .select("id", *NAME)
        .join(star["logins_by_customer"], "id")
        .join(star["sales_by_customer"], "id", "left")
    )


def _by_name(totals: DataFrame, items: Column) -> DataFrame:
    return (
        totals.groupBy(*NAME)
        .agg(
            F.min("first_login").alias("first_login"),
            F.max("last_login").alias("last_login"),
            F.sum("logins").alias("login_count"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
            items.alias("total_items_bought"),
        )
        .select(
            full_name(*NAME).alias("customer_name"),
            "first_login",
            "last_login",
            "login_count",
            "total_orders",
            "total_items_bought",
        )
    )


@ordered("-login_count", "customer_name")
def login_purchase_correlations(star: Tables) -> DataFrame:
    """Logins and purchases per customer name.

    As defined, the items are counted once for every login of the customer. The product of
    the two totals gives that without pairing each login with each sale.
    """
    return _by_name(_logins_and_sales(star), F.sum(F.col("logins") * F.col("items")))


@ordered("-login_count", "customer_name")
def login_purchase_true_items(star: Tables) -> DataFrame:
    """The same mart with every item counted once."""
    return _by_name(_logins_and_sales(star), F.sum("items"))


@ordered("-last_purchase_date", "-frequency", "-monetary", "customer_name")
def rfm(star: Tables) -> DataFrame:
    """Last purchase, number of orders and gross sales per customer name."""
    return (
        star["dim_customers"]
        .select("id", *NAME)
        .join(star["sales_by_customer"], "id")
        .groupBy(*NAME)
        .agg(
            day_of("max(last_order)").alias("last_purchase_date"),
            F.sum("orders").alias("frequency"),
            F.sum("gross").alias("monetary"),
        )
        .select(
            full_name(*NAME).alias("customer_name"), "last_purchase_date", "frequency", "monetary"
        )
    )


@ordered("-total_spending", "customer_name")
def top_spender(star: Tables) -> DataFrame:
    """Net sales per customer name, highest first. Every customer with a sale is listed."""
    return (
        star["dim_customers"]
        .select("id", *NAME)
        .join(star["sales_by_customer"], "id")
        .groupBy(*NAME)
        .agg(F.sum("net").alias("total_spending"))
        .select(full_name(*NAME).alias("customer_name"), "total_spending")
    )


@ordered("-total_sales", "product_name", "category_name")
def product_sales_category(star: Tables) -> DataFrame:
    """Gross sales per product name and category name."""
    by_product = star["fact_sales"].groupBy("product_id").agg(F.sum("total_amount").alias("gross"))
    named = star["dim_products"].selectExpr(
        "id as product_id", "name as product_name", "category_id"
    )
    categories = star["dim_category"].selectExpr("id as category_id", "name as category_name")
    return (
        by_product.join(named, "product_id")
        .join(categories, "category_id")
        .groupBy("product_name", "category_name")
        .agg(F.sum("gross").alias("total_sales"))
    )


def customer_gender_sales(star: Tables) -> DataFrame:
    """Net sales per gender; customers without one are a group."""
    return (
        star["dim_customers"]
        .select("id", "gender")
        .join(star["sales_by_customer"], "id")
        .groupBy("gender")
        .agg(F.sum("net").alias("total_sales"))
    )


MARTS = {
    "burn_rate_analisis": burn_rate,
    "login_purchase_correlations": login_purchase_correlations,
    "RFM_analisis": rfm,
    "top_spender": top_spender,
    "product_sales_category": product_sales_category,
    "customer_gender_sales": customer_gender_sales,
}


def unsorted(name: str) -> Mart:
    """The builder of a mart without its order."""
    return getattr(MARTS[name], "rows", MARTS[name])
