"""Landing tables cut from the TPC-H-like sample tables.

The sample tables have no order-item id, category id or coupon. Those are made here by rules
that need no shuffle and no numbering of rows within a group, so a large group costs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.frames import Frames

# Coupon n takes off n times ten per cent.
COUPONS = 10
PERCENT_STEP = 10

# Two numbers per file, so at most 16 MB are broadcast.
MAX_BROADCAST_FILES = 1_000_000

# The columns used of each sample table. Naming them saves a look into the files.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{folder}/{table}.parquet")


def name_digest(column: str) -> str:
    """60 bits of the MD5 of a name, as an id."""
    return f"cast(conv(substring(md5({column}), 1, 15), 16, 10) as bigint)"


# Coupon n for a discount of n per cent, none for zero.
COUPON = "nullif(cast(round(l_discount * 100) as bigint), 0L)"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").selectExpr(
        "c_custkey as id",
        "c_mktsegment as first_name",
        "c_name as last_name",
        "substring(c_mktsegment, 1, 1) as gender",
        "cast(null as string) as address",
        "cast(null as string) as zip_code",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").selectExpr(
        "p_partkey as id",
        "p_name as name",
        "cast(p_retailprice as decimal(16,4)) as price",
        f"{name_digest('p_type')} as category_id",
        "cast(null as bigint) as supplier_id",
    )


def product_category(spark: SparkSession, folder: str) -> DataFrame:
    names = read(spark, folder, "part").selectExpr("p_type as name").distinct()
    return names.selectExpr(f"{name_digest('name')} as id", "name")


def supplier(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").selectExpr(
        "o_orderkey as id",
        "o_custkey as customer_id",
        "o_orderstatus as status",
        "o_orderdate as created_at",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """The id is the row's place in the table, from 1."""
    lines = read(spark, folder, "lineitem")
    place = "_metadata.row_index + 1"
    files = len(lines.inputFiles())
    if files > 1:
        # Rows before each file: one row per file, from the file footers alone. Each line
        # finds its file by a number, which is cheaper to compare than the name.
        file = "xxhash64(_metadata.file_path) as file"
        per_file = lines.groupBy(F.expr(file), "_metadata.file_path").count()
        before = "sum(count) over (order by file_path) - count as rows_before"
        offsets = per_file.selectExpr("file", before)
        if files <= MAX_BROADCAST_FILES:
            offsets = F.broadcast(offsets)
        lines = lines.selectExpr("*", file, "_metadata.row_index").join(offsets, "file")
        place = "rows_before + row_index + 1"
    return lines.selectExpr(
        f"{place} as id",
        "l_orderkey as order_id",
        "l_partkey as product_id",
        # A bare cast of a double rounds on some engines and truncates on others.
        "cast(round(l_quantity) as bigint) as amount",
        f"{COUPON} as coupon_id",
    )


def coupons(spark: SparkSession) -> DataFrame:
    return spark.range(1, COUPONS + 1).selectExpr(
        "id", f"id * {PERCENT_STEP} as discount_percent"
    )


def coupons_in_use(spark: SparkSession, folder: str) -> DataFrame:
    """The coupons that some order line carries."""
    used = read(spark, folder, "lineitem").selectExpr(f"{COUPON} as id").distinct()
    return coupons(spark).join(used, "id", "left_semi")


def login_attempts(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").selectExpr(
        "event_id as id",
        "user_id as customer_id",
        "event_type <> 'error' as login_successful",
        "ts as attempted_at",
    )


LANDED = {
    "customers": customers,
    "login_attempts": login_attempts,
    "coupons": lambda spark, folder: coupons(spark),
    "products": products,
    "product_category": product_category,
    "orders": orders,
    "order_items": order_items,
}


def landing(spark: SparkSession, folder: str) -> Frames:
    """The landing tables the warehouse reads. Only those asked for are opened."""
    return Frames(
        {name: lambda build=build: build(spark, folder) for name, build in LANDED.items()}
    )
