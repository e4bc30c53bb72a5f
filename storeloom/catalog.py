"""Every query by name, over the sample tables. Each takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom import schemas
from storeloom.functions import conform, day_of, full_name, net_of, percent_of, product_of
from storeloom.operators import (
    append,
    create_batched,
    create_if_absent,
    load_keyed,
    publish,
    replace,
    rows_of,
)
from storeloom.operators.sinks import BELOW
from storeloom.plans import daily, marts, warehouse
from storeloom.session import scratch_path
from storeloom.sources import (
    activities,
    land_activities,
    land_column_json,
    land_csv,
    land_json_records,
    land_table,
    sample_tables,
    write_activities,
)
from storeloom.streaming import load_new_files

Query = Callable[[SparkSession, str], DataFrame]


def _doubles(rows: DataFrame, *names: str) -> DataFrame:
    """Exact decimals as doubles, which every engine shows alike."""
    return rows.withColumns({name: F.col(name).cast("double") for name in names})


QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- warehouse tables ------------------------------------------------------------------------


def _warehouse_table(name: str) -> Query:
    return lambda spark, folder: warehouse.keyed(sample_tables.landing(spark, folder), name)


for _name in warehouse.LOADS:
    QUERIES[_name] = _warehouse_table(_name)


@query
def dim_coupons(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_coupons({"coupons": sample_tables.coupons_in_use(spark, folder)})


@query
def fact_sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = warehouse.fact_sales_lines(sample_tables.landing(spark, folder))
    return _doubles(lines, "price", "total_amount", "total_price")


# --- joins and expressions -------------------------------------------------------------------


@query
def sales_lines_join(spark: SparkSession, folder: str) -> DataFrame:
    landing = sample_tables.landing(spark, folder)
    items = warehouse.priced_items(landing["order_items"], landing["products"])
    heads = landing["orders"].select(F.col("id").alias("order_id"), "customer_id")
    lines = heads.join(items.withColumnRenamed("id", "item_id"), "order_id").select(
        "order_id", "customer_id", "item_id", "product_id", "amount", "price"
    )
    return _doubles(lines, "price")


@query
def coupon_left_join(spark: SparkSession, folder: str) -> DataFrame:
    landing = sample_tables.landing(spark, folder)
    coupons = landing["coupons"].withColumnRenamed("id", "known_coupon")
    return (
        landing["order_items"]
        .join(coupons, F.col("coupon_id") == F.col("known_coupon"), "left")
        .select(F.col("id").alias("item_id"), "coupon_id", "known_coupon", "discount_percent")
    )


@query
def product_category_join(spark: SparkSession, folder: str) -> DataFrame:
    landing = sample_tables.landing(spark, folder)
    categories = landing["product_category"].select(
        F.col("id").alias("category_id"), F.col("name").alias("category_name")
    )
    return (
        landing["products"]
        .join(categories, "category_id")
        .selectExpr("id as product_id", "name as product_name", "category_name")
    )


@query
def discount_math(spark: SparkSession, folder: str) -> DataFrame:
    landing = sample_tables.landing(spark, folder)
    items = warehouse.priced_items(landing["order_items"], landing["products"])
    coupons = landing["coupons"].withColumnRenamed("id", "known_coupon")
    lines = (
        items.withColumn("gross", F.expr(product_of("amount", "price", whole=False)))
        .join(coupons, F.col("coupon_id") == F.col("known_coupon"), "left")
        .select(
            F.col("id").alias("item_id"),
            "gross",
            F.coalesce("discount_percent", F.lit(0)).alias("percent"),
            percent_of("gross", "coalesce(discount_percent, 0)", whole=False).alias("discount"),
            net_of("gross", "known_coupon", "discount_percent", whole=False).alias("net"),
        )
    )
    return _doubles(lines, "gross", "discount", "net")


@query
def customer_full_name(spark: SparkSession, folder: str) -> DataFrame:
    customers = sample_tables.customers(spark, folder)
    return customers.select("id", full_name("first_name", "last_name").alias("customer_name"))


@query
def order_day_trunc(spark: SparkSession, folder: str) -> DataFrame:
    orders = sample_tables.orders(spark, folder).withColumn("day", day_of("created_at"))
    logins = sample_tables.login_attempts(spark, folder).withColumn("day", day_of("attempted_at"))
    return orders.selectExpr("'order' as kind", "id", "day").unionAll(
        logins.selectExpr("'login' as kind", "id", "day")
    )


@query
def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    """Halves round away from zero, timestamps lose the time of day, numbers become text."""
    items = sample_tables.read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_quantity") / 2).alias("half_quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("shipped"),
        F.col("l_suppkey").alias("supplier_code"),
    )
    return conform(
        items,
        "order_id INT, half_quantity INT, price BIGINT, shipped DATE, supplier_code VARCHAR(10)",
    )


# --- marts -----------------------------------------------------------------------------------


def _mart(build: Callable) -> Query:
    return lambda spark, folder: build(
        marts.with_totals(warehouse.star(sample_tables.landing(spark, folder)))
    )


for _name in (
    "burn_rate",
    "login_purchase_correlations",
    "login_purchase_true_items",
    "rfm",
    "top_spender",
    "product_sales_category",
    "customer_gender_sales",
):
    QUERIES[_name] = _mart(getattr(marts, _name))


# --- table writes ----------------------------------------------------------------------------


class ScratchTable:
    """A table over a fresh scratch folder. Its files outlive the name."""

    def __init__(self, spark: SparkSession, name: str, ddl: str | None = None):
        self.spark = spark
        self.location = scratch_path(spark, name)
        self.name = self.location.rsplit("/", 1)[1].replace("-", "_")
        if ddl:
            create_if_absent(spark, self.name, ddl, self.location)

    def __enter__(self) -> ScratchTable:
        return self

    def __exit__(self, *error) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        """The rows as they stand, readable after the name is dropped."""
        table = self.spark.table(self.name)
        location = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").where("col_name = 'Location'")
        return self.spark.read.schema(table.schema).parquet(location.first().data_type)


@query
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Two keyed loads. In the second, known ids come with another status and are ignored."""
    landing = sample_tables.landing(spark, folder)
    later = landing["orders"].select(
        (F.col("id") * 2).alias("id"),
        "customer_id",
        F.lower("status").alias("status"),
        "created_at",
    )
    ddl = schemas.wide(schemas.WAREHOUSE["dim_orders"])
    with ScratchTable(spark, "insert_if_absent", ddl) as table:
        for batch in (landing["orders"], later):
            load_keyed(warehouse.dim_orders({"orders": batch}), table.name, ddl)
        return table.rows()


@query
def fact_sales_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and items land in three batches, a third of the ids in each, and sales are loaded after
    every one. An order may land before its items or after them."""
    root = scratch_path(spark, "sales_in_batches")
    tag = root.rsplit("/", 1)[1].replace("-", "_")
    databases = [f"{tag}_{name}" for name in ("landing", "warehouse", "marts")]
    store = daily.Store(spark, root, *databases, strict=False)
    landing = sample_tables.landing(spark, folder)
    try:
        for batch in range(3):
            frames = {n: landing[n].where(f"id % 3 = {batch}") for n in ("orders", "order_items")}
            if not batch:
                frames |= {n: landing[n] for n in ("products", "coupons")}
            daily.load_landing(store, frames)
            daily.load_warehouse(store, ["fact_sales"])
        sales = spark.table(f"{store.warehouse}.fact_sales")
        sales.write.parquet(f"{root}/result")
        return spark.read.schema(sales.schema).parquet(f"{root}/result")
    finally:
        for database in databases:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@query
def landing_since_a_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Logins land in four batches; those after the second are read, with their number."""
    logins = sample_tables.login_attempts(spark, folder)
    with ScratchTable(spark, "login_batches") as table:
        create_batched(spark, table.name, schemas.LANDING["login_attempts"], table.location)
        try:
            for part in range(4):
                publish(logins.where(f"id % 4 = {part}"), table.name)
            later = rows_of(spark, table.name, after=2)
            place = scratch_path(spark, "later_logins")
            later.write.parquet(place)
            return spark.read.schema(later.schema).parquet(place)
        finally:
            spark.sql(f"DROP VIEW IF EXISTS {table.name}")
            spark.sql(f"DROP TABLE IF EXISTS {table.name}{BELOW}")


@query
def land_append_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Landing appends, so a second run of the same file leaves every row twice."""
    with ScratchTable(spark, "land_append_twice", schemas.LANDING["order_items"]) as table:
        for _ in range(2):
            append(sample_tables.landing(spark, folder)["order_items"], table.name)
        return table.rows()


@query
def mart_append_twice(spark: SparkSession, folder: str) -> DataFrame:
    """A mart has no key, so a second run adds a second copy."""
    ddl = schemas.wide(schemas.MARTS["top_spender"])
    with ScratchTable(spark, "mart_append_twice", ddl) as table:
        for _ in range(2):
            append(conform(QUERIES["top_spender"](spark, folder), ddl), table.name)
        return table.rows()


@query
def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """The second write leaves only its own rows."""
    ids = sample_tables.read(spark, folder, "events").select(F.col("event_id").alias("id"))
    with ScratchTable(spark, "replace_table") as table:
        for seed in (1, 2):
            replace(activities(ids, seed), table.name, table.location)
        return table.rows()


# --- landing ---------------------------------------------------------------------------------


@query
def land_customers_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Columns are found by name: the file has them in reverse."""
    rows = sample_tables.customers(spark, folder)
    place = scratch_path(spark, "customers")
    rows.select(*reversed(rows.columns)).write.csv(f"{place}/customer_1.csv", header=True)
    return land_csv(spark, f"{place}/customer_*.csv", schemas.LANDING["customers"])


@query
def land_login_attempts_json(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "login_attempts")
    rows = sample_tables.login_attempts(spark, folder)
    rows.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(
        f"{place}/login_attempts_1.json"
    )
    return land_json_records(
        spark, f"{place}/login_attempts_*.json", schemas.LANDING["login_attempts"]
    )


@query
def land_login_attempts_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a map per column, each of the logins of so many ids."""
    rows = sample_tables.login_attempts(spark, folder)
    cells = [
        F.map_from_entries(
            F.collect_list(F.struct(F.col("id").cast("string").alias("row"), F.col(name).alias("cell")))
        ).alias(name)
        for name in rows.columns
    ]
    texts = rows.withColumn("attempted_at", F.col("attempted_at").cast("string"))
    documents = texts.groupBy(F.expr("id div 5000").alias("document")).agg(*cells)
    place = scratch_path(spark, "login_documents")
    text = documents.select("document", F.to_json(F.struct(*rows.columns)).alias("value"))
    text.write.partitionBy("document").text(place)
    return land_column_json(spark, f"{place}/document=*", schemas.LANDING["login_attempts"])


@query
def land_coupons_json(spark: SparkSession, folder: str) -> DataFrame:
    """One document with a map per column. It holds the fixed coupons in use, ten at most."""
    cells = [
        F.map_from_entries(F.collect_list(F.struct(F.col("id").cast("string"), name))).alias(name)
        for name in ("id", "discount_percent")
    ]
    document = sample_tables.coupons_in_use(spark, folder).agg(*cells)
    place = scratch_path(spark, "coupons")
    document.write.json(f"{place}/coupons.json")
    return land_column_json(spark, f"{place}/coupons.json", schemas.LANDING["coupons"])


@query
def land_products(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "products")
    sample_tables.products(spark, folder).write.csv(place, header=True)
    return _doubles(land_csv(spark, place, schemas.FILED["products"]), "price")


@query
def land_product_category(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "product_category")
    sample_tables.product_category(spark, folder).write.csv(place, header=True)
    return land_csv(spark, place, schemas.LANDING["product_category"])


@query
def land_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """No columns are declared: all are kept as they come."""
    place = scratch_path(spark, "supplier")
    sample_tables.supplier(spark, folder).write.parquet(place)
    return land_table(spark, place)


@query
def land_supplier_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The export of the workbook: no columns are declared, all are kept as text."""
    place = scratch_path(spark, "supplier_csv")
    sample_tables.supplier(spark, folder).write.csv(place, header=True)
    return land_csv(spark, place)


@query
def land_orders_parquet(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "orders")
    sample_tables.orders(spark, folder).write.parquet(place)
    return land_table(spark, place, schemas.LANDING["orders"])


@query
def land_order_items(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "order_items")
    sample_tables.order_items(spark, folder).write.parquet(place)
    return land_table(spark, place, schemas.LANDING["order_items"], format="parquet")


@query
def load_new_order_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders land in two drops; each run loads only the files it has not seen."""
    place = scratch_path(spark, "order_files")
    ddl = schemas.wide(schemas.WAREHOUSE["dim_orders"])
    with ScratchTable(spark, "dim_orders", ddl) as table:
        for _ in range(2):
            sample_tables.orders(spark, folder).write.mode("append").parquet(f"{place}/drop")
            load_new_files(
                spark,
                f"{place}/drop",
                schemas.LANDING["orders"],
                lambda batch: warehouse.dim_orders({"orders": batch}),
                table.name,
                ddl,
                checkpoint=f"{place}/seen",
            ).awaitTermination()
        return table.rows()


# --- activities ------------------------------------------------------------------------------


def _one_per_event(spark: SparkSession, folder: str) -> DataFrame:
    ids = sample_tables.read(spark, folder, "events").select(F.col("event_id").alias("id"))
    return activities(ids, seed=0)


@query
def activities_synthetic(spark: SparkSession, folder: str) -> DataFrame:
    return _one_per_event(spark, folder)


@query
def activities_spine(spark: SparkSession, folder: str) -> DataFrame:
    return _one_per_event(spark, folder).select("timestamp")


@query
def activities_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "activity_data")
    write_activities(_one_per_event(spark, folder), path)
    return land_activities(spark, path)


@query
def activities_job(spark: SparkSession, folder: str) -> DataFrame:
    """Generated, written as CSV, landed, and put in place of the run before."""
    ids = sample_tables.read(spark, folder, "events").select(F.col("event_id").alias("id"))
    with ScratchTable(spark, "activities_job") as table:
        for seed in (1, 2):
            daily.load_activities(activities(ids, seed), table.name, table.location)
        return table.rows()
