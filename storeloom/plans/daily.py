"""Files to landing to warehouse to marts, over catalog tables.

Each stage writes Parquet tables that the next one reads. The loads of one stage do not
depend on each other and are submitted together.

Every landing run is a batch, and a partition of each table it lands in. A warehouse table records the
last batch it has taken in, and its next load reads only later ones. A load that is run again after a
failure reads its batches again and finds the keys it has loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from storeloom import schemas
from storeloom.frames import Frames
from storeloom.functions import conform
from storeloom.operators import (
    absent_from,
    append,
    batches,
    create_batched,
    load_keyed,
    replace,
    rows_of,
    take,
    taken,
)
from storeloom.plans import marts, warehouse
from storeloom.session import scratch_path
from storeloom.sources import (
    land_activities,
    land_column_json,
    land_csv,
    land_json_records,
    land_table,
    write_activities,
)

# The file names of each landing table. Workbooks arrive as CSV exports.
FILES = {
    "customers": "customer_*.csv",
    "login_attempts": "login_attempts_*.json",
    "coupons": "coupons.json",
    "products": "product.csv",
    "product_category": "product_category.csv",
    "supplier": "supplier.csv",
    "orders": "order.parquet",
    "order_items": "*.avro",
}


@dataclass(frozen=True)
class Store:
    """Where the tables live.

    ``strict`` declares the warehouse and marts with 32-bit and length-limited columns, so
    that a value beyond them fails its load; without it they are wide. ``buckets`` stores
    each warehouse table hashed by its key: a daily load then shuffles its batch only.
    """

    spark: SparkSession
    root: str
    landing: str = "landing"
    warehouse: str = "data_warehouse"
    marts: str = "data_marts"
    strict: bool = True
    buckets: int | None = None

    def location(self, database: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{database}/{table}"

    def ddl(self, declared: str) -> str:
        return declared if self.strict else schemas.wide(declared)

    def create(self, database: str, table: str, ddl: str, **options) -> str:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        name = f"{database}.{table}"
        create_batched(self.spark, name, ddl, self.location(database, table), **options)
        return name

    def newest(self) -> int:
        """The number of the last landing run."""
        tables = [f"{self.landing}.{name}" for name in FILES]
        return max((n for table in tables for n in batches(self.spark, table)), default=0)

    def landed(self, after: int = 0, upto: int | None = None) -> Frames:
        """The landing rows of the batches above ``after``, each with its batch."""
        read = lambda n: rows_of(self.spark, f"{self.landing}.{n}", after, upto)
        return Frames({n: lambda n=n: read(n) for n in schemas.LANDING})

    def tables(self, database: str, names: Iterable[str]) -> Frames:
        return Frames({n: lambda n=n: self.spark.table(f"{database}.{n}") for n in names})


def _together(load: Callable[[str], None], names: Iterable[str]) -> None:
    with ThreadPoolExecutor() as pool:
        list(pool.map(load, names))


def read_files(
    store: Store,
    folder: str,
    login_layout: str = "columns",
    item_format: str = "avro",
    files: Mapping[str, str] = FILES,
) -> Frames:
    """The files of ``folder`` as landing frames; ``None`` for a table without files.

    ``login_layout`` is "columns", "records" (one array per file) or "lines".
    """
    spark = store.spark

    def at(table: str) -> str:
        return f"{folder.rstrip('/')}/{files[table]}"

    def ddl(table: str) -> str:
        return schemas.FILED[table]

    def logins() -> DataFrame | None:
        if login_layout == "columns":
            return land_column_json(spark, at("login_attempts"), ddl("login_attempts"))
        lines = login_layout == "lines"
        return land_json_records(spark, at("login_attempts"), ddl("login_attempts"), lines)

    def exported(table: str) -> Callable[[], DataFrame | None]:
        return lambda: land_csv(spark, at(table), ddl(table))

    return Frames(
        {
            "customers": exported("customers"),
            "login_attempts": logins,
            "coupons": lambda: land_column_json(spark, at("coupons"), ddl("coupons")),
            "products": exported("products"),
            "product_category": exported("product_category"),
            "supplier": lambda: land_csv(spark, at("supplier")),
            "orders": lambda: land_table(spark, at("orders"), ddl("orders"), strict=True),
            "order_items": lambda: land_table(
                spark, at("order_items"), ddl("order_items"), item_format, strict=True
            ),
        }
    )


def load_landing(store: Store, frames: Frames) -> None:
    """Append every frame to its table, as a batch. Running it again appends the rows again."""
    batch = store.newest() + 1

    def load(name: str) -> None:
        rows = frames[name]
        if rows is None:
            return
        ddl = schemas.FILED.get(name) or ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
        )
        append(rows, store.create(store.landing, name, ddl), batch)

    _together(load, frames)


def without_loaded_orders(landing: Frames, sales: DataFrame) -> Frames:
    """``landing`` cut to the orders that ``sales`` lacks.

    A loaded order never changes, so its items need not be priced again. The ids of the new
    orders are written out first: Spark then knows their size, and on a usual day broadcasts
    them, so that the items of old orders are dropped where they are read.
    """
    if sales.isEmpty():
        return landing
    kind = sales.schema["order_id"].dataType.simpleString()
    ids = landing["orders"].selectExpr(f"cast(id as {kind}) as order_id")
    place = scratch_path(sales.sparkSession, "new_orders")
    absent_from(ids, sales, "order_id").distinct().write.parquet(place)
    new = sales.sparkSession.read.parquet(place).selectExpr("cast(order_id as bigint) as order_id")
    orders = landing["orders"].join(new.withColumnRenamed("order_id", "id"), "id", "left_semi")
    items = landing["order_items"].join(new, "order_id", "left_semi")
    return landing.replaced("orders", orders).replaced("order_items", items)


# Landing rows that wait for the rest of their sale: an order for an item of a known product, an
# item for its order. A row leaves when a sale of its order is loaded.
OPEN = {"orders": ("open_orders", "id"), "order_items": ("open_order_items", "order_id")}


def _with_open(store: Store, landing: Frames) -> Frames:
    """``landing`` with the rows of earlier batches that no sale has come of."""
    for name, (table, _) in OPEN.items():
        table = f"{store.warehouse}.{table}"
        if store.spark.catalog.tableExists(table):
            earlier = store.spark.table(table)
            landing = landing.replaced(name, landing[name].unionByName(earlier))
    return landing


def _keep_open(store: Store, landing: Frames, sales: DataFrame) -> None:
    """Store the rows of ``landing`` that no sale has come of."""
    loaded = sales.selectExpr("cast(order_id as bigint) as loaded")
    for name, (table, key) in OPEN.items():
        rows = landing[name].where(f"{key} is not null").dropDuplicates()
        waiting = rows.join(loaded, rows[key] == loaded.loaded, "left_anti")
        versions = store.location(store.warehouse, f"{table}.versions")
        replace(waiting, f"{store.warehouse}.{table}", versions)


def load_warehouse(store: Store, names: Iterable[str] = tuple(warehouse.LOADS)) -> None:
    """Insert the landing rows whose key is new, from the batches not taken in yet."""
    newest = store.newest()

    def load(name: str) -> None:
        ddl = store.ddl(schemas.WAREHOUSE[name])
        bucket = (schemas.key_of(name), store.buckets) if store.buckets else None
        table = store.create(store.warehouse, name, ddl, bucket=bucket)
        landing = store.landed(taken(store.spark, table), newest)
        if name == "fact_sales":
            # A new order may be for an old product, and its price is not among the dimensions.
            every = store.landed(upto=newest)
            landing = _with_open(store, landing)
            source = landing.replaced("products", warehouse.prices_as_found(every["products"]))
            source = source.replaced("coupons", every["coupons"])
            source = without_loaded_orders(source, store.spark.table(table))
        else:
            source = landing
        rows = warehouse.LOADS[name](source)
        load_keyed(rows, table, ddl, warehouse.landed(rows))
        if name == "fact_sales":
            _keep_open(store, landing, store.spark.table(table))
        take(store.spark, table, newest)

    _together(load, names)


def load_marts(store: Store, mode: str = "overwrite") -> None:
    """Compute the marts from the warehouse.

    ``overwrite`` leaves one copy. ``append`` adds a copy on every run, as tables without a
    key do. The sales of each customer feed four marts and are added up once.
    """
    star = store.tables(store.warehouse, schemas.WAREHOUSE)
    totals = scratch_path(store.spark, "sales_by_customer")
    marts.sales_by_customer(star["fact_sales"]).write.parquet(totals)
    shared = marts.with_totals(star)
    shared = shared.replaced("sales_by_customer", store.spark.read.parquet(totals))

    def load(name: str) -> None:
        ddl = store.ddl(schemas.MARTS[name])
        rows = conform(marts.unsorted(name)(shared), ddl)
        if mode == "append":
            append(rows, store.create(store.marts, name, ddl))
        else:
            store.spark.sql(f"CREATE DATABASE IF NOT EXISTS {store.marts}")
            versions = store.location(store.marts, f"{name}.versions")
            replace(rows, f"{store.marts}.{name}", versions, ddl)

    _together(load, marts.MARTS)


def load_activities(rows: DataFrame, table: str, location: str) -> None:
    """Activities to a CSV file, and the file in place of what the table holds. The file has no
    types, so times stay text in the table."""
    file = scratch_path(rows.sparkSession, "activity_data")
    write_activities(rows, file)
    replace(land_activities(rows.sparkSession, file), table, location)


def run(store: Store, frames: Frames, mart_mode: str = "overwrite") -> None:
    """All three stages, one after the other."""
    load_landing(store, frames)
    load_warehouse(store)
    load_marts(store, mart_mode)
