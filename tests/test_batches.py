"""Landing batches: published in one step, read once, first landed first; open sales; cents."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storeloom import schemas
from storeloom.operators import (
    BATCH,
    append,
    batches,
    create_batched,
    load_keyed,
    publish,
    replace,
    rows_of,
    sinks,
    take,
    taken,
)
from storeloom.plans import daily, marts, warehouse
from storeloom.sources import activities

DIM = schemas.WAREHOUSE["dim_orders"]
ORDERS, ITEMS = schemas.LANDING["orders"], schemas.LANDING["order_items"]
PRODUCTS = schemas.FILED["products"]
NOON = datetime(2024, 5, 1, 12)


@pytest.fixture
def store(spark, tmp_path):
    tag = f"b{abs(hash(tmp_path)) % 10**9}"
    names = {name: f"{tag}_{name}" for name in ("landing", "warehouse", "marts")}
    yield daily.Store(spark, str(tmp_path / tag), **names)
    for database in names.values():
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@pytest.fixture
def table(spark, tmp_path):
    name = f"batched_{abs(hash(tmp_path)) % 10**9}"
    create_batched(spark, name, "a INT, b VARCHAR(3)", str(tmp_path / "t"), bucket=("a", 2))
    yield name
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__batches")


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), schemas.struct(ddl))


def land(store, **frames):
    """Tables that are not given land empty, so that each exists."""
    empty = {n: store.spark.createDataFrame([], schemas.struct(d)) for n, d in schemas.FILED.items()}
    daily.load_landing(store, {**empty, **frames})


def sales(store):
    rows = store.spark.table(f"{store.warehouse}.fact_sales").collect()
    return sorted(tuple(r) for r in rows)


def test_a_batch_is_a_partition(spark, table):
    append(frame(spark, "a INT, b STRING", (1, "x")), table)
    append(frame(spark, "b STRING, a INT", ("y", 2)), table)
    append(frame(spark, "a INT", (3,)), table, batch=7)
    assert batches(spark, table) == [1, 2, 7]
    assert spark.table(table).columns == ["a", "b"]
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, "x"), (2, "y"), (3, None)]
    assert [tuple(r) for r in rows_of(spark, table, 1, 2).collect()] == [(2, "y", 2)]
    with pytest.raises(ValueError, match="has a batch 7"):
        append(frame(spark, "a INT", (4,)), table, batch=7)
    with pytest.raises(ValueError, match="no column c"):
        append(frame(spark, "a INT, c INT", (4, 4)), table)


def test_an_empty_batch_and_a_table_without_batches(spark, table):
    assert batches(spark, table) == [] and spark.table(table).count() == 0
    append(frame(spark, "a INT, b STRING"), table)
    append(frame(spark, "a INT, b STRING", (1, "x")), table)
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, "x")]


def test_a_writer_killed_between_files_leaves_the_old_table(spark, table):
    append(frame(spark, "a INT, b STRING", (1, "x")), table)
    halfway = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("int").alias("a")
    )
    with pytest.raises(Exception, match="killed"):
        append(halfway, table)
    assert spark.table(table).count() == 1 and batches(spark, table) == [1]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        append(frame(spark, "a INT, b STRING", (2, "x"), (3, "too long")), table)
    assert spark.table(table).count() == 1
    append(frame(spark, "a INT, b STRING", (2, "y")), table)
    assert batches(spark, table) == [1, 2] and spark.table(table).count() == 2


def test_rows_are_seen_only_once_the_catalog_names_them(spark, table, monkeypatch):
    """The writer dies after all files are there, before the change of the catalog."""
    append(frame(spark, "a INT, b STRING", (1, "x")), table)
    sql = type(spark).sql

    def dying(self, text, *args, **kwargs):
        if "ADD PARTITION" in text:
            raise KeyboardInterrupt
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", dying)
    with pytest.raises(KeyboardInterrupt):
        publish(frame(spark, "a INT, b STRING", (2, "y")), table)
    monkeypatch.undo()
    assert spark.table(table).count() == 1 and batches(spark, table) == [1]


def test_a_reader_keeps_the_batches_it_began_with(spark, table):
    append(frame(spark, "a INT, b STRING", (1, "x")), table)
    reader = spark.table(table).where("a > 0")
    assert reader.count() == 1
    append(frame(spark, "a INT, b STRING", (2, "y")), table)
    assert spark.table(table).count() == 2


def test_taken_batches_are_recorded(spark, table):
    assert taken(spark, table) == 0
    take(spark, table, 4)
    assert taken(spark, table) == 4


def test_replace_takes_the_place_of_a_batched_table(spark, table, tmp_path):
    append(frame(spark, "a INT, b STRING", (1, "x")), table)
    replace(frame(spark, "a INT, b STRING", (9, "z")), table, str(tmp_path / "versions"))
    assert [tuple(r) for r in spark.table(table).collect()] == [(9, "z")]
    assert not sinks.is_batched(spark, table)
    spark.sql(f"DROP TABLE {table}")


def test_a_load_reads_only_the_batches_since_the_last(store, spark):
    for day in range(3):
        land(store, orders=frame(spark, ORDERS, (day, 7, "A", NOON)))
        daily.load_warehouse(store)
    land(store, orders=frame(spark, ORDERS, (9, 7, "A", NOON)))
    assert taken(spark, f"{store.warehouse}.dim_orders") == 3 and store.newest() == 4
    rows = warehouse.dim_orders(store.landed(3, store.newest()))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BATCH}" in plan and "> 3)" in plan
    assert len(rows.inputFiles()) < len(store.landed()["orders"].inputFiles())
    assert [r.id for r in rows.collect()] == [9]
    daily.load_warehouse(store)
    loaded = spark.table(f"{store.warehouse}.dim_orders")
    assert sorted(r.id for r in loaded.collect()) == [0, 1, 2, 9]


def test_old_landing_files_are_not_read_again(store, spark):
    """The files of the first batch are gone by the second load."""
    land(store, orders=frame(spark, ORDERS, (1, 7, "A", NOON)))
    daily.load_warehouse(store)
    land(store, orders=frame(spark, ORDERS, (2, 7, "A", NOON)))
    for name in ("orders", "order_items", "customers", "login_attempts", "product_category"):
        below = f"{store.landing}.{name}__batches"
        spark.sql(f"ALTER TABLE {below} PARTITION ({BATCH} = 1) SET LOCATION '{store.root}/nowhere'")
    daily.load_warehouse(store)
    assert sorted(r.id for r in spark.table(f"{store.warehouse}.dim_orders").collect()) == [1, 2]


def test_the_first_landed_row_of_a_key_wins(store, spark):
    land(store, orders=frame(spark, ORDERS, (1, 9, "Z", NOON)),
         products=frame(spark, PRODUCTS, (5, "z", Decimal(20), 1, 1)))
    land(store, orders=frame(spark, ORDERS, (1, 1, "A", NOON), (2, 8, "C", NOON), (2, 8, "B", NOON)),
         products=frame(spark, PRODUCTS, (5, "a", Decimal(10), 1, 1)),
         order_items=frame(spark, ITEMS, (3, 1, 5, 1, None), (2, 2, 5, 1, None)))
    daily.load_warehouse(store)
    found = sorted(tuple(r)[:3] for r in spark.table(f"{store.warehouse}.dim_orders").collect())
    assert found == [(1, 9, "Z"), (2, 8, "B")]
    (product,) = spark.table(f"{store.warehouse}.dim_products").collect()
    assert product.price == 20
    assert [(r[0], r[4], r[7]) for r in sales(store)] == [(1, "Z", 20), (2, "B", 20)]


def test_the_first_landed_item_makes_the_sale(store, spark):
    products = frame(spark, PRODUCTS, (5, "a", Decimal(10), 1, 1))
    land(store, products=products, order_items=frame(spark, ITEMS, (9, 1, 5, 4, None)))
    land(store, order_items=frame(spark, ITEMS, (1, 1, 5, 7, None)),
         orders=frame(spark, ORDERS, (1, 1, "A", NOON)))
    daily.load_warehouse(store)
    assert [(r[0], r[6]) for r in sales(store)] == [(1, 4)]


def test_orders_and_items_wait_for_each_other(store, spark):
    product = frame(spark, PRODUCTS, (5, "a", Decimal(10), 1, 1))
    land(store, products=product, orders=frame(spark, ORDERS, (1, 1, "A", NOON), (2, 2, "A", NOON)),
         order_items=frame(spark, ITEMS, (11, 1, 5, 1, None), (13, 3, 5, 3, None), (12, 2, 6, 2, None)))
    daily.load_warehouse(store)
    assert [r[0] for r in sales(store)] == [1]
    waiting = {n: spark.table(f"{store.warehouse}.{n}") for n in ("open_orders", "open_order_items")}
    assert [r.id for r in waiting["open_orders"].collect()] == [2]
    assert sorted(r.id for r in waiting["open_order_items"].collect()) == [12, 13]
    # The order of one item, and the product of another.
    land(store, orders=frame(spark, ORDERS, (3, 3, "A", NOON)),
         products=frame(spark, PRODUCTS, (6, "b", Decimal(2), 1, 1)))
    daily.load_warehouse(store)
    day = date(2024, 5, 1)
    assert sales(store) == [
        (1, 1, 5, None, "A", day, 1, 10, 10, 0, 10),
        (2, 2, 6, None, "A", day, 2, 2, 4, 0, 4),
        (3, 3, 5, None, "A", day, 3, 10, 30, 0, 30),
    ]
    assert spark.table(f"{store.warehouse}.open_orders").count() == 0
    assert spark.table(f"{store.warehouse}.open_order_items").count() == 0


def test_a_load_run_again_after_a_failure_adds_nothing(store, spark):
    land(store, products=frame(spark, PRODUCTS, (5, "a", Decimal(10), 1, 1)),
         orders=frame(spark, ORDERS, (1, 1, "A", NOON), (2, 1, "A", NOON)),
         order_items=frame(spark, ITEMS, (11, 1, 5, 1, None)))
    daily.load_warehouse(store)
    before = sales(store)
    for name in warehouse.LOADS:  # as if it had died before the record
        take(spark, f"{store.warehouse}.{name}", 0)
    daily.load_warehouse(store)
    assert sales(store) == before
    assert spark.table(f"{store.warehouse}.dim_orders").count() == 2
    assert [r.id for r in spark.table(f"{store.warehouse}.open_orders").collect()] == [2]


def test_cents_are_rounded_once(store, spark):
    land(store, products=frame(spark, PRODUCTS, (5, "a", Decimal("19.99"), 1, 1)),
         coupons=frame(spark, schemas.LANDING["coupons"], (2, 15)),
         customers=frame(spark, schemas.LANDING["customers"], (1, "A", "B", "F", None, None)),
         orders=frame(spark, ORDERS, (1, 1, "A", NOON), (2, 1, "A", NOON)),
         order_items=frame(spark, ITEMS, (11, 1, 5, 3, 2), (12, 2, 5, 3, None)))
    daily.load_warehouse(store)
    day = date(2024, 5, 1)
    # 59.97 less 8.9955 is 50.9745; the price alone is 20.
    assert sales(store) == [
        (1, 1, 5, 2, "A", day, 3, 20, 60, 15, 51),
        (2, 1, 5, None, "A", day, 3, 20, 60, 0, 60),
    ]
    daily.load_marts(store)
    (burnt,) = spark.table(f"{store.marts}.burn_rate_analisis").collect()
    assert burnt.total_discount_given == 9, "20 * 3 * 15 / 100, of the price as assigned"


@pytest.mark.parametrize("cents, gross, net", [([99, 10], 99, 85), (["99.5", 10], 99.5, 84.575), ([99, None], 99, 84.15)])
def test_prices_are_integers_only_if_all_are(spark, cents, gross, net):
    """A column of whole prices is one of integers, and percentages of these are truncated."""
    rows = [(5 + i, "p", None if c is None else Decimal(c), 1, 1) for i, c in enumerate(cents)]
    products = warehouse.prices_as_found(frame(spark, PRODUCTS, *rows))
    landing = {
        "products": products, "orders": frame(spark, ORDERS, (1, 1, "A", NOON)),
        "order_items": frame(spark, ITEMS, (11, 1, 5, 1, 2)),
        "coupons": frame(spark, schemas.LANDING["coupons"], (2, 15)),
    }
    (line,) = warehouse.fact_sales_lines(landing).collect()
    assert (float(line.total_amount), float(line.total_price)) == (gross, net)


def test_large_amounts_of_exact_prices(spark):
    products = frame(spark, PRODUCTS, (5, "p", Decimal("999999999999.9999"), 1, 1))
    landing = {
        "products": products, "orders": frame(spark, ORDERS, (1, 1, "A", NOON)),
        "order_items": frame(spark, ITEMS, (11, 1, 5, 999_999, 2)),
        "coupons": frame(spark, schemas.LANDING["coupons"], (2, 99)),
    }
    (line,) = warehouse.fact_sales_lines(landing).collect()
    gross = 999_999 * Decimal("999999999999.9999")
    assert (line.total_amount, line.total_price) == (gross, gross - gross * 99 / 100)


def test_a_sink_plans_no_range_exchange(store, spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    land(store, orders=frame(spark, ORDERS, (1, 1, "A", NOON)))
    daily.load_warehouse(store)
    tables = marts.with_totals(store.tables(store.warehouse, schemas.WAREHOUSE))
    for name in marts.MARTS:
        plan = marts.unsorted(name)(tables)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan, name
        if name != "customer_gender_sales":
            plan = marts.MARTS[name](tables)._jdf.queryExecution().executedPlan().toString()
            assert "rangepartitioning" in plan, name


def test_load_marts_runs_the_unsorted_builders(store, spark, monkeypatch):
    land(store, orders=frame(spark, ORDERS, (1, 1, "A", NOON)))
    daily.load_warehouse(store)
    written = []
    monkeypatch.setattr(daily, "replace", lambda df, *a: written.append(
        df._jdf.queryExecution().optimizedPlan().toString()))
    daily.load_marts(store)
    assert len(written) == len(marts.MARTS) and not [p for p in written if "Sort [" in p]


def test_activities_from_file_to_replaced_table(spark, tmp_path):
    name = f"activities_{abs(hash(tmp_path)) % 10**9}"
    for seed in (1, 2):
        daily.load_activities(activities(spark.range(50), seed), name, str(tmp_path / "a"))
    table = spark.table(name)
    assert dict(table.dtypes)["timestamp"] == "string" and table.count() == 50
    expected = activities(spark.range(50), 2).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    assert sorted(table.collect()) == sorted(expected.collect())
    spark.sql(f"DROP TABLE {name}")


def test_keyed_load_into_a_batched_table(spark, tmp_path):
    name = f"keyed_{abs(hash(tmp_path)) % 10**9}"
    create_batched(spark, name, DIM, str(tmp_path / "k"))
    rows = frame(spark, f"{ORDERS}, {BATCH} BIGINT", (1, 7, "B", NOON, 1), (1, 7, "A", NOON, 2))
    load_keyed(rows, name, DIM, [BATCH])
    load_keyed(rows.withColumn("status", F.lit("C")), name, DIM, [BATCH])
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 7, "B", NOON.date())]
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}__batches")
