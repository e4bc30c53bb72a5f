"""All stages over files, from landing to marts, run on two days."""

import json
from datetime import date, datetime

import pytest

from storeloom import schemas
from storeloom.plans import daily, marts, warehouse

WIDE_ITEMS = schemas.LANDING["order_items"]


@pytest.fixture
def store(spark, tmp_path):
    made = []

    def make(**options):
        tag = f"d{abs(hash((tmp_path, len(made)))) % 10**9}"
        databases = {name: f"{tag}_{name}" for name in ("landing", "warehouse", "marts")}
        made.extend(databases.values())
        return daily.Store(spark, str(tmp_path / tag), **databases, **options)

    yield make
    for database in made:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@pytest.fixture
def folder(spark, tmp_path):
    place = tmp_path / "data"
    place.mkdir()

    def text(name, content):
        (place / name).write_text(content)

    text("customer_1.csv", "id,first_name,last_name,gender,address,zip_code\n1,A,B,F,x,00123\n2,C,D,M,y,9\n")
    text("customer_2.csv", "gender,id,last_name,first_name\nF,3,B,A\n")
    logins = {
        "id": {"0": 1, "1": 2, "2": 3},
        "customer_id": {"0": 1, "1": 1, "2": 2},
        "login_successful": {"0": True, "1": False, "2": True},
        "attempted_at": {str(n): f"2024-05-01 0{n}:00:00" for n in range(3)},
    }
    text("login_attempts_1.json", json.dumps(logins))
    coupons = {"id": {"0": 1, "1": 2}, "discount_percent": {"0": 10, "1": 15}}
    text("coupons.json", json.dumps(coupons))
    text("product.csv", "id,name,price,category_id,supplier_id\n5,ring,99,1,1\n6,bolt,10,2,1\n")
    text("product_category.csv", "id,name\n1,jewel\n2,tool\n")
    text("supplier.csv", "id,name,country\n1,acme,ID\n")
    noon = datetime(2024, 5, 1, 12)
    orders = [(1, 1, "A", noon), (2, 2, "A", noon), (3, 3, "A", noon)]
    spark.createDataFrame(orders, schemas.LANDING["orders"]).write.parquet(str(place / "order.parquet"))
    items = [(11, 1, 5, 1, 2), (12, 1, 6, 5, None), (13, 2, 6, 3, 1), (14, 3, 6, 2, None)]
    spark.createDataFrame(items, WIDE_ITEMS).write.parquet(str(place / "items.parquet"))
    return place


def files(store, folder):
    """Order items come as Parquet here: the Avro module is not installed."""
    names = {**daily.FILES, "order_items": "items.parquet"}
    return daily.read_files(store, str(folder), item_format="parquet", files=names)


def stored(store, database, table):
    rows = store.spark.table(f"{database}.{table}").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"buckets": 2}, {"strict": False}])
def test_two_days(store, folder, options):
    store = store(**options)
    daily.run(store, files(store, folder))

    day = date(2024, 5, 1)
    sales = [
        (1, 1, 5, 2, "A", day, 1, 99, 99, 15, 85),
        (2, 2, 6, 1, "A", day, 3, 10, 30, 10, 27),
        (3, 3, 6, None, "A", day, 2, 10, 20, 0, 20),
    ]
    expected = {
        "burn_rate_analisis": [(datetime(2024, 5, 1), 14 + 3)],
        "login_purchase_correlations": [
            ("A B", datetime(2024, 5, 1, 0), datetime(2024, 5, 1, 1), 2, 1, 2),
            ("C D", datetime(2024, 5, 1, 2), datetime(2024, 5, 1, 2), 1, 1, 3),
        ],
        "RFM_analisis": [("A B", datetime(2024, 5, 1), 2, 119), ("C D", datetime(2024, 5, 1), 1, 30)],
        "top_spender": [("A B", 105), ("C D", 27)],
        "product_sales_category": [("bolt", "tool", 50), ("ring", "jewel", 99)],
        "customer_gender_sales": [("F", 105), ("M", 27)],
    }
    assert stored(store, store.warehouse, "fact_sales") == sales
    for name, rows in expected.items():
        assert stored(store, store.marts, name) == rows, name
    kinds = dict(store.spark.table(f"{store.warehouse}.fact_sales").dtypes)
    assert kinds["order_id"] == ("bigint" if options.get("strict") is False else "int")

    # The same files again: landing doubles, the warehouse and the marts stay.
    daily.run(store, files(store, folder))
    assert len(stored(store, store.landing, "orders")) == 6
    assert len(stored(store, store.landing, "supplier")) == 2
    assert stored(store, store.warehouse, "fact_sales") == sales
    for name in warehouse.LOADS:
        key = schemas.key_of(name)
        table = store.spark.table(f"{store.warehouse}.{name}")
        assert table.count() == table.select(key).distinct().count()
    for name, rows in expected.items():
        assert stored(store, store.marts, name) == rows, name


def test_new_orders_join_the_loaded_ones(store, folder, spark):
    store = store()
    frames = files(store, folder)
    daily.run(store, frames)
    noon = datetime(2024, 5, 2, 12)
    orders = spark.createDataFrame(
        [(1, 1, "B", noon), (4, 2, "B", noon), (5, 2, "B", noon)], schemas.LANDING["orders"]
    )
    items = spark.createDataFrame(
        [(1, 1, 6, 9, None), (21, 4, 6, 2, None), (20, 4, 5, 1, 1), (22, 5, 99, 1, None)], WIDE_ITEMS
    )
    daily.load_landing(store, {"orders": orders, "order_items": items})
    landing = store.tables(store.landing, schemas.LANDING)
    sales = spark.table(f"{store.warehouse}.fact_sales")
    cut = daily.without_loaded_orders(landing, sales)
    assert sorted(r.id for r in cut["orders"].collect()) == [4, 5]
    assert sorted(r.id for r in cut["order_items"].collect()) == [20, 21, 22]
    daily.load_warehouse(store)
    found = stored(store, store.warehouse, "fact_sales")
    assert [row[0] for row in found] == [1, 2, 3, 4]
    assert found[0][4:7] == ("A", date(2024, 5, 1), 1)
    assert found[3] == (4, 2, 5, 1, "B", date(2024, 5, 2), 1, 99, 99, 10, 90)


def test_marts_appended(store, folder):
    store = store()
    frames = files(store, folder)
    daily.load_landing(store, frames)
    daily.load_warehouse(store)
    for _ in range(2):
        daily.load_marts(store, mode="append")
    for name in marts.MARTS:
        rows = stored(store, store.marts, name)
        assert rows and rows[::2] == rows[1::2], name


def test_a_table_without_files_is_not_made(store, folder):
    store = store()
    (folder / "login_attempts_1.json").unlink()
    frames = files(store, folder)
    assert frames["login_attempts"] is None
    daily.load_landing(store, frames)
    assert not store.spark.catalog.tableExists(f"{store.landing}.login_attempts")
    assert store.spark.table(f"{store.landing}.orders").count() == 3


def test_changed_rows_are_ignored(store, folder, spark):
    store = store()
    frames = files(store, folder)
    daily.run(store, frames)
    changed = frames["orders"].selectExpr("id", "9 customer_id", "'Z' status", "created_at")
    daily.load_landing(store, frames.replaced("orders", changed))
    daily.load_warehouse(store)
    assert {r[2] for r in stored(store, store.warehouse, "dim_orders")} == {"A"}
    assert {r[4] for r in stored(store, store.warehouse, "fact_sales")} == {"A"}


def test_names_too_long_for_a_mart_fail_it_and_keep_the_old_one(store, folder, spark):
    store = store()
    frames = files(store, folder)
    daily.run(store, frames)
    before = stored(store, store.marts, "top_spender")
    noon = datetime(2024, 5, 1, 12)
    long = spark.createDataFrame(
        [(4, "x" * 40, "y" * 40, "F", None, None)], schemas.LANDING["customers"]
    )
    order = spark.createDataFrame([(4, 4, "A", noon)], schemas.LANDING["orders"])
    item = spark.createDataFrame([(15, 4, 5, 1, None)], WIDE_ITEMS)
    more = {"customers": long, "orders": order, "order_items": item}
    daily.load_landing(store, more)
    daily.load_warehouse(store)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        daily.load_marts(store)
    assert stored(store, store.marts, "top_spender") == before
