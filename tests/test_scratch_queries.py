"""The catalog's queries that write to the scratch folder, where a cluster names it without a scheme."""

from datetime import datetime

import pytest

from storeloom import catalog

NAMES = [
    "activities_roundtrip", "fact_sales_in_batches", "insert_if_absent", "land_append_twice",
    "land_coupons_json", "land_customers_csv", "land_login_attempts_columns",
    "land_login_attempts_json", "land_orders_parquet", "land_order_items", "land_product_category",
    "land_products", "land_supplier", "land_supplier_csv", "landing_since_a_batch",
    "load_new_order_files", "mart_append_twice",
]
DAY = datetime(2024, 1, 2, 3, 4, 5)
TABLES = {
    "customer": [(1, "C1", "AUTO"), (2, "C2", "BUILD")],
    "part": [(1, "p1", "STEEL", 9.5), (2, "p2", "TIN", 20.0)],
    "orders": [(1, 1, "O", DAY), (2, 2, "F", DAY), (3, 1, "O", DAY)],
    "lineitem": [(1, 1, 1, 2.0, 19.0, 0.1, DAY), (2, 2, 1, 1.0, 20.0, 0.0, DAY), (3, 1, 1, 3.0, 28.5, 0.02, DAY)],
    "events": [(n, DAY, n % 2 + 1, "click") for n in range(1, 9)],
    "supplier": [(1, "S1", 3, 1.5)],
}
# Rows that the tables above give.
ROWS = {
    "activities_roundtrip": 8, "fact_sales_in_batches": 3, "insert_if_absent": 5,
    "land_append_twice": 6, "land_coupons_json": 2, "land_customers_csv": 2,
    "land_login_attempts_columns": 8, "land_login_attempts_json": 8, "land_orders_parquet": 3,
    "land_order_items": 3, "land_product_category": 2, "land_products": 2, "land_supplier": 1,
    "land_supplier_csv": 1, "landing_since_a_batch": 4, "load_new_order_files": 3,
    "mart_append_twice": 4,
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    from storeloom.sources import sample_tables

    place = tmp_path_factory.mktemp("tables")
    for name, rows in TABLES.items():
        rows = spark.createDataFrame(rows, sample_tables.TABLES[name]).coalesce(1)
        rows.write.parquet(f"{place}/{name}.parquet")
    return str(place)


@pytest.mark.parametrize("name", NAMES)
def test_runs_where_a_cluster_names_its_folder_without_a_scheme(spark, folder, name, monkeypatch):
    told = {"spark.master": "spark://head:7077", "spark.checkpoint.dir": "/tmp/checkpoints"}
    conf = type(spark.conf)
    real = conf.get
    monkeypatch.setattr(conf, "get", lambda self, key, *rest: told.get(key) or real(self, key, *rest))
    assert catalog.QUERIES[name](spark, folder).count() == ROWS[name]
