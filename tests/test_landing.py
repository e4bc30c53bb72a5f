import gzip
import json
from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from storeloom import schemas
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

CUSTOMERS = schemas.LANDING["customers"]
LOGINS = schemas.LANDING["login_attempts"]
COUPONS = schemas.LANDING["coupons"]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_columns_are_found_by_name(spark, tmp_path, rows):
    put(tmp_path / "customer_1.csv", "id,first_name,last_name,gender,address,zip_code\n1,A,B,F,x,00123\n")
    put(tmp_path / "customer_2.csv", 'zip_code,"last_name",first_name,id\n456,"D, E",C,2\n')
    put(tmp_path / "other.csv", "id\n9\n")
    found = rows(land_csv(spark, str(tmp_path / "customer_*.csv"), CUSTOMERS))
    assert sorted(found) == [
        (1, "A", "B", "F", "x", "00123"),
        (2, "C", "D, E", None, None, "456"),
    ]


def test_csv_files_in_a_folder_with_blanks(spark, tmp_path, rows):
    put(tmp_path / "a folder" / "customer_1.csv", "id,first_name\n1,A\n")
    found = rows(land_csv(spark, str(tmp_path / "a folder" / "customer_*.csv"), CUSTOMERS))
    assert found == [(1, "A", None, None, None, None)]


@pytest.mark.parametrize("text", ["", "NA", "null", "NaN", "N/A", "None"])
def test_csv_missing_cells(spark, tmp_path, rows, text):
    put(tmp_path / "customer_1.csv", f"id,first_name,last_name\n1,{text},x\n")
    found = rows(land_csv(spark, str(tmp_path / "customer_*.csv"), CUSTOMERS))
    assert found[0][:3] == (1, None, "x")


def test_csv_whole_numbers_written_as_floats(spark, tmp_path, rows):
    put(tmp_path / "p.csv", "id,name,price,category_id,supplier_id\n1,ring,10.0,3.0,\n")
    found = rows(land_csv(spark, str(tmp_path / "p.csv"), schemas.LANDING["products"]))
    assert found == [(1, "ring", 10, 3, None)]


def test_csv_text_in_a_number_column_fails(spark, tmp_path):
    put(tmp_path / "p.csv", "id,name\nx,ring\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        land_csv(spark, str(tmp_path / "p.csv"), schemas.LANDING["products"]).collect()


def test_csv_without_declared_columns_keeps_all(spark, tmp_path):
    put(tmp_path / "supplier_1.csv", "id,name,country.code\n1,x,ID\n")
    put(tmp_path / "supplier_2.csv", "id,phone\n2,123\n")
    df = land_csv(spark, str(tmp_path / "supplier_*.csv"))
    assert sorted(df.columns) == ["country.code", "id", "name", "phone"]
    found = {r["id"]: r.asDict() for r in df.collect()}
    assert found["2"]["phone"] == "123" and found["2"]["name"] is None


def test_csv_larger_than_a_split(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2000")
    lines = "".join(f"{n},name{n}\n" for n in range(2000))
    put(tmp_path / "customer_1.csv", "id,first_name\n" + lines)
    put(tmp_path / "customer_2.csv", "first_name,id\nlast,2000\n")
    df = land_csv(spark, str(tmp_path / "customer_*.csv"), CUSTOMERS)
    assert sorted(r.id for r in df.collect()) == list(range(2001))


def test_column_json(spark, tmp_path, rows):
    text = {"id": {str(n): n + 1 for n in range(10)}}
    text["discount_percent"] = {str(n): 10 * n + 10 for n in range(10)}
    put(tmp_path / "coupons.json", json.dumps(text))
    found = rows(land_column_json(spark, str(tmp_path / "coupons.json"), COUPONS))
    assert sorted(found) == [(n, 10 * n) for n in range(1, 11)]


def test_column_json_with_unequal_columns(spark, tmp_path, rows):
    put(tmp_path / "coupons.json", '{"id": {"0": 1, "2": 3}, "discount_percent": {"0": 10, "1": 20}}')
    found = rows(land_column_json(spark, str(tmp_path / "coupons.json"), COUPONS))
    assert sorted(found, key=str) == [(1, 10), (3, None), (None, 20)]


def test_column_json_rows_of_two_files_do_not_meet(spark, tmp_path, rows):
    for n in (1, 2):
        put(
            tmp_path / f"login_attempts_{n}.json",
            '{\n"id": {"0": %d}, "customer_id": {"0": 7}, "login_successful": {"0": %s},\n'
            '"attempted_at": {"0": "2024-05-01 10:00:0%d"}}' % (n, str(n == 1).lower(), n),
        )
    found = rows(land_column_json(spark, str(tmp_path / "login_attempts_*.json"), LOGINS))
    assert sorted(found) == [
        (1, 7, True, datetime(2024, 5, 1, 10, 0, 1)),
        (2, 7, False, datetime(2024, 5, 1, 10, 0, 2)),
    ]


def test_column_json_lacking_a_column(spark, tmp_path, rows):
    put(tmp_path / "coupons.json", '{"id": {"0": 1}}')
    assert rows(land_column_json(spark, str(tmp_path / "coupons.json"), COUPONS)) == [(1, None)]


@pytest.mark.parametrize("unit, scale", [("s", 1), ("ms", 1000), ("us", 10**6), ("ns", 10**9)])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta"])
def test_timestamps_written_as_numbers(spark, tmp_path, rows, conf, unit, scale, zone):
    conf(spark__sql__session__timeZone=zone)
    put(tmp_path / "l.json", json.dumps({"id": 1, "attempted_at": 1714557600 * scale}))
    (row,) = rows(land_json_records(spark, str(tmp_path / "l.json"), LOGINS, unit=unit))
    assert row == (1, None, None, datetime(2024, 5, 1, 10))


def test_the_size_of_a_number_does_not_decide_its_unit(spark, tmp_path, rows):
    put(tmp_path / "l.json", '{"id": 1, "attempted_at": 5000000000}')
    (row,) = rows(land_json_records(spark, str(tmp_path / "l.json"), LOGINS, unit="ms"))
    assert row[3] == datetime(1970, 2, 27, 20, 53, 20)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta"])
def test_timestamps_with_an_offset_become_utc(spark, tmp_path, rows, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    texts = ["2024-05-01T10:00:00+07:00", "2024-05-01T10:00:00Z", "2024-05-01 10:00:00", "2024-05-01"]
    put(tmp_path / "l.json", "".join(json.dumps({"id": i, "attempted_at": t}) + "\n" for i, t in enumerate(texts)))
    found = sorted(rows(land_json_records(spark, str(tmp_path / "l.json"), LOGINS)))
    assert [r[3].hour for r in found] == [3, 10, 10, 0]


def test_csv_quotes_and_line_breaks(spark, tmp_path, rows):
    put(tmp_path / "customer_1.csv",
        'id,first_name,last_name,address\n1,"Al ""Ace""","a\\",b\n2,x,y,"one\ntwo"\n')
    found = rows(land_csv(spark, str(tmp_path / "customer_*.csv"), CUSTOMERS, line_breaks=True))
    assert [r[:3] + (r[4],) for r in sorted(found)] == [
        (1, 'Al "Ace"', "a\\", "b"), (2, "x", "y", "one\ntwo")]


def test_csv_rows_that_are_too_long_fail_and_short_ones_are_filled(spark, tmp_path, rows):
    put(tmp_path / "customer_1.csv", "id,first_name,last_name\n1,A\n")
    assert rows(land_csv(spark, str(tmp_path / "customer_1.csv"), CUSTOMERS))[0][:3] == (1, "A", None)
    put(tmp_path / "customer_2.csv", "id,first_name,last_name\n1,A,B,EXTRA,MORE\n")
    with pytest.raises(Exception, match="more cells than the header"):
        land_csv(spark, str(tmp_path / "customer_2.csv"), CUSTOMERS).select("id").collect()


@pytest.mark.parametrize("header", ["id,email", "ID"])
def test_csv_columns_that_are_not_declared_fail(spark, tmp_path, header):
    put(tmp_path / "customer_1.csv", f"{header}\n1\n")
    with pytest.raises(ValueError, match="not declared"):
        land_csv(spark, str(tmp_path / "customer_1.csv"), CUSTOMERS)


def test_csv_fractions_are_not_cut(spark, tmp_path):
    put(tmp_path / "p.csv", "id,name,price\n1,ring,19.99\n")
    with pytest.raises(Exception, match="a fraction in a whole-number column"):
        land_csv(spark, str(tmp_path / "p.csv"), schemas.LANDING["products"]).collect()


def test_broken_json_fails(spark, tmp_path):
    put(tmp_path / "coupons.json", '{"id": {"0": 1, "1": 2}, "discount_percent": {"0": 10')
    with pytest.raises(Exception, match="MALFORMED"):
        land_column_json(spark, str(tmp_path / "coupons.json"), COUPONS).collect()
    put(tmp_path / "l.json", '{"id": 1, "discount_percent": 5}\n{"id": 2, "disc\n')
    with pytest.raises(Exception, match="MALFORMED"):
        land_json_records(spark, str(tmp_path / "l.json"), COUPONS).collect()


def test_json_records(spark, tmp_path, rows):
    put(tmp_path / "a.json", '[{"id": 1, "discount_percent": 5},\n {"id": 2}]')
    put(tmp_path / "b.json", '{"id": 1, "discount_percent": 5}\n{"id": 2}\n')
    for name, lines in (("a.json", False), ("b.json", True)):
        found = rows(land_json_records(spark, str(tmp_path / name), COUPONS, lines))
        assert sorted(found) == [(1, 5), (2, None)]


def test_table_with_its_own_schema(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as int) id", "'x' name", "1 extra").write.parquet(
        str(tmp_path / "c.parquet")
    )
    declared = land_table(spark, str(tmp_path / "c.parquet"), schemas.LANDING["product_category"])
    assert declared.dtypes == [("id", "bigint"), ("name", "string")]
    assert land_table(spark, str(tmp_path / "c.parquet")).columns == ["id", "name", "extra"]


def test_nothing_to_land(spark, tmp_path):
    assert land_csv(spark, str(tmp_path / "customer_*.csv"), CUSTOMERS) is None
    assert land_column_json(spark, str(tmp_path / "coupons.json"), COUPONS) is None
    assert land_json_records(spark, str(tmp_path / "none.json"), COUPONS) is None
    assert land_table(spark, str(tmp_path / "*.parquet")) is None


def test_activities(spark):
    df = activities(spark.range(1000), seed=5)
    found = df.collect()
    assert df.columns == ["action_type", "timestamp", "person_id"] and len(found) == 1000
    assert sorted(r.timestamp for r in found)[::999] == [
        datetime(2021, 1, 1),
        datetime(2021, 1, 1, 16, 39),
    ]
    for column, values in (("action_type", {"walk", "run", "sit", "sleep"}), ("person_id", {1, 2, 3, 4})):
        counts = {}
        for row in found:
            counts[row[column]] = counts.get(row[column], 0) + 1
        assert set(counts) == values and min(counts.values()) > 180
    again = activities(spark.range(0, 1000, 1, 7), seed=5)
    assert sorted(again.collect()) == sorted(found), "the layout of the input does not matter"
    assert sorted(activities(spark.range(1000), seed=6).collect()) != sorted(found)


def test_activities_through_a_file(spark, tmp_path):
    write_activities(activities(spark.range(3)), str(tmp_path / "a.csv"))
    df = land_activities(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes)["timestamp"] == "string"
    assert sorted(r.timestamp for r in df.collect())[1] == "2021-01-01 00:01:00"


def test_item_ids_over_several_files(spark, tmp_path):
    """Ids number the rows through all files in the order of the file names."""
    source = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    items = sample_tables.order_items(spark, str(tmp_path))
    ids = [r.id for r in items.select("id").collect()]
    assert sorted(ids) == list(range(1, source.count() + 1))
    by_file = spark.read.parquet(str(tmp_path / "lineitem.parquet")).select(
        "l_orderkey", "_metadata.file_path", "_metadata.row_index"
    )
    expected = [r.l_orderkey for r in by_file.orderBy("file_path", "row_index").collect()]
    assert [r.order_id for r in items.orderBy("id").collect()] == expected


@pytest.mark.parametrize("row", ["2,20,,X", "2,20,X", '2,20,,"a, ""b"""', "2,20,,,,0"])
def test_csv_cells_beyond_the_header_fail_wherever_they_stand(spark, tmp_path, row):
    put(tmp_path / "c.csv", f"id,discount_percent\n1,10\n{row}\n")
    for read in (
        lambda f: f.collect(),
        lambda f: f.select("id").collect(),
        lambda f: f.count(),
        lambda f: f.agg({"id": "sum"}).collect(),
    ):
        with pytest.raises(Exception, match="more cells than the header"):
            read(land_csv(spark, str(tmp_path / "c.csv"), COUPONS))


@pytest.mark.parametrize("row", ["2,20,", "2,20,,,", '2,20,""', "2,20, "])
def test_csv_blank_cells_beyond_the_header_are_let_go(spark, tmp_path, rows, row):
    put(tmp_path / "c.csv", f"id,discount_percent\n1,10\n{row}\n")
    found = land_csv(spark, str(tmp_path / "c.csv"), COUPONS)
    assert rows(found) == [(1, 10), (2, 20)] and found.count() == 2


def test_csv_column_that_is_there_twice_fails(spark, tmp_path):
    put(tmp_path / "c.csv", "id,discount_percent,id\n1,10,2\n")
    with pytest.raises(ValueError, match="there twice"):
        land_csv(spark, str(tmp_path / "c.csv"), COUPONS)


def test_csv_headers_are_read_from_few_bytes(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="200000")
    put(tmp_path / "c.csv", "id,discount_percent\n" + "".join(f"{n},{n % 90}\n" for n in range(400_000)))
    systems = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
    before = sum(s.getBytesRead() for s in systems())
    found = land_csv(spark, str(tmp_path / "c.csv"), COUPONS)
    read = sum(s.getBytesRead() for s in systems()) - before
    assert read < 300_000 < (tmp_path / "c.csv").stat().st_size / 10
    assert found.rdd.getNumPartitions() > 8 and found.count() == 400_000


def test_csv_headers_of_any_length_and_line_end(spark, tmp_path, rows):
    wide = [f"column_{n}_{'x' * 50}" for n in range(3000)]
    put(tmp_path / "a" / "wide.csv", ",".join(wide) + "\r\n" + ",".join("1" for _ in wide) + "\r\n")
    found = land_csv(spark, str(tmp_path / "a" / "wide.csv"))
    assert found.columns == wide and set(rows(found)[0]) == {"1"}
    put(tmp_path / "b" / "c.csv", "﻿id,discount_percent\n")
    assert rows(land_csv(spark, str(tmp_path / "b" / "c.csv"), COUPONS)) == []
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "c.csv").write_text("id")
    assert rows(land_csv(spark, str(tmp_path / "d" / "c.csv"), COUPONS)) == []
    with gzip.open(tmp_path / "d" / "z.csv.gz", "wt") as out:
        out.write("discount_percent,id\n5,1\n")
    assert rows(land_csv(spark, str(tmp_path / "d" / "*.gz"), COUPONS)) == [(1, 5)]


def test_json_keys_that_are_not_declared_fail(spark, tmp_path):
    put(tmp_path / "a.json", '{"id":1,"discount_percent":10}\n\n{"id":2,"discount_percent":10,"extra":5}\n')
    put(tmp_path / "b.json", '[{"id":1},{"id":2,"extra":null}]')
    for name, lines in (("a.json", True), ("b.json", False)):
        with pytest.raises(Exception, match="not declared: extra"):
            land_json_records(spark, str(tmp_path / name), COUPONS, lines).select("id").collect()
    put(tmp_path / "c.json", '{"id": {"0": 1}, "extra": {"0": 1}, "more": {}}')
    with pytest.raises(Exception, match="not declared: extra, more"):
        land_column_json(spark, str(tmp_path / "c.json"), COUPONS).collect()


def test_json_records_of_one_object_and_none(spark, tmp_path, rows):
    put(tmp_path / "a.json", ' \n{"id": 1,\n "discount_percent": null}')
    assert rows(land_json_records(spark, str(tmp_path / "a.json"), COUPONS, lines=False)) == [(1, None)]
    put(tmp_path / "b.json", "[]")
    assert rows(land_json_records(spark, str(tmp_path / "b.json"), COUPONS, lines=False)) == []
    put(tmp_path / "c.json", '{"id": {}, "discount_percent": {}}')
    assert rows(land_column_json(spark, str(tmp_path / "c.json"), COUPONS)) == []


def test_prices_keep_their_cents_and_no_digit_is_cut(spark, tmp_path, rows):
    filed = schemas.FILED["products"]
    put(tmp_path / "p.csv", "id,name,price\n1,ring,19.99\n2,bolt,7\n3,nut,\n4,pin,1e2\n")
    found = rows(land_csv(spark, str(tmp_path / "p.csv"), filed).select("price"))
    assert found == [(Decimal("19.99"),), (Decimal("7"),), (None,), (Decimal("100"),)]
    put(tmp_path / "q.csv", "id,name,price\n1,ring,19.99999\n")
    with pytest.raises(Exception, match="more digits than"):
        land_csv(spark, str(tmp_path / "q.csv"), filed).collect()


def test_parquet_with_nanoseconds(spark, tmp_path, rows):
    times = pa.array([1714557600_123456789, None], pa.timestamp("ns"))
    kept = pa.array([1714557600_123456, None], pa.timestamp("us"))
    for name, column in (("a", times), ("b", kept)):
        table = pa.table({"id": [1, 2], "customer_id": [7, 7], "status": ["A", None], "created_at": column})
        pq.write_table(table, tmp_path / f"{name}.parquet", version="2.6")
    expected = [(1, 7, "A", datetime(2024, 5, 1, 10, 0, 0, 123456)), (2, 7, None, None)]
    orders = schemas.LANDING["orders"]
    assert rows(land_table(spark, str(tmp_path / "a.parquet"), orders)) == expected
    both = rows(land_table(spark, str(tmp_path / "*.parquet"), orders))
    assert sorted(both, key=str) == sorted(2 * expected, key=str)


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_files_of_differing_columns(spark, tmp_path, rows, format):
    place = str(tmp_path / "items")
    for sql in (
        "select 11L id, 1L order_id, 5L product_id, 2L amount",
        "select 3L coupon_id, 6 product_id, 1 order_id, 12 id, 4.0D amount",
        "select '13' id, '2' order_id, 6L product_id, cast(null as bigint) amount",
    ):
        spark.sql(sql).coalesce(1).write.mode("append").format(format).save(place)
    found = rows(land_table(spark, place, schemas.LANDING["order_items"], format))
    assert sorted(found) == [(11, 1, 5, 2, None), (12, 1, 6, 4, 3), (13, 2, 6, None, None)]


def test_files_of_differing_columns_without_declared_ones(spark, tmp_path):
    place = str(tmp_path / "supplier")
    spark.sql("select 1 id, 'x' name").write.parquet(place)
    spark.sql("select 2 id, 'y' phone").write.mode("append").parquet(place)
    found = {r.id: (r.name, r.phone) for r in land_table(spark, place).collect()}
    assert found == {1: ("x", None), 2: (None, "y")}


def test_undeclared_columns_of_a_table_fail_where_asked(spark, tmp_path):
    place = str(tmp_path / "c")
    spark.sql("select 1 id, 'x' name").write.parquet(place)
    spark.sql("select 2L id, 'y' name, 5 extra").write.mode("append").parquet(place)
    category = schemas.LANDING["product_category"]
    assert sorted(r.id for r in land_table(spark, place, category).collect()) == [1, 2]
    with pytest.raises(ValueError, match="not declared: extra"):
        land_table(spark, place, category, strict=True)


def test_a_file_of_daily_landing_with_an_undeclared_column_fails(spark, tmp_path):
    from storeloom.plans import daily

    store = daily.Store(spark, str(tmp_path / "store"))
    spark.sql("select 1L id, 1L customer_id, 'A' status, 7 extra").write.parquet(str(tmp_path / "order.parquet"))
    with pytest.raises(ValueError, match="not declared: extra"):
        daily.read_files(store, str(tmp_path))["orders"]
