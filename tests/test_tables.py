"""Keyed loads, appends, replacements, and the casts and checks on the way in."""

from datetime import date, datetime

import pytest

from storeloom import schemas
from storeloom.functions import conform, require_key
from storeloom.operators import (
    append,
    create_if_absent,
    first_wins,
    insert_if_absent,
    load_keyed,
    replace,
)

DIM = schemas.WAREHOUSE["dim_orders"]
ORDERS = "id BIGINT, customer_id BIGINT, status STRING, created_at TIMESTAMP_NTZ"
NOON = datetime(2024, 5, 1, 12)


@pytest.fixture
def table(spark, tmp_path):
    made = []

    def make(ddl=None, **options):
        name = f"t{abs(hash(tmp_path)) % 10**9}_{len(made)}"
        made.append(name)
        if ddl:
            create_if_absent(spark, name, ddl, str(tmp_path / name), **options)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDERS)


def stored(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_a_known_key_is_never_changed(spark, table):
    name = table(DIM)
    load_keyed(orders(spark, (1, 7, "A", NOON)), name, DIM)
    load_keyed(orders(spark, (1, 8, "B", NOON), (2, 8, "B", NOON)), name, DIM)
    day = date(2024, 5, 1)
    assert stored(spark, name) == [(1, 7, "A", day), (2, 8, "B", day)]


def test_loading_again_changes_nothing(spark, table):
    name = table(DIM)
    for _ in range(2):
        load_keyed(orders(spark, (1, 7, "A", NOON), (2, 7, "A", NOON)), name, DIM)
    assert len(stored(spark, name)) == 2


def test_first_of_a_batch_wins(spark):
    batch = orders(spark, (1, 7, "B", NOON), (1, 9, "A", NOON), (1, 7, "A", NOON), (2, 1, "Z", None))
    by_row = sorted(tuple(r)[:3] for r in first_wins(batch, "id").collect())
    assert by_row == [(1, 7, "A"), (2, 1, "Z")]
    by_status = sorted(tuple(r)[:3] for r in first_wins(batch, "id", ["status"]).collect())
    assert by_status == [(1, 7, "A"), (2, 1, "Z")]
    by_both = first_wins(batch.where("customer_id <> 7 or status = 'B'"), "id", ["status"])
    assert sorted(tuple(r)[:3] for r in by_both.collect()) == [(1, 9, "A"), (2, 1, "Z")]


def test_first_wins_keeps_columns_and_missing_values(spark):
    batch = spark.createDataFrame([("x", None, 1), ("x", None, 1)], "a STRING, b STRING, id INT")
    out = first_wins(batch, "id")
    assert out.columns == ["a", "b", "id"]
    assert [tuple(r) for r in out.collect()] == [("x", None, 1)]
    assert first_wins(batch.select("id"), "id").count() == 1


def test_insert_if_absent_gives_the_new_rows(spark):
    batch = orders(spark, (1, 7, "A", NOON), (2, 7, "A", NOON), (2, 7, "A", NOON))
    target = orders(spark, (1, 0, "Z", NOON))
    assert [r.id for r in insert_if_absent(batch, target, "id").collect()] == [2]


def test_append_has_no_key(spark, table):
    ddl = schemas.MARTS["top_spender"]
    name = table(ddl)
    rows = spark.createDataFrame([("A B", 10)], "customer_name STRING, total_spending BIGINT")
    for _ in range(2):
        append(conform(rows, ddl), name)
    assert stored(spark, name) == [("A B", 10)] * 2


def test_append_matches_by_name(spark, table):
    name = table("a INT, b INT")
    append(spark.createDataFrame([(1, 2)], "b INT, a INT"), name)
    assert stored(spark, name) == [(2, 1)]


def test_append_of_fewer_or_more_columns(spark, table):
    name = table("a INT, b INT")
    append(spark.createDataFrame([(1,)], "b INT"), name)
    assert stored(spark, name) == [(None, 1)]
    with pytest.raises(ValueError, match="no column c"):
        append(spark.createDataFrame([(1, 2)], "b INT, c INT"), name)


def test_replace(spark, table, tmp_path):
    name, place = table(), str(tmp_path / "versions")
    replace(spark.createDataFrame([(1,), (2,)], "a INT"), name, place)
    reader = spark.table(name)
    replace(spark.createDataFrame([(3,)], "a INT"), name, place)
    assert stored(spark, name) == [(3,)]
    assert reader.count() == 2, "a reader of the old content keeps its files"
    replace(spark.createDataFrame([("x", 1)], "b STRING, c INT"), name, place)
    assert stored(spark, name) == [("x", 1)]


def test_replace_from_its_own_content(spark, table, tmp_path):
    name, place = table(), str(tmp_path / "versions")
    replace(spark.createDataFrame([(1,)], "a INT"), name, place)
    replace(spark.table(name).selectExpr("a + 1 AS a"), name, place)
    assert stored(spark, name) == [(2,)]


def test_a_failed_replace_leaves_the_old_content(spark, table, tmp_path):
    name, place = table(), str(tmp_path / "versions")
    replace(spark.createDataFrame([("short",)], "a STRING"), name, place, "a VARCHAR(5)")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        replace(spark.createDataFrame([("too long",)], "a STRING"), name, place, "a VARCHAR(5)")
    assert stored(spark, name) == [("short",)]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}_")]


def test_create_if_absent_keeps_what_is_there(spark, table, tmp_path):
    name = table("a INT")
    create_if_absent(spark, name, "b STRING", str(tmp_path / "other"))
    assert spark.table(name).columns == ["a"]


def test_halves_round_away_from_zero(spark):
    values = [(2.5,), (3.5,), (-2.5,), (2.4,), (None,)]
    out = conform(spark.createDataFrame(values, "a DOUBLE"), "a INT")
    assert [r.a for r in out.collect()] == [3, 4, -3, 2, None]


def test_assignment_casts(spark):
    df = spark.createDataFrame([(NOON, 123)], "created_at TIMESTAMP_NTZ, zip_code INT")
    out = conform(df, "zip_code VARCHAR(10), created_at DATE")
    assert tuple(out.first()) == ("123", date(2024, 5, 1))


@pytest.mark.parametrize(
    "row, message",
    [
        ((1, 7, "x" * 21, NOON), "EXCEED_LIMIT_LENGTH|exceeds"),
        ((3_000_000_000, 7, "A", NOON), "OVERFLOW"),
        ((None, 7, "A", NOON), "NULL in key column id"),
    ],
)
def test_a_bad_row_fails_the_whole_load(spark, table, row, message):
    name = table(DIM)
    with pytest.raises(Exception, match=message):
        load_keyed(orders(spark, (5, 7, "A", NOON), row), name, DIM)
    assert stored(spark, name) == []


def test_wide_tables_take_large_ids(spark, table):
    ddl = schemas.wide(DIM)
    name = table(ddl)
    load_keyed(orders(spark, (3_000_000_000, 7, "x" * 99, NOON)), name, ddl)
    assert stored(spark, name)[0][0] == 3_000_000_000


def test_require_key_passes_other_rows(spark):
    assert require_key(orders(spark, (1, None, None, None)), "id").count() == 1


def test_a_bucketed_table_is_not_shuffled_by_a_keyed_load(spark, table, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    name = table(DIM, bucket=("id", 4))
    for start in (0, 50):
        rows = [(n, 7, "A", NOON) for n in range(start, start + 100)]
        load_keyed(orders(spark, *rows), name, DIM)
    assert [r[0] for r in stored(spark, name)] == list(range(150))
    batch = conform(orders(spark, (1, 7, "A", NOON)), DIM)
    plan = insert_if_absent(batch, spark.table(name), "id")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
