from datetime import date, datetime

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from storeloom.plans import marts

DAY = date(2024, 5, 1)
T = [datetime(2024, 5, 1, hour) for hour in range(24)]


def customer(id, first="A", last="B", gender="F"):
    return (id, first, last, gender, None, None)


def sale(order, customer_id, amount=1, price=10, product=5, coupon=None, day=DAY, net=None):
    gross = amount * price
    return (order, customer_id, product, coupon, "A", day, amount, price, gross, 0, net or gross)


def login(id, customer_id, at=T[0], ok=True):
    return (id, customer_id, ok, at)


def product(id=5, name="ring", price=10, category=1):
    return (id, name, price, category, None)


def test_burn_rate_truncates_each_sale(star, rows):
    tables = star(
        fact_sales=[sale(1, 1, 1, coupon=3), sale(2, 1, 1, coupon=3), sale(3, 1, day=date(2024, 5, 2))],
        dim_products=[product(price=99)],
        dim_coupons=[(3, 15)],
    )
    assert rows(marts.burn_rate(tables)) == [
        (datetime(2024, 5, 1), 28),
        (datetime(2024, 5, 2), 0),
    ]


def test_burn_rate_sorts_a_missing_day_last(star, rows):
    tables = star(fact_sales=[sale(1, 1, day=None), sale(2, 1)], dim_products=[product()])
    assert [day for day, _ in rows(marts.burn_rate(tables))] == [datetime(2024, 5, 1), None]


def test_items_are_counted_once_per_login(star, rows):
    tables = star(
        dim_customers=[customer(1)],
        fact_login_attempts=[login(1, 1, T[3]), login(2, 1, T[1], ok=False), login(3, 1, T[2])],
        fact_sales=[sale(1, 1, amount=4)],
    )
    assert rows(marts.login_purchase_correlations(tables)) == [("A B", T[1], T[3], 3, 1, 12)]
    assert rows(marts.login_purchase_true_items(tables)) == [("A B", T[1], T[3], 3, 1, 4)]


def test_logins_without_orders_and_orders_without_logins(star, rows):
    tables = star(
        dim_customers=[customer(1), customer(2, "C", "D")],
        fact_login_attempts=[login(1, 1)],
        fact_sales=[sale(1, 2)],
    )
    assert rows(marts.login_purchase_correlations(tables)) == [("A B", T[0], T[0], 1, 0, None)]


def test_customers_of_one_name_merge(star, rows):
    tables = star(
        dim_customers=[customer(1), customer(2)],
        fact_login_attempts=[login(n, 1 if n < 2 else 2) for n in range(5)],
        fact_sales=[sale(1, 1, amount=1), sale(2, 2, amount=10)],
    )
    assert rows(marts.login_purchase_correlations(tables)) == [("A B", T[0], T[0], 5, 2, 32)]


def test_names_that_only_look_alike_stay_apart(star, rows):
    tables = star(
        dim_customers=[customer(1, "A B", "C"), customer(2, "A", "B C")],
        fact_sales=[sale(1, 1), sale(2, 2)],
    )
    assert rows(marts.top_spender(tables)) == [("A B C", 10), ("A B C", 10)]


def test_a_missing_name_is_empty(star, rows):
    tables = star(dim_customers=[customer(1, None, "X")], fact_sales=[sale(1, 1)])
    assert rows(marts.top_spender(tables)) == [(" X", 10)]


def test_missing_totals_come_first(star, rows):
    unknown = (2, 2, 5, 3, "A", DAY, 1, 10, 10, 0, None)
    tables = star(
        dim_customers=[customer(1), customer(2, "C", "D"), customer(3, "E", "F")],
        fact_sales=[sale(1, 1), unknown, sale(3, 3, amount=2)],
    )
    assert rows(marts.top_spender(tables)) == [("C D", None), ("E F", 20), ("A B", 10)]


def test_rfm(star, rows):
    tables = star(
        dim_customers=[customer(1), customer(2, "C", "D"), customer(3, "E", "F")],
        fact_sales=[
            sale(1, 1, net=1),
            sale(2, 1, day=date(2024, 5, 3), net=1),
            sale(3, 2, day=date(2024, 5, 3), amount=9),
        ],
    )
    assert rows(marts.rfm(tables)) == [
        ("A B", datetime(2024, 5, 3), 2, 20),
        ("C D", datetime(2024, 5, 3), 1, 90),
    ]


def test_product_names_merge_within_a_category(star, rows):
    tables = star(
        dim_products=[product(5), product(6), product(7, category=2), product(8, category=9)],
        dim_category=[(1, "x"), (2, "y")],
        fact_sales=[sale(1, 1, product=5), sale(2, 1, product=6), sale(3, 1, 3, product=7), sale(4, 1, product=8)],
    )
    assert rows(marts.product_sales_category(tables)) == [("ring", "y", 30), ("ring", "x", 20)]


def test_missing_gender_is_a_group(star, rows):
    tables = star(
        dim_customers=[customer(1), customer(2, gender=None)],
        fact_sales=[sale(1, 1), sale(2, 2), sale(3, 2)],
    )
    assert sorted(rows(marts.customer_gender_sales(tables)), key=str) == [("F", 10), (None, 20)]


small = st.integers(1, 4)
world = st.fixed_dictionaries(
    {
        "customers": st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from(["X", None])), min_size=1, max_size=4),
        "logins": st.lists(st.tuples(small, st.integers(0, 23)), min_size=1, max_size=8),
        "sales": st.lists(st.tuples(small, st.one_of(st.none(), st.integers(1, 9))), max_size=8),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(world)
def test_login_totals_equal_the_full_join(star, world):
    """The plain definition: pair every login with every sale, then aggregate."""
    customers = [customer(n, *name) for n, name in enumerate(world["customers"], 1)]
    logins = [login(n, who, T[hour]) for n, (who, hour) in enumerate(world["logins"])]
    sales = [
        (n, who, 5, None, "A", DAY, amount, 1, 1, 0, 1)
        for n, (who, amount) in enumerate(world["sales"])
    ]
    tables = star(dim_customers=customers, fact_login_attempts=logins, fact_sales=sales)
    got = {tuple(r) for r in marts.login_purchase_correlations(tables).collect()}

    c = pd.DataFrame([(r[0], r[1], r[2]) for r in customers], columns=["id", "first", "last"])
    l = pd.DataFrame([(r[0], r[1], r[3]) for r in logins], columns=["login", "id", "at"])
    s = pd.DataFrame([(r[0], r[1], r[6]) for r in sales], columns=["order", "id", "amount"])
    s = s.astype({"id": "int64", "amount": "float64"})
    paired = c.merge(l, on="id").merge(s, on="id", how="left")
    expected = set()
    for (first, last), group in paired.groupby(["first", "last"], dropna=False):
        items = group["amount"].sum(min_count=1)
        expected.add(
            (
                f"{first} {'' if pd.isna(last) else last}",
                group["at"].min().to_pydatetime(),
                group["at"].max().to_pydatetime(),
                group["login"].nunique(),
                group["order"].nunique(),
                None if pd.isna(items) else int(items),
            )
        )
    assert got == expected


@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta", "America/Los_Angeles"])
def test_days_do_not_depend_on_the_time_zone(star, rows, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    tables = star(
        dim_customers=[customer(1)], fact_sales=[sale(1, 1)], dim_products=[product()]
    )
    assert rows(marts.burn_rate(tables)) == [(datetime(2024, 5, 1), 0)]
    assert rows(marts.rfm(tables))[0][1] == datetime(2024, 5, 1)
