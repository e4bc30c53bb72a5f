"""Order lines, their discount, and the one line kept for each order."""

from datetime import date, datetime

from storeloom.plans import warehouse

DAY = datetime(2024, 5, 1, 13, 30)
ORDER = (1, 7, "A", DAY)


def test_first_item_of_an_order_wins(landing, rows):
    tables = landing(
        orders=[ORDER],
        order_items=[(12, 1, 5, 5, None), (11, 1, 5, 2, None)],
        products=[(5, "ring", 10, 1, None)],
    )
    assert warehouse.fact_sales_lines(tables).count() == 2
    assert rows(warehouse.fact_sales(tables)) == [
        (1, 7, 5, None, "A", date(2024, 5, 1), 2, 10, 20, 0, 20)
    ]


def test_first_item_is_the_first_of_a_known_product(landing, rows):
    tables = landing(
        orders=[ORDER],
        order_items=[(11, 1, 99, 2, None), (12, 1, 5, 3, None)],
        products=[(5, "ring", 10, 1, None)],
    )
    (row,) = rows(warehouse.fact_sales(tables))
    assert (row[2], row[6]) == (5, 3)


def test_copies_of_an_item_that_differ_leave_the_lowest(landing, rows):
    tables = landing(
        orders=[ORDER],
        order_items=[(11, 1, 6, 1, None), (11, 1, 5, 3, None), (11, 1, 5, 2, 1)],
        products=[(5, "ring", 10, 1, None), (6, "bolt", 20, 1, None)],
    )
    assert rows(warehouse.fact_sales(tables))[0][2:8] == (5, 1, "A", date(2024, 5, 1), 2, 10)


def test_all_values_come_from_one_item(landing, rows):
    """The kept item has no coupon; the coupon of a later item must not fill the gap."""
    tables = landing(
        orders=[ORDER],
        order_items=[(11, 1, 5, 2, None), (12, 1, 6, 9, 1)],
        products=[(5, "ring", 10, 1, None), (6, "bolt", 20, 1, None)],
        coupons=[(1, 50)],
    )
    assert rows(warehouse.fact_sales(tables))[0][2:4] == (5, None)


def test_discount_is_truncated(landing, rows):
    tables = landing(
        orders=[ORDER],
        order_items=[(11, 1, 5, 1, 3)],
        products=[(5, "ring", 99, 1, None)],
        coupons=[(3, 15)],
    )
    assert rows(warehouse.fact_sales(tables))[0][-3:] == (99, 15, 85)


def test_coupon_without_percentage(landing, rows):
    tables = landing(
        orders=[ORDER],
        order_items=[(11, 1, 5, 1, 3)],
        products=[(5, "ring", 99, 1, None)],
        coupons=[(3, None)],
    )
    assert rows(warehouse.fact_sales(tables))[0][-3:] == (99, 0, None)


def test_no_coupon_and_unknown_coupon_are_kept_undiscounted(landing, rows):
    tables = landing(
        orders=[ORDER, (2, 7, "A", DAY)],
        order_items=[(11, 1, 5, 1, None), (12, 2, 5, 1, 99)],
        products=[(5, "ring", 10, 1, None)],
        coupons=[(3, 50)],
    )
    found = sorted(rows(warehouse.fact_sales(tables)))
    assert [(row[0], row[3], row[-1]) for row in found] == [(1, None, 10), (2, 99, 10)]


def test_unknown_product_is_no_sale(landing):
    tables = landing(orders=[ORDER], order_items=[(11, 1, 99, 1, None)])
    assert warehouse.fact_sales_lines(tables).count() == 0
    assert warehouse.fact_sales(tables).count() == 0


def test_files_landed_twice_leave_the_same_sales(landing, rows):
    once = dict(
        orders=[ORDER, (2, 8, "B", DAY)],
        order_items=[(11, 1, 5, 2, 3), (12, 1, 5, 5, None), (13, 2, 5, 1, 3)],
        products=[(5, "ring", 10, 1, None)],
        coupons=[(3, 50)],
    )
    twice = {name: rows_ * 2 for name, rows_ in once.items()}
    expected = sorted(rows(warehouse.fact_sales(landing(**once))))
    assert sorted(rows(warehouse.fact_sales(landing(**twice)))) == expected
    assert warehouse.fact_sales_lines(landing(**twice)).count() == 3 * 2**4 - 8


def test_products_past_32_bits(landing, rows):
    tables = landing(
        orders=[ORDER],
        order_items=[(11, 1, 5, 3, 1)],
        products=[(5, "ring", 2**40, 1, None)],
        coupons=[(1, 10)],
    )
    assert rows(warehouse.fact_sales(tables))[0][-1] == 3 * 2**40 - 3 * 2**40 // 10
