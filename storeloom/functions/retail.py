"""Expressions shared by the warehouse and the marts. Arguments are SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: str, last: str) -> Column:
    """First and last name with a blank between; a missing name counts as empty.

    ``concat_ws`` would drop the blank next to a missing name.
    """
    return F.expr(f"concat(coalesce({first}, ''), ' ', coalesce({last}, ''))")


def product_of(amount: str, price: str, whole: bool = True) -> str:
    """``amount`` times ``price``, exactly; ``whole`` says that prices are integers."""
    return f"{amount} * {price}" if whole else f"(cast({amount} as decimal(12,0)) * {price})"


def _share(value: str, percent: str, whole: bool) -> str:
    if whole:
        # The product is BIGINT so that it does not overflow before the division.
        return f"(cast({value} as bigint) * {percent}) div 100"
    # A division would round; DECIMAL(29,4) by DECIMAL(5,0) by a hundredth fits 38 digits.
    return f"({value} * cast({percent} as decimal(5,0)) * 0.01BD)"


def percent_of(value: str, percent: str, whole: bool = True) -> Column:
    """``percent`` per cent of ``value``: of integers truncated toward zero for each row, of
    decimals exact."""
    return F.expr(_share(value, percent, whole))


def net_of(gross: str, coupon_id: str, percent: str, whole: bool = True) -> Column:
    """``gross`` less the coupon. A known coupon without a percentage gives NULL."""
    return F.expr(f"{gross} - if({coupon_id} is not null, {_share(gross, percent, whole)}, 0)")


def day_of(ts: str) -> Column:
    """Midnight of the day of a date or timestamp, independent of the session time zone."""
    return F.expr(f"cast(cast({ts} as date) as timestamp_ntz)")
