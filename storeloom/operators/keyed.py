"""Loading rows under a key: the first row of a key stays, later ones are ignored.

Rows of a table have no order of their own. First is the lowest by the columns named, which for landed
rows is the batch they came in, and among these the lowest by all other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the lowest by ``order`` and then by the other columns, NULL lowest.

    A minimum is kept per key in every map task before the shuffle, so a key that holds a
    large share of the rows reaches its reducer as one row per task. Being an aggregate, it
    also tells the optimizer that the key is unique: a left join to it whose columns go
    unread is dropped.
    """
    if df.columns == [key]:
        return df.distinct()
    ranked = [*order, *(name for name in df.columns if name not in {key, *order})]
    lowest = df.groupBy(key).agg(F.min(F.struct(*ranked)).alias("row"))
    return lowest.select(*[name if name == key else f"row.{name}" for name in df.columns])


def lookup(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """``first_wins`` for the small side of a join whose large side may have hot keys.

    Spark splits a hot partition only if both sides reach the join straight from a shuffle
    made for it. An aggregate by the join key would take the place of that shuffle; the
    rebalancing in between restores it. It moves only the small side.
    """
    return first_wins(df, key, order).hint("rebalance")


def absent_from(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` lacks. Only the key of ``target`` is read."""
    return batch.join(target.select(key), key, "left_anti").select(*batch.columns)


def insert_if_absent(
    batch: DataFrame, target: DataFrame, key: str, order: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``batch`` an insert would add to ``target``.

    Known keys are dropped before the rows of a key are compared, so the sort and the shuffle of
    that comparison follow the new rows.
    """
    return first_wins(absent_from(batch, target, key), key, order)
