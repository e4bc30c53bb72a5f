"""Casts applied when rows are assigned to a declared table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from storeloom import schemas

INTEGERS = {"INT", "BIGINT", "SMALLINT"}
FRACTIONS = (T.DoubleType, T.FloatType, T.DecimalType)


def _assign(name: str, source: T.DataType, target: str) -> str:
    if re.match(r"(VAR)?CHAR", target):
        # The length is checked by the table write, which knows the declared limit.
        return f"cast(`{name}` as string) as `{name}`"
    if target in INTEGERS and isinstance(source, FRACTIONS):
        # Halves round away from zero, as for a number that is assigned as literal text and so is
        # an exact NUMERIC. A bare cast would truncate.
        return f"cast(round(`{name}`, 0) as {target}) as `{name}`"
    return f"cast(`{name}` as {target}) as `{name}`"


def conform(df: DataFrame, ddl: str, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` cut to the declared columns, in declared order and type, and to those of ``keep``."""
    found = df.schema
    return df.selectExpr(
        *[_assign(name, found[name].dataType, kind) for name, kind in schemas.columns(ddl)],
        *[f"`{name}`" for name in keep],
    )


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Fail the job, before anything is committed, if a row has no key."""
    missing = f"raise_error('NULL in key column {key}')"
    return df.selectExpr(
        *[f"coalesce({key}, {missing}) as {key}" if n == key else f"`{n}`" for n in df.columns]
    )
