from storeloom.operators.keyed import absent_from, first_wins, insert_if_absent, lookup
from storeloom.operators.sinks import (
    BATCH,
    append,
    batches,
    create_batched,
    create_if_absent,
    load_keyed,
    publish,
    replace,
    rows_of,
    take,
    taken,
)

__all__ = [
    "BATCH",
    "absent_from",
    "append",
    "batches",
    "create_batched",
    "create_if_absent",
    "first_wins",
    "insert_if_absent",
    "load_keyed",
    "lookup",
    "publish",
    "replace",
    "rows_of",
    "take",
    "taken",
]
