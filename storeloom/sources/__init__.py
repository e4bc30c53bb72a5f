from storeloom.sources.activities import activities, land_activities, write_activities
from storeloom.sources.files import (
    land_column_json,
    land_csv,
    land_json_records,
    land_table,
)

__all__ = [
    "activities",
    "land_activities",
    "land_column_json",
    "land_csv",
    "land_json_records",
    "land_table",
    "write_activities",
]
