"""Generated activity rows and their way through a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The kinds of action, the persons, and the first minute.
ACTIONS = ["walk", "run", "sit", "sleep"]
PERSONS = [1, 2, 3, 4]
START = "2021-01-01 00:00:00"
CSV_SCHEMA = "action_type STRING, timestamp STRING, person_id BIGINT"


def _pick(choices: list, seed: int, label: str):
    """An even draw that depends on seed and row number alone, so a retried task repeats it."""
    digest = F.md5(F.concat_ws("-", F.lit(f"{label}-{seed}"), F.col("id").cast("string")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % len(choices)
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (draw + 1).cast("int"))


def activities(ids: DataFrame, seed: int = 0) -> DataFrame:
    """One activity per row number in ``ids.id``, one minute apart.

    ``activities(spark.range(1000))`` gives a thousand.
    """
    start = F.lit(START).cast("timestamp_ntz")
    return ids.select(
        _pick(ACTIONS, seed, "action").alias("action_type"),
        F.timestamp_add("MINUTE", F.col("id"), start).alias("timestamp"),
        _pick(PERSONS, seed, "person").cast("bigint").alias("person_id"),
    )


def write_activities(rows: DataFrame, path: str) -> None:
    text = F.date_format(F.col("timestamp"), "yyyy-MM-dd HH:mm:ss")
    rows.withColumn("timestamp", text).write.csv(path, header=True)


def land_activities(spark: SparkSession, path: str) -> DataFrame:
    """The file's rows. The timestamp stays text: the file does not say it is one."""
    return spark.read.csv(path, schema=CSV_SCHEMA, header=True, enforceSchema=False)
