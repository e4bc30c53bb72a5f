"""Keyed loads of the files that arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from storeloom import schemas
from storeloom.operators.sinks import load_keyed


def load_new_files(
    spark: SparkSession,
    path: str,
    landing_ddl: str,
    project: Callable[[DataFrame], DataFrame],
    table: str,
    ddl: str,
    checkpoint: str,
    format: str = "parquet",
    order: Sequence[str] = (),
) -> StreamingQuery:
    """Load each file once into a keyed table, then stop.

    ``checkpoint`` remembers the files. A batch that is repeated after a failure finds its
    keys present and adds nothing.
    """
    files = spark.readStream.schema(schemas.struct(landing_ddl)).format(format).load(path)

    def load(batch: DataFrame, _: int) -> None:
        load_keyed(project(batch), table, ddl, order)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
