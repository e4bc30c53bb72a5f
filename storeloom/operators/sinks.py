"""Table writes.

A *batched* table is a view over a table that has a partition per batch. An append writes a folder of
its own, and one change of the catalog makes it a partition: a reader sees all of its rows or none, and
a writer that is killed leaves the table as it was. ``replace`` swaps a table's folder in the same way.
An append to any other table is Spark's own commit, which moves file after file into the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom import schemas
from storeloom.functions.conform import conform, require_key
from storeloom.operators.keyed import insert_if_absent

# The column that a batched table is partitioned by, and the table below the view.
BATCH = "landed_batch"
BELOW = "__batches"
# The property that records the last batch of the source that a table has taken in.
TAKEN = "storeloom.taken"


def create_if_absent(
    spark: SparkSession,
    table: str,
    ddl: str,
    location: str | None = None,
    bucket: tuple[str, int] | None = None,
) -> None:
    """Create a Parquet table unless one of that name exists, whatever its columns.

    ``bucket`` (column, count) stores the rows hashed by that column, so that a later
    keyed load compares its batch with the table without shuffling the table.
    """
    buckets = f"CLUSTERED BY ({bucket[0]}) INTO {bucket[1]} BUCKETS" if bucket else ""
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {buckets} {place}")


def create_batched(
    spark: SparkSession,
    table: str,
    ddl: str,
    location: str,
    bucket: tuple[str, int] | None = None,
) -> None:
    """Create a batched table unless there is a table or view of that name."""
    if spark.catalog.tableExists(table):
        return
    buckets = f"CLUSTERED BY ({bucket[0]}) INTO {bucket[1]} BUCKETS" if bucket else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table}{BELOW} ({ddl}, {BATCH} BIGINT) USING parquet "
        f"PARTITIONED BY ({BATCH}) {buckets} LOCATION '{location}'"
    )
    columns = ", ".join(f"`{c}`" for c in spark.table(f"{table}{BELOW}").columns if c != BATCH)
    spark.sql(f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {columns} FROM {table}{BELOW}")


def is_batched(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(f"{table}{BELOW}")


def batches(spark: SparkSession, table: str) -> list[int]:
    """The numbers of the batches of a table, from the catalog alone."""
    if not is_batched(spark, table):
        return []
    rows = spark.sql(f"SHOW PARTITIONS {table}{BELOW}").collect()
    return sorted(int(r.partition.split("=", 1)[1]) for r in rows)


def rows_of(spark: SparkSession, table: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """The rows of the batches with numbers above ``after``, with the number in ``BATCH``. Only
    these partitions are read. Rows of a table that is not batched come as they are."""
    if not is_batched(spark, table):
        return spark.table(table)
    rows = spark.table(f"{table}{BELOW}").where(F.col(BATCH) > after)
    return rows if upto is None else rows.where(F.col(BATCH) <= upto)


def taken(spark: SparkSession, table: str) -> int:
    """The last batch of its source that a table has taken in, 0 for none."""
    if not is_batched(spark, table):
        return 0
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}{BELOW}").where(F.col("key") == TAKEN)
    found = properties.collect()
    return int(found[0].value) if found else 0


def take(spark: SparkSession, table: str, batch: int) -> None:
    """Record that a table has taken in the batches of its source up to ``batch``."""
    if is_batched(spark, table):
        spark.sql(f"ALTER TABLE {table}{BELOW} SET TBLPROPERTIES ('{TAKEN}' = '{batch}')")


def publish(df: DataFrame, table: str, batch: int | None = None) -> None:
    """Add the rows of ``df`` to a batched table as a batch: the next, or the one named."""
    spark, below = df.sparkSession, f"{table}{BELOW}"
    there = batches(spark, table)
    number = 1 + max(there, default=0) if batch is None else batch
    if number in there:
        raise ValueError(f"{table} has a batch {number} already")
    described = spark.sql(f"DESCRIBE FORMATTED {below}").where("col_name = 'Location'")
    version = uuid.uuid4().hex
    folder = f"{described.first().data_type.rstrip('/')}/{version}"
    staging, rows = f"{below}_{version}", f"rows_{version}"
    spark.sql(f"CREATE TABLE {staging} LIKE {below} USING parquet LOCATION '{folder}'")
    try:
        df.createOrReplaceTempView(rows)
        spark.sql(f"INSERT INTO {staging} PARTITION ({BATCH} = {number}) SELECT * FROM {rows}")
        if not spark.sql(f"SHOW PARTITIONS {staging}").isEmpty():
            place = f"{folder}/{BATCH}={number}"
            spark.sql(f"ALTER TABLE {below} ADD PARTITION ({BATCH} = {number}) LOCATION '{place}'")
    finally:
        # The staging table names the folder without owning it: its files stay.
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        spark.catalog.dropTempView(rows)


def append(df: DataFrame, table: str, batch: int | None = None) -> None:
    """Add the rows of ``df``, matched to the table's columns by name.

    A column that ``df`` lacks is NULL; one that the table lacks is an error. To a batched table
    they are added in one step, as ``batch``.
    """
    columns = df.sparkSession.table(table).columns
    unknown = set(df.columns) - set(columns)
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
    found = [F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in columns]
    if is_batched(df.sparkSession, table):
        publish(df.select(*found), table, batch)
    else:
        df.select(*found).write.insertInto(table)


def load_keyed(df: DataFrame, table: str, ddl: str, order: Sequence[str] = ()) -> None:
    """Insert the rows whose key (the first declared column) is new; change nothing else.

    Of several rows of a new key the lowest by ``order`` and then by the declared columns stays.
    """
    names = schemas.names(ddl)
    target = df.sparkSession.table(table)
    batch = require_key(conform(df, ddl, [c for c in order if c not in names]), names[0])
    append(insert_if_absent(batch, target, names[0], order).select(*names), table)


def replace(df: DataFrame, table: str, location: str, ddl: str | None = None) -> None:
    """Swap the content of ``table`` for ``df``.

    The rows go to a new folder below ``location`` first. Only when they are complete does
    the table point there, so a failed job leaves the old content, and a running reader
    keeps its files.
    """
    spark = df.sparkSession
    ddl = ddl or ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    version = uuid.uuid4().hex
    folder, staging = f"{location.rstrip('/')}/{version}", f"{table}_{version}"
    create_if_absent(spark, staging, ddl, folder)
    try:
        append(df, staging)
        declared = spark.table(staging).schema
        if is_batched(spark, table):
            spark.sql(f"DROP VIEW {table}")
            spark.sql(f"DROP TABLE {table}{BELOW}")
        if spark.catalog.tableExists(table) and spark.table(table).schema == declared:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            create_if_absent(spark, table, ddl, folder)
    finally:
        # The staging table names the folder without owning it: its files stay.
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
