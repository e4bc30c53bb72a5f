"""Helpers shared by the operators: stored steps, batched rows, labels for linked nodes."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.session import scratch_path

Batch = dict[str, list]


def read(spark, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever signs their names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again.

    A step that several later ones read is computed once, and a lost executor costs no more
    than the step that runs at the time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows.place = path
    return rows


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What a batch on its way to Python may hold at most: long texts would make it as large as they are.
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
}


def bound_batches(spark: SparkSession) -> None:
    """Keeps the batches that Python gets within BATCH_LIMITS for this session; smaller ones stay."""
    for name, limit in BATCH_LIMITS.items():
        found = re.fullmatch(r"(\d+)b?", str(spark.conf.get(name, None)).lower())
        if not found or not 0 < int(found[1]) <= limit:
            spark.conf.set(name, str(limit))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffle files that led to the step go once it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def emptied(df: DataFrame) -> None:
    """Frees the files of a stored step that nothing reads any more; an empty table stays."""
    rows = df.sparkSession.createDataFrame([], df.schema)
    rows.coalesce(1).write.mode("overwrite").parquet(df.place)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[Batch]], Iterator[Batch]], schema: str
) -> DataFrame:
    """``function`` over the batches of each partition, as lists of Python values by column.

    It yields lists too, or Arrow arrays of the types of ``schema``."""
    types = df.sparkSession.createDataFrame([], schema)
    names = types.columns
    arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in types.schema])

    def run(batches):
        rows = ({n: b.column(n).to_pylist() for n in b.schema.names} for b in batches)
        for out in function(rows):
            columns = [
                out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], arrow.field(n).type)
                for n in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def _arrow(kind: Any) -> pa.DataType:
    name = kind.simpleString()
    if name.startswith("array<"):
        return pa.list_(_arrow(kind.elementType))
    if name.startswith("struct<"):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "tinyint": pa.int8(),
    }[name]


def most_frequent(counts: DataFrame, limit: int) -> int:
    """Least ``n`` of ``counts`` that at most ``limit`` rows reach, to within a sixteenth of a
    doubling. Only the numbers of rows per step of ``n`` come to the driver."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).count().collect()
    rows, least = 0, None
    for r in sorted(steps, key=lambda r: -r.step):
        if rows + r["count"] > limit:
            break
        rows, least = rows + r["count"], r.step
    return (1 << 62) if least is None else math.ceil(2 ** (least / 16) - 1e-9)


def as_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


# Bits of a filter for ids: 2 MB.
FILTER_BITS = 1 << 24
# The bit of a ``doc_id``.
ID_SLOT = f"pmod(xxhash64(doc_id), {FILTER_BITS}L)"


def id_filter(ids: DataFrame) -> np.ndarray:
    """The bits, packed, of the values of ``ids.doc_id``; others may share one."""
    rows = (
        ids.selectExpr(f"{ID_SLOT} + 1 as slot")  # the bitmap functions count from 1
        .groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS, bool)
    for row in rows:
        found = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
        start = (row.bucket - 1) * len(found)
        bits[start : start + len(found)] = found[: FILTER_BITS - start]
    return np.packbits(bits)


def fold(column: str, mod: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; of the empty text for null."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def component_labels(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node it reaches.

    Alternating stars: every node hands the smallest node it knows to its larger neighbours,
    then to its smaller ones, until each edge points at the smallest node of its component.
    The edges never outnumber the links, a hub's edges are dealt over tasks by Spark's
    skewed-join handling, and each round is a stored table.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        name,
    )
    before = None
    # An aggregate is rebalanced before it is joined: only then can Spark split a hot partition.
    while (now := _digest(edges)) != before:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m")).hint("rebalance")
        large = settled(
            edges.toDF("v", "a").join(low, "a").selectExpr("v as a", "m as b").distinct(), name
        )
        parent = large.groupBy("a").agg(F.min("b").alias("m")).hint("rebalance")
        edges = settled(
            large.join(parent, "a")
            .selectExpr("inline(array(struct(a, m as b), struct(b as a, m as b)))")
            .where("a <> b")
            .distinct(),
            name,
        )
        before = now
    both = edges.union(edges.select(F.col("b").alias("a"), "b"))
    return both.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node")


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    )
