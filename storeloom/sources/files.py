"""Landing readers. Each takes a path or glob and gives a frame in the declared columns.

A path that matches nothing gives ``None``: there is then nothing to land. What a reader can't keep
fails the job: a cell beyond the header, a key or column that is not declared, digits that a column
has no room for.
"""

from __future__ import annotations

import csv
import json
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce, wraps
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom import schemas
from storeloom.functions.conform import conform

# The cell texts that pandas' readers take as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Microseconds in one unit of a number since 1970.
UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1, "ns": 0.001}
# A column for the text of a CSV row that has more or fewer cells than its header.
RECORD = "_whole_record"
# A cell of such a row: quoted, with doubled quotes inside, or up to the next comma.
CELL = r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'
# Files whose header or schema is read at the same time.
AT_ONCE = 32
# Formats whose schemas Spark merges.
MERGED = {"parquet", "orc"}
# Parquet times in nanoseconds are read as numbers, which Spark does only where this is set.
NANOS = "spark.sql.legacy.parquet.nanosAsLong"


def none_if_no_files(read: Callable) -> Callable:
    @wraps(read)
    def landed(*args, **kwargs):
        try:
            return read(*args, **kwargs)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    return landed


def _typed(text: Column, kind: str, unit: str = "ms") -> Column:
    """A cell text as a value of the declared type; text that is not one fails the job."""
    if kind == "BIGINT":
        # A whole number may be written "7.0" by a tool that keeps missing cells as floats. One
        # with a fraction is not cut to fit.
        number = text.cast("decimal(38,6)")
        whole = F.round(number, 0)
        failure = F.raise_error(F.concat(F.lit("a fraction in a whole-number column: "), text))
        exact = F.when(number.isNull() | (number == whole), whole).otherwise(failure).cast("bigint")
        return F.coalesce(text.try_cast("bigint"), exact)
    if kind.startswith("TIMESTAMP"):
        return _timestamp(text, unit)
    if kind.startswith("DECIMAL"):
        exact = text.cast("decimal(38,12)")
        failure = F.raise_error(F.concat(F.lit(f"more digits than {kind}: "), text))
        fits = exact.isNull() | (exact == exact.cast(kind))
        return F.when(fits, exact).otherwise(failure).cast(kind)
    return text.cast(kind)


def _timestamp(text: Column, unit: str) -> Column:
    """A timestamp written as text, or as a number since 1970 in ``unit``: s, ms, us or ns.

    Text with an offset is an instant and becomes its time in UTC.
    """
    number = text.try_cast("bigint")
    micros = F.floor(number.cast("decimal(38,3)") * F.lit(str(UNITS[unit])).cast("decimal(10,3)"))
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    instant = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    offset = text.rlike(r"\d\d:\d\d.*(Z|[+-]\d\d(:?\d\d)?)$")
    return (
        F.when(number.isNotNull(), F.timestamp_add("MICROSECOND", micros.cast("bigint"), start))
        .when(offset, instant)
        .otherwise(F.when(~offset, text).cast("timestamp_ntz"))
    )


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file. Its job ends with the first row, so it reads one buffer, however
    many splits the file has."""
    row = spark.read.text(file).first()
    return row.value if row else None


@none_if_no_files
def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files that start with it. The driver gets a path and a line per file."""
    files = [unquote(file) for file in spark.read.text(path).inputFiles()]
    found = defaultdict(list)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        lines = pool.map(lambda file: _first_line(spark, file), files)
        for file, line in zip(files, lines):
            if line:
                found[line].append(file)
    return found


def _nothing_beyond(record: Column, width: int, cell: Column) -> Column:
    """True for a row whose cells beyond the header, if any, are blank; other rows fail.

    ``cell`` is one of the row's cells: Spark doesn't read a record's text alone.
    """
    cells = F.regexp_extract_all(record, F.lit(CELL), F.lit(1))
    beyond = F.filter(
        F.slice(cells, F.lit(width + 1), F.size(cells)),
        lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))) != "",
    )
    what = F.concat(F.lit("a row with more cells than the header: "), record)
    failure = F.raise_error(F.concat(what, F.substring(F.coalesce(cell, F.lit("")), 1, 0)))
    return F.when(record.isNull() | (F.size(beyond) == 0), F.lit(True)).otherwise(failure)


def land_csv(
    spark: SparkSession, path: str, ddl: str | None = None, line_breaks: bool = False
) -> DataFrame | None:
    """CSV files with a header row. Columns are matched by name, in any order in each file.

    A declared column that a file lacks is NULL there; a column that is not declared is an error.
    Without ``ddl`` every column found in any file is kept, as text. Quotes inside a quoted cell
    are doubled. A row with fewer cells than the header is filled up. Of one with more, blank cells
    beyond the header are let go, as a comma at the end of a line makes one; any other fails.
    ``line_breaks`` allows them in quoted cells; each file is then read by one task.
    """
    headers = _headers(spark, path)
    if not headers:
        return None
    parts = []
    for header, files in sorted(headers.items()):
        found = next(csv.reader([header]))
        declared = schemas.columns(ddl) if ddl else [(name, "STRING") for name in found]
        unknown = set(found) - {name for name, _ in declared}
        if unknown:
            raise ValueError(f"columns that are not declared: {', '.join(sorted(unknown))}")
        if len(set(found)) < len(found):
            raise ValueError(f"a column that is there twice: {header}")
        # All these files have this header, so cells are found by their place.
        text = T.StructType([T.StructField(name, T.StringType()) for name in [*found, RECORD]])
        # A parser that skips cells nobody reads doesn't count them.
        rows = spark.read.option("columnPruning", False).csv(
            sorted(files),
            schema=text,
            header=True,
            escape='"',
            multiLine=line_breaks,
            columnNameOfCorruptRecord=RECORD,
        )
        rows = rows.where(_nothing_beyond(F.col(RECORD), len(found), F.col(f"`{found[0]}`")))
        cells = {
            name: F.when(~F.col(f"`{name}`").isin(MISSING), F.col(f"`{name}`")) for name in found
        }
        parts.append(
            rows.select(
                *[
                    _typed(cells.get(name, F.lit(None).cast("string")), kind).alias(name)
                    for name, kind in declared
                ]
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _only(declared: list[str], keys: Column) -> Column:
    """True for a record without keys beyond the declared ones; any other fails."""
    unknown = F.array_except(keys, F.array(*[F.lit(name) for name in declared]))
    what = F.concat(F.lit("keys that are not declared: "), F.array_join(unknown, ", "))
    return F.when(F.size(unknown) == 0, F.lit(True)).otherwise(F.raise_error(what))


STRICT = {"mode": "FAILFAST"}


@none_if_no_files
def land_column_json(
    spark: SparkSession, path: str, ddl: str, unit: str = "ms"
) -> DataFrame | None:
    """JSON files of the form ``{"column": {"row": value, ...}, ...}``.

    Rows are the union of the row keys of all columns; a column without a row's key is NULL
    there. Cells meet by (file, row key) in a shuffle, so a file costs time in proportion to
    its cells. The document of one file is parsed by one task: this layout cannot be split. A
    broken document fails, and so does a column that is not declared. ``unit`` is that of
    timestamps written as numbers.
    """
    names = schemas.names(ddl)
    documents = spark.read.text(path, wholetext=True).select(
        "_metadata.file_path",
        F.from_json("value", "map<string,map<string,string>>", STRICT).alias("columns"),
    )
    cells = (
        documents.where(_only(names, F.map_keys("columns")))
        .select("file_path", F.explode("columns").alias("name", "cells"))
        .select("file_path", "name", F.explode("cells").alias("row", "cell"))
    )
    of = {name: F.max(F.when(F.col("name") == name, F.col("cell"))) for name in names}
    return (
        cells.groupBy("file_path", "row")
        .agg(*[cell.alias(name) for name, cell in of.items()])
        .select(*[_typed(F.col(n), kind, unit).alias(n) for n, kind in schemas.columns(ddl)])
    )


@none_if_no_files
def land_json_records(
    spark: SparkSession, path: str, ddl: str, lines: bool = True, unit: str = "ms"
) -> DataFrame | None:
    """JSON lines (splittable), or with ``lines=False`` one array of records per file.

    A broken record fails, and so does one with a key that is not declared. ``unit`` is that of
    timestamps written as numbers.
    """
    declared = schemas.columns(ddl)
    text = spark.read.text(path, wholetext=not lines).where(~F.col("value").rlike(r"^\s*$"))
    if lines:
        found = F.array(F.from_json("value", "map<string,string>", STRICT))
    else:
        one = F.concat(F.lit("["), "value", F.lit("]"))
        listed = F.when(F.col("value").rlike(r"^\s*\{"), one).otherwise(F.col("value"))
        found = F.from_json(listed, "array<map<string,string>>", STRICT)
    # What a generator gives is not copied into the filter, so a record is parsed once.
    records = text.select(F.explode(found).alias("record"))
    rows = records.where(_only([name for name, _ in declared], F.map_keys("record")))
    return rows.select(
        *[_typed(F.col("record")[name], kind, unit).alias(name) for name, kind in declared]
    )


def _as_declared(rows: DataFrame, ddl: str | None, unit: str, strict: bool) -> DataFrame:
    """``conform``, with NULL for a column that is lacking and times made from numbers."""
    if ddl is None:
        return rows
    found, cells = rows.schema, []
    unknown = set(found.names) - set(schemas.names(ddl))
    if strict and unknown:
        raise ValueError(f"columns that are not declared: {', '.join(sorted(unknown))}")
    for name, kind in schemas.columns(ddl):
        if name not in found.names:
            cells.append(F.lit(None).cast("string").alias(name))
        elif kind.startswith("TIMESTAMP") and isinstance(found[name].dataType, T.LongType):
            cells.append(_timestamp(F.col(f"`{name}`").cast("string"), unit).alias(name))
        else:
            cells.append(F.col(f"`{name}`"))
    return conform(rows.select(*cells), ddl)


def _by_schema(spark: SparkSession, files: list[str], format: str) -> list[DataFrame]:
    """A frame per schema that the files carry. The driver gets a path and a schema per file."""
    place = {unquote(file): file for file in files}
    with ThreadPoolExecutor(AT_ONCE) as pool:
        kinds = pool.map(lambda file: spark.read.format(format).load(file).schema, place)
        found = defaultdict(list)
        for file, kind in zip(place, kinds):
            found[kind.json()].append(file)
    return [
        spark.read.format(format).schema(T.StructType.fromJson(json.loads(kind))).load(part)
        for kind, part in sorted(found.items())
    ]


@none_if_no_files
def land_table(
    spark: SparkSession,
    path: str,
    ddl: str | None = None,
    format: str = "parquet",
    unit: str = "ns",
    strict: bool = False,
) -> DataFrame | None:
    """Files that carry their own schema: Parquet, Avro, ORC.

    Columns are matched by name. Files may differ in their columns and in the types of these: a
    column that a file lacks is NULL there. Without ``ddl`` every column of any file is kept; with it
    others are left out, unread, or with ``strict`` fail.
    Spark merges schemas of Parquet and ORC in tasks; only where types differ, and for formats it
    doesn't merge, the files are grouped by schema. Times that a file holds as numbers, which
    includes Parquet's nanoseconds, are in ``unit``; digits beyond microseconds are cut.
    """
    spark.conf.set(NANOS, "true")
    rows = spark.read.format(format).option("mergeSchema", True)
    if format in MERGED:
        try:
            return _as_declared(rows.load(path), ddl, unit, strict)
        except Exception as error:
            if "MERGE_SCHEMAS" not in str(error):
                raise
    # The schema given keeps Spark from merging those of the files, whose names alone are needed.
    files = spark.read.format(format).schema("storeloom_none INT").load(path).inputFiles()
    parts = [_as_declared(part, ddl, unit, strict) for part in _by_schema(spark, files, format)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
