"""Delimited text: raw deliveries and the stage copy."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovemart.functions.paths import decoded_path
from grovemart.schema import (
    CLEAN_SCHEMA,
    CORRUPT_RECORD,
    EXTRA,
    EXTRA_TYPE,
    RAW_ENCODING,
    RAW_HEADERS,
    RAW_SEPARATOR,
    STAGE_SEPARATOR,
    strings,
)
from grovemart.sources.files import literal

RAW_OPTIONS = {"sep": RAW_SEPARATOR, "header": "true", "encoding": RAW_ENCODING}
# Doubled quotes, so that other CSV readers understand the file.
STAGE_OPTIONS = {"sep": STAGE_SEPARATOR, "header": "true", "escape": '"'}
# A written value keeps the blanks around it.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Rows of a compressed file at most: such a file is read by one task.
COMPRESSED_ROWS = 1_000_000


class HeaderMismatch(ValueError):
    """The file's columns are not those of the data contract (or were read with the wrong charset)."""


def header_names(line: str) -> list[str]:
    """The column names of a header line, read as Spark reads it."""
    return next(csv.reader([line], delimiter=RAW_SEPARATOR, quotechar='"', escapechar="\\", doublequote=False), [])


def header_problem(header: list[str], further_allowed: bool = False) -> str | None:
    """What is wrong with a header; the order of its columns is free, and there may be further ones if that is allowed."""
    missing = [name for name in RAW_HEADERS if name not in header]
    further = [name for name in header if name not in RAW_HEADERS]
    if missing:
        return f"missing columns {missing} in header {header}"
    if len({name.lower() for name in header}) < len(header):
        return f"columns that come twice in header {header}"
    if further and not further_allowed:
        return f"columns {further or header} beyond the contract in header {header}"
    return None


def raw_schema(spark: SparkSession, paths: str | list[str]) -> T.StructType:
    """All-string schema in the order of the files' header, after checking that header."""
    header = spark.read.options(**RAW_OPTIONS).csv(paths).columns
    problem = header_problem(header)
    if problem:
        raise HeaderMismatch(problem)
    return strings(header)


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """`path` and `line`, a checksum of the first line, of all text files with any line.

    Found by the tasks that read the files' beginnings; rows of a beginning are numbered in the order of
    the file. A checksum is a number, so that tasks keep one row a file and sort nothing.
    """
    rows = spark.read.text(as_paths(paths)).where("_metadata.file_block_start = 0")
    numbered = rows.select(
        decoded_path(F.col("_metadata.file_path")).alias("path"),
        F.xxhash64("value").alias("line"),
        F.monotonically_increasing_id().alias("at"),
    )
    return numbered.groupBy("path").agg(F.min_by("line", "at").alias("line"))


def as_paths(paths: str | list[str]) -> str | list[str]:
    """Paths as they are written: a bracket in a file name is no pattern."""
    return literal(paths) if isinstance(paths, str) else [literal(path) for path in paths]


def read_raw(
    spark: SparkSession,
    paths: str | list[str],
    keep_corrupt: bool = False,
    header: list[str] | None = None,
    with_path: bool = False,
    with_extra: bool = False,
) -> DataFrame:
    """Raw deliveries as strings, in contract order whatever the order in the file.

    `enforceSchema=false` makes Spark compare every file's own header with the schema,
    so a file whose columns differ fails instead of being mapped by position. Lines are
    never joined, so large files are split. Ragged rows are padded or cut; with
    `keep_corrupt` their text is kept beside them. A `header` that is known is not looked up;
    `with_path` adds each row's file as `file_path`,
    `with_extra` a map of the columns beyond the contract.
    """
    paths = as_paths(paths)
    schema = raw_schema(spark, paths) if header is None else strings(header)
    columns = list(RAW_HEADERS)
    if keep_corrupt:
        schema = schema.add(CORRUPT_RECORD, T.StringType())
        columns.append(CORRUPT_RECORD)
    rows = (
        spark.read.schema(schema)
        .options(**RAW_OPTIONS)
        .option("enforceSchema", "false")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .csv(paths)
    )
    added = ["_metadata.file_path"] if with_path else []
    if with_extra:
        added.append(_extra([name for name in schema.names if name not in columns]).alias(EXTRA))
    return rows.select(*[f"`{name}`" for name in columns], *added)


def _extra(names: list[str]) -> Column:
    """A map of columns by their names; NULL where there are none."""
    if not names:
        return F.lit(None).cast(EXTRA_TYPE)
    quoted = [name.replace("`", "``") for name in names]
    return F.create_map(*[one for name, q in zip(names, quoted, strict=True) for one in (F.lit(name), F.col(f"`{q}`"))])


def compressed(compression: str | None) -> dict[str, str | int]:
    """Options of a writer whose files are compressed with a codec, or not."""
    return {} if compression is None else {"compression": compression, "maxRecordsPerFile": COMPRESSED_ROWS}


def write_raw(df: DataFrame, path: str, compression: str | None = None) -> None:
    columns = [f"`{name}`" for name in RAW_HEADERS]
    writer = df.select(*columns).write.mode("overwrite")
    writer.options(**RAW_OPTIONS, **KEEP_BLANKS, **compressed(compression)).csv(path)


def write_stage(df: DataFrame, path: str, compression: str | None = None) -> int:
    """Write `df` over `path` and return its row count, observed during that one write."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").options(**STAGE_OPTIONS, **KEEP_BLANKS, **compressed(compression)).csv(path)
    return seen.get["rows"]


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(CLEAN_SCHEMA)
        .options(**STAGE_OPTIONS)
        .option("enforceSchema", "false")
        .csv(as_paths(path))
    )
