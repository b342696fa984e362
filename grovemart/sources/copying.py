"""Files copied by tasks, from one file system to another: no byte goes through the driver.

A file is read as raw lines and written as it was. What fits one task arrives as one file of the
same bytes. A larger one arrives as a folder of parts, one a task, in the order of the file; every
part but the first begins with a copy of the header line, as parts of a delivery do. What was
copied is checked against the length of the source, then moved to its place in one rename, with a list
of the parts (`_parts`) that tells how to join them again.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grovemart.sources.files import (
    Entry,
    create_new,
    entries,
    is_folder,
    last_byte,
    length,
    literal,
    move,
    remove,
    replace,
    same_system,
)

#: Bytes of a file that one task copies.
PART_BYTES = 128 << 20
PARTS = "_parts"
CONCURRENT_COPIES = 8
_ROW_OF_TASK = 1 << 33


class IncompleteCopy(OSError):
    """Fewer or other bytes arrived than the source has."""


def _raw_lines(spark: SparkSession, path: str, end: str) -> DataFrame:
    """Lines of a file as they are, byte for byte, whatever its charset."""
    return spark.read.options(lineSep=end, encoding="ISO-8859-1").text(literal(path))


def _write(lines: DataFrame, end: str, path: str) -> tuple[int, int]:
    """Write `value` lines; returns the bytes that are from the source, and how many lines are not."""
    seen = Observation()
    counted = lines.observe(
        seen,
        F.coalesce(F.sum(F.when(~F.col("added"), F.octet_length("value") + 1)), F.lit(0)).cast("long").alias("bytes"),
        F.count_if("added").alias("added"),
    )
    counted.select("value").write.options(lineSep=end, encoding="ISO-8859-1").text(path)
    return seen.get["bytes"], seen.get["added"]


def _copy_small(spark: SparkSession, source: str, hidden: str) -> None:
    """One task, one file. Its last byte ends its lines, so that no line lacks an end."""
    last = last_byte(spark, source)
    if last is None:
        raise IncompleteCopy(f"{source} has no bytes")
    lines = _raw_lines(spark, source, chr(last)).coalesce(1).select("value", F.lit(False).alias("added"))
    apart = f"{hidden.rpartition('/')[0]}/_copied-{uuid.uuid4().hex}"
    try:
        copied, _ = _write(lines, chr(last), apart)
        _check(source, copied, length(spark, source))
        (part,) = entries(spark, apart)
        move(spark, part.path, hidden)
    finally:
        remove(spark, apart)


def _copy_large(spark: SparkSession, source: str, hidden: str, size: int) -> None:
    """A part for every task; the first line is set before each part but the one that begins with it."""
    rows = _raw_lines(spark, source, "\n")
    header = bytes(rows.select(F.col("value").cast("binary")).first()[0])
    at = F.monotonically_increasing_id() % _ROW_OF_TASK
    placed = rows.select("value", "_metadata.file_block_start", at.alias("at"))
    before = (F.col("at") == 0) & (F.col("file_block_start") > 0)
    own = F.struct("value", F.lit(False).alias("added"))
    title = F.struct(F.lit(bytearray(header)).cast("string").alias("value"), F.lit(True).alias("added"))
    lines = placed.select(F.inline(F.when(before, F.array(title, own)).otherwise(F.array(own))))
    copied, added = _write(lines, "\n", hidden)
    ended = last_byte(spark, source) == ord("\n")
    _check(source, copied, size + (not ended))
    parts = entries(spark, hidden)
    title_bytes = added * (len(header) + 1)
    _check(source, sum(p.length for p in parts) - title_bytes, copied)
    told = {"bytes": size, "line_break_added": not ended, "titles_added": added, "parts": [[p.name, p.length] for p in parts]}
    create_new(spark, f"{hidden}/{PARTS}", json.dumps(told))


def _check(source: str, copied: int, expected: int) -> None:
    if copied != expected:
        raise IncompleteCopy(f"{copied} instead of {expected} bytes of {source}")


def copy(spark: SparkSession, source: str, target: str, part_bytes: int = PART_BYTES) -> None:
    """Copy a file, or a folder of files, over `target`, which is replaced in one rename.

    The copy grows under a name that listings skip. The files of a folder are copied side by side, each
    by as many tasks as it has parts; parts of a large one lie beside the others under its name.
    """
    parent = target.rstrip("/").rpartition("/")[0]
    hidden = f"{parent}/_incoming-{uuid.uuid4().hex}"
    try:
        if is_folder(spark, source):
            files = [e for e in entries(spark, source) if e.is_folder or e.length]
            if any(e.is_folder for e in files):
                raise IncompleteCopy(f"{source} holds folders")
            with ThreadPoolExecutor(CONCURRENT_COPIES) as pool:
                done = [pool.submit(_copy_into, spark, e, hidden, part_bytes) for e in files]
            for one in done:
                one.result()
        elif length(spark, source) > part_bytes:
            _copy_large(spark, source, hidden, length(spark, source))
        else:
            _copy_small(spark, source, hidden)
        replace(spark, hidden, target)
    finally:
        remove(spark, hidden)


def _copy_into(spark: SparkSession, file: Entry, folder: str, part_bytes: int) -> None:
    """A file of a folder: under its own name, or its parts under names that begin with it."""
    if file.length <= part_bytes:
        _copy_small(spark, file.path, f"{folder}/{file.name}")
        return
    apart = f"{folder}-{uuid.uuid4().hex}"
    try:
        _copy_large(spark, file.path, apart, file.length)
        for part in entries(spark, apart):
            move(spark, part.path, f"{folder}/{file.name}-{part.name}")
        move(spark, f"{apart}/{PARTS}", f"{folder}/{PARTS}-{file.name}")
    finally:
        remove(spark, apart)


def bring(spark: SparkSession, source: str, target: str, move_it: bool = False) -> None:
    """Put a file or folder at `target`: by a rename where it may be moved and lies on the same file system,
    by a copy else."""
    if move_it and same_system(spark, source, target):
        replace(spark, source, target)
        return
    copy(spark, source, target)
    if move_it:
        remove(spark, source)
