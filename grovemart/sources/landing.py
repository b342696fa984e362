"""Landing area: dated deliveries, what is still pending, and the manifest of what is done."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovemart.functions.paths import delivery_parts, delivery_path
from grovemart.schema import STATE_DOWNLOADED, STATE_PROCESSED
from grovemart.sources.delimited import write_raw
from grovemart.sources.copying import bring
from grovemart.sources.files import Entry, entries, literal, timestamp
from grovemart.sources.tables import list_paths

FILE_IDENTITY = ["path", "modificationTime", "length"]
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("delivery", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("state", T.StringType()),
        T.StructField("dataset", T.StringType()),
    ]
)


def land(raw: DataFrame, root: str, delivered_on: date, dataset: str, compression: str | None = None) -> str:
    """Put rows as a delivery where a download of that day puts it; the same day again replaces it.

    Its parts may be compressed with a codec that Spark's readers know by the suffix (gzip, say)."""
    path = delivery_path(root, delivered_on, dataset)
    write_raw(raw, path, compression)
    return path


def land_file(spark: SparkSession, source: str, root: str, delivered_on: date, dataset: str, move: bool = False) -> str:
    """Put a file or folder there byte by byte: what was delivered is what is kept.

    With `move` it is renamed where source and landing area share a file system. Else tasks copy it; a file too large
    for one task becomes a folder of parts, each with the header.
    """
    path = delivery_path(root, delivered_on, dataset)
    bring(spark, source, path, move)
    return path


#: Folders looked at side by side.
CONCURRENT_LISTINGS = 32
_DAY_PARTS = ("year", "month", "day")


def _before(path: str, since: date) -> bool:
    """Whether all days below a folder of the landing area lie before a day."""
    found = dict(re.findall(r"/(year|month|day)=([0-9]{1,4})(?=/|$)", path))
    known = []
    for name in _DAY_PARTS:
        if name not in found:
            break
        known.append(int(found[name]))
    return tuple(known) < (since.year, since.month, since.day)[: len(known)]


def open_folders(spark: SparkSession, root: str, since: date | None = None) -> tuple[list[str], list[Entry]]:
    """The folders in the downloaded state, and the files beside them that belong nowhere.

    Year, month and day folders are looked at level by level; what is processed is never listed, and neither are days
    before `since`. So the work grows with the days looked at and not with what was ever delivered.
    """
    found: list[str] = []
    stray: list[Entry] = []
    level = [root.rstrip("/")]
    if level[0].rpartition("/")[2] == STATE_DOWNLOADED:
        return level, []
    with ThreadPoolExecutor(CONCURRENT_LISTINGS) as pool:
        while level:
            below = [e for held in pool.map(lambda path: entries(spark, path), level) for e in held]
            stray += [e for e in below if not e.is_folder and e.length]
            inside = [e for e in below if e.is_folder and e.name != STATE_PROCESSED]
            if since is not None:
                inside = [e for e in inside if not _before(e.path, since)]
            found += [e.path for e in inside if e.name == STATE_DOWNLOADED]
            level = [e.path for e in inside if e.name != STATE_DOWNLOADED]
    return found, stray


def list_files(spark: SparkSession, root: str, since: date | None = None) -> DataFrame:
    """The files of the landing area that are not processed, with what their paths say about them."""
    found, stray = open_folders(spark, root, since)
    listing = spark.createDataFrame(
        [(e.path, timestamp(e.millis), e.length) for e in stray], "path string, modificationTime timestamp, length long"
    )
    if found:
        listing = list_paths(spark, [literal(path) for path in found]).union(listing)
    return listing.withColumns(delivery_parts(F.col("path"))).select(*MANIFEST_SCHEMA.fieldNames())


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Downloaded files not yet done. Time and size count too: a re-delivery is pending again."""
    downloaded = files.where(
        (F.col("state") == STATE_DOWNLOADED) & F.col("snapshot_date").isNotNull()
    )
    return _not_done(downloaded, manifest)


def stray_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that no job would ever read: another suffix, or a path off the contract. Not yet reported ones."""
    known = F.col("state").isin(STATE_DOWNLOADED, STATE_PROCESSED) & F.col("snapshot_date").isNotNull()
    processed = F.col("path").contains(f"/{STATE_PROCESSED}/")
    return _not_done(files.where(~F.coalesce(known, F.lit(False)) & ~processed), manifest)


def _not_done(files: DataFrame, manifest: DataFrame) -> DataFrame:
    return files.join(manifest.select(*FILE_IDENTITY), FILE_IDENTITY, "left_anti").select(
        *MANIFEST_SCHEMA.fieldNames()
    )


def last_of_each_path(manifest: DataFrame) -> DataFrame:
    """The manifest without the rows that later ones of the same path replace."""
    last = F.max_by(F.struct(*[name for name in manifest.columns if name != "path"]), "commit").alias("last")
    return manifest.groupBy("path").agg(last).select("path", "last.*").select(*manifest.columns)


def processed_path(path: str) -> str:
    """Where a done delivery moves to: the same place under the processed state."""
    head, found, tail = path.rpartition(f"/{STATE_DOWNLOADED}/")
    return f"{head}/{STATE_PROCESSED}/{tail}" if found else path
