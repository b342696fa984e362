"""What nothing points to any more: found by marking what is reachable, and removed once it is old enough.

Reachable are the days of the history that the log of deliveries points to, the published runs, the rows of
the log's commits, and the tables of this session. All else is left by broken or overtaken runs, or replaced. A
job at work has folders that nothing points to yet, so only what is older than `min_age` goes.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovemart.functions.paths import decoded_path
from grovemart.plans import jobs
from grovemart.session import runs_folder
from grovemart.sources import history as kept_rows
from grovemart.sources.files import Entry, entries, remove, timestamp
from grovemart.sources.history import SNAPSHOT
from grovemart.sources.landing import open_folders
from grovemart.sources.tables import list_paths

MIN_AGE = timedelta(days=2)


def history_folders(spark: SparkSession, lake: jobs.Lake) -> DataFrame:
    """The day folders of all runs of the history: folder, run, dataset, day, and when they were last written."""
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    files = list_paths(spark, lake.history, "*.parquet").select(folder.alias("folder"), "modificationTime")

    def part(name: str) -> Column:
        return decoded_path(F.regexp_extract("folder", f"/{name}=([^/]+)(/|$)", 1))

    return (
        files.groupBy("folder")
        .agg(F.max("modificationTime").alias("written"))
        .select("folder", part("run").alias("run"), part("dataset").alias("dataset"), part(SNAPSHOT).cast("date").alias(SNAPSHOT), "written")
    )


def _unreachable_history(spark: SparkSession, lake: jobs.Lake, before: datetime) -> list[str]:
    """Day folders that no kept delivery points to; a run folder as a whole where none of its days is kept."""
    if not entries(spark, lake.history):
        return []
    kept = kept_rows.kept(jobs.snapshots(spark, lake)).select("run", "dataset", SNAPSHOT)
    found = history_folders(spark, lake)
    gone = found.join(kept, ["run", "dataset", SNAPSHOT], "left_anti").where(F.col("written") < F.lit(before))
    alive = kept.select("run").distinct()
    parts = gone.join(alive, "run", "left_semi").select("folder")
    whole = gone.join(alive, "run", "left_anti").select(F.regexp_extract("folder", "^(.*/run=[^/]+)/", 1).alias("folder"))
    return [row[0] for row in parts.union(whole).distinct().toLocalIterator()]


def _old(found: list[Entry], before: datetime) -> list[str]:
    return [e.path for e in found if timestamp(e.millis) < before]


def _unpublished(spark: SparkSession, lake: jobs.Lake) -> list[Entry]:
    """Runs of typed tables and stars that were never published."""
    rows = jobs.log(spark, lake).rows(jobs.PUBLISHED).select("what", "dataset", "run").distinct()
    published = {tuple(row) for row in rows.toLocalIterator()}
    return [
        run
        for what in (jobs.TYPED, jobs.STAR)
        for dataset in entries(spark, f"{lake.root}/{what}")
        for run in entries(spark, dataset.path)
        if (what, dataset.name, run.name.removeprefix("run=")) not in published
    ]


def unreachable(spark: SparkSession, lake: jobs.Lake, min_age: timedelta = MIN_AGE) -> dict[str, list[str]]:
    """Folders that may go, by kind."""
    before = jobs.now() - min_age
    own = spark.conf.get("spark.app.id")
    downloaded, _ = open_folders(spark, lake.landing)
    unfinished = [e for folder in [*downloaded, f"{lake.root}/stage"] for e in entries(spark, folder, hidden=True) if e.is_folder]
    return {
        "history": _unreachable_history(spark, lake, before),
        "pending": _old(entries(spark, f"{lake.root}/pending"), before),
        "log": _old(jobs.log(spark, lake).unreferenced(), before),
        "runs": _old(_unpublished(spark, lake), before),
        "unfinished": _old(unfinished, before),
        "sessions": _old([e for e in entries(spark, runs_folder(spark)) if e.name != own], before),
    }


def sweep(spark: SparkSession, lake: jobs.Lake, min_age: timedelta = MIN_AGE) -> dict[str, int]:
    """Remove what is unreachable; the number of folders removed, by kind."""
    found = unreachable(spark, lake, min_age)
    jobs.side_by_side(lambda path: remove(spark, path), [p for paths in found.values() for p in paths], jobs.CONCURRENT_PEEKS)
    return {kind: len(paths) for kind, paths in found.items()}
