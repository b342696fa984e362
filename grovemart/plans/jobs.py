"""The batch jobs: convert deliveries, load the typed registry, build the star, run all three.

No job overwrites what readers see. Each writes folders of its own run and then one commit to the
log, and readers follow the log: a broken run, or a bad delivery, leaves everything as it was. Any
number of jobs may run at the same time. A commit that finds others before it looks at what they
did: where they took the same files or days, or published the same tables, the job does its work
again on what is left, else it goes behind them.
Deliveries are kept or rejected one by one; rejections are a table with reasons, and the job that
finds them ends with an error that names them, after all good ones are in.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from itertools import count
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovemart.functions.paths import decoded_path, delivery_parts
from grovemart.operators import quality, star
from grovemart.operators.cleaning import clean, typed
from grovemart.schema import (
    CORRUPT_RECORD,
    DIM_LOCATION,
    FACT_AREA,
    LOCATION_SCHEMA,
    ONE_LOCATION,
    RAW_ENCODING,
    STAR_SCHEMAS,
    STATE_DOWNLOADED,
    TYPED_SCHEMA,
)
from grovemart.sources import history as kept_rows
from grovemart.sources.commits import EVERY, Log
from grovemart.sources.delimited import first_lines, header_names, header_problem, read_raw, write_stage
from grovemart.sources.files import first_line, folders, move, remove
from grovemart.sources.history import LOG_SCHEMA, SNAPSHOT
from grovemart.sources.jdbc import Database, export_table
from grovemart.sources.landing import (
    FILE_IDENTITY,
    MANIFEST_SCHEMA,
    last_of_each_path,
    list_files,
    pending_files,
    processed_path,
    stray_files,
)
from grovemart.sources.tables import read_table, replace_table, write_observed

#: Spark jobs side by side, files looked at side by side, and runs whose folders are kept.
CONCURRENT_JOBS = 4
CONCURRENT_PEEKS = 32
KEEP_RUNS = 3
#: So many deliveries are read one by one, whose rows need not be told apart by their paths.
READ_ALONE = 32
TYPED = "typed"
STAR = "star"
PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("what", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)
REJECTED_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField(SNAPSHOT, T.DateType()),
        T.StructField("delivery", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)
#: What a published run's writes have counted: of a table, a metric and its value.
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("what", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)
#: The tables of the log.
MANIFEST, SNAPSHOTS, REJECTED, PUBLISHED, METRICS = "manifest", "snapshots", "rejected", "published", "metrics"
LOG = {
    MANIFEST: MANIFEST_SCHEMA,
    SNAPSHOTS: LOG_SCHEMA,
    REJECTED: REJECTED_SCHEMA,
    PUBLISHED: PUBLISHED_SCHEMA,
    METRICS: METRICS_SCHEMA,
}
#: Files of a run's listing that are not done; strays are those that no job would read.
UNSEEN_SCHEMA = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("stray", T.BooleanType())])
#: Reasons that are no fault of a delivery: a newer one of the same day is kept instead.
OLDER = "a newer delivery of this day is kept"


class DeliveryRejected(ValueError):
    """Deliveries that were not taken in; all others were."""


@dataclass(frozen=True)
class Delivery:
    """A file or a folder of files that arrived for a dataset and day."""

    dataset: str
    day: date
    path: str
    files: tuple[str, ...]
    time: datetime


@dataclass(frozen=True)
class Lake:
    """Folders of one installation. `landing` is where downloads arrive; with `window`, only days up to so many
    before the newest one kept are looked at there. The log has a checkpoint every so many commits. Deliveries with columns beyond the
    contract are rejected, or, with `extra_columns`, kept with them. The files of the stage copy are compressed
    with `compression`, if it is given."""

    landing: str
    root: str
    window: int | None = None
    log_every: int = EVERY
    extra_columns: bool = False
    compression: str | None = None

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def history(self) -> str:
        """Clean rows of all deliveries: a folder per run, dataset and day."""
        return f"{self.root}/history"

    def pending(self, run: str) -> str:
        return f"{self.root}/pending/run={run}"

    def stage(self, dataset: str) -> str:
        return f"{self.root}/stage/{dataset}"

    def runs(self, what: str, dataset: str) -> str:
        return f"{self.root}/{what}/{dataset}"

    def typed(self, dataset: str, run: str) -> str:
        return f"{self.runs(TYPED, dataset)}/run={run}"

    def star(self, dataset: str, run: str, table: str) -> str:
        return f"{self.runs(STAR, dataset)}/run={run}/{table}"


def side_by_side(job: Callable[[Any], Any], items: Iterable[Any], threads: int = CONCURRENT_JOBS) -> list[Any]:
    """Run independent jobs at the same time, so that small ones fill the gaps of large ones."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(job, items))


def now() -> datetime:
    return datetime.now(timezone.utc)


def new_run() -> str:
    return now().strftime("%Y%m%dT%H%M%S%f")


def log(spark: SparkSession, lake: Lake) -> Log:
    """What counts in the lake: files done, deliveries kept and rejected, runs published."""
    return Log(spark, lake.log, LOG, {MANIFEST: last_of_each_path}, lake.log_every)


def snapshots(spark: SparkSession, lake: Lake, dataset: str | None = None) -> DataFrame:
    """The log of kept deliveries, of one dataset or all."""
    rows = log(spark, lake).rows(SNAPSHOTS)
    return rows if dataset is None else rows.where(F.col("dataset") == dataset)


def rejections(spark: SparkSession, lake: Lake) -> DataFrame:
    return log(spark, lake).rows(REJECTED)


def history(spark: SparkSession, lake: Lake, dataset: str, extra: bool = False) -> DataFrame:
    """The clean rows of all kept deliveries of a dataset, with their days, and `extra`, the columns beyond the contract."""
    return kept_rows.read_history(spark, lake.history, snapshots(spark, lake, dataset), extra)


def newest(spark: SparkSession, lake: Lake, dataset: str) -> Row:
    """Log row of the newest delivery kept."""
    row = kept_rows.kept(snapshots(spark, lake, dataset)).orderBy(F.desc(SNAPSHOT)).first()
    if row is None:
        raise LookupError(f"no delivery of {dataset}")
    return row


def current(spark: SparkSession, lake: Lake, dataset: str, extra: bool = False) -> DataFrame:
    """The clean rows of the newest delivery, read in place: there is no copy to keep up."""
    row = newest(spark, lake, dataset)
    return kept_rows.read_snapshot(spark, lake.history, row["run"], dataset, row[SNAPSHOT], extra)


def current_ragged(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """Rows of the newest delivery with too few or too many fields, as they were."""
    row = newest(spark, lake, dataset)
    rows = kept_rows.read_run(spark, lake.history, row["run"])
    mine = rows.where((F.col("dataset") == dataset) & (F.col(SNAPSHOT) == row[SNAPSHOT]))
    return quality.ragged_rows(mine).select(CORRUPT_RECORD)


def read_pending(spark: SparkSession, lake: Lake, run: str) -> DataFrame:
    """The files that were pending when a run looked."""
    return read_table(spark, lake.pending(run), UNSEEN_SCHEMA).where("not stray").drop("stray")


def landed(spark: SparkSession, lake: Lake) -> DataFrame:
    """The files of the landing area that are not processed, of the days that are looked at."""
    since = None
    if lake.window is not None:
        newest_day = snapshots(spark, lake).agg(F.max(SNAPSHOT)).first()[0]
        since = newest_day and newest_day - timedelta(days=lake.window)
    return list_files(spark, lake.landing, since)


def _unseen(spark: SparkSession, lake: Lake, run: str, version: int) -> tuple[DataFrame, int]:
    """The listing of the landing area, and the number of its files that are not done.

    Those are written down first, so exactly they are marked as done later, even if more arrive meanwhile.
    """
    files = landed(spark, lake)
    manifest = log(spark, lake).rows(MANIFEST, upto=version)
    pending = pending_files(files, manifest).withColumn("stray", F.lit(False))
    strays = stray_files(files, manifest).withColumn("stray", F.lit(True))
    return files, replace_table(pending.union(strays), lake.pending(run))


def _arrived(files: DataFrame, pending: DataFrame) -> list[Delivery]:
    """Deliveries with a pending file, each with all its files."""
    whole = files.join(pending.select("delivery").distinct(), "delivery").groupBy("dataset", SNAPSHOT, "delivery")
    rows = whole.agg(F.sort_array(F.collect_list("path")).alias("files"), F.max("modificationTime").alias("time"))
    return [
        Delivery(r["dataset"], r[SNAPSHOT], r["delivery"], tuple(r["files"]), r["time"])
        for r in rows.orderBy("dataset", SNAPSHOT, "delivery").toLocalIterator()
    ]


def _newest_of_each_day(deliveries: list[Delivery], log: DataFrame) -> tuple[list[Delivery], list[tuple[Delivery, str]]]:
    """The newest delivery of each dataset and day, those kept before counted in; the others are rejected."""
    known = {(r["dataset"], r[SNAPSHOT]): r for r in kept_rows.kept(log).toLocalIterator()}
    by_day: dict[tuple, list[Delivery]] = defaultdict(list)
    for delivery in deliveries:
        by_day[delivery.dataset, delivery.day].append(delivery)
    taken, rejected = [], []
    for key, same_day in by_day.items():
        best = max(same_day, key=lambda d: (d.time, d.path))
        before = known.get(key)
        older = before is not None and before["delivery"] != best.path and before["delivered_at"] > best.time
        if not older:
            taken.append(best)
        rejected += [(d, OLDER) for d in same_day if older or d is not best]
    return taken, rejected


def _headers(spark: SparkSession, deliveries: list[Delivery]) -> dict[str, set[tuple[str, ...]]]:
    """Header lines of each delivery that has any, found by a scan of the files' beginnings.

    The driver opens one file for every different header.
    """
    files = [file for delivery in deliveries for file in delivery.files]
    lines = first_lines(spark, files).withColumn("delivery", delivery_parts(F.col("path"))["delivery"])
    found = lines.groupBy("delivery", "line").agg(F.min("path").alias("path")).collect() if files else []
    sample = {row["line"]: row["path"] for row in found}
    texts = side_by_side(lambda path: first_line(spark, path, RAW_ENCODING), sample.values(), CONCURRENT_PEEKS)
    text_of = dict(zip(sample, texts, strict=True))
    headers: dict[str, set[tuple[str, ...]]] = defaultdict(set)
    for row in found:
        headers[row["delivery"]].add(tuple(header_names(text_of[row["line"]])))
    return headers


def _by_header(
    spark: SparkSession, deliveries: list[Delivery], further_allowed: bool = False
) -> tuple[dict[tuple, list[Delivery]], list[tuple[Delivery, str]]]:
    """Deliveries that can be read together, by their header; those whose header is wrong are rejected."""
    headers_of = _headers(spark, deliveries)
    groups: dict[tuple, list[Delivery]] = defaultdict(list)
    rejected = []
    for delivery in deliveries:
        # A part without any line has no rows either.
        headers = headers_of.get(delivery.path, set())
        problems = [p for p in (header_problem(list(h), further_allowed) for h in sorted(headers)) if p]
        if not headers:
            rejected.append((delivery, "no header"))
        elif problems:
            rejected.append((delivery, problems[0]))
        elif len(headers) > 1:
            rejected.append((delivery, "its files have different headers"))
        else:
            groups[next(iter(headers))].append(delivery)
    return dict(groups), rejected


def _delivered_rows(spark: SparkSession, header: tuple, deliveries: list[Delivery]) -> DataFrame:
    """The clean rows of deliveries, with their datasets and days; those of many are told by the paths of the rows."""

    def read(some: list[Delivery], with_path: bool) -> DataFrame:
        files = [file for delivery in some for file in delivery.files if file]
        return clean(read_raw(spark, files, keep_corrupt=True, header=list(header), with_path=with_path, with_extra=True))

    if len(deliveries) <= READ_ALONE:
        alone = [read([d], False).withColumns({"dataset": F.lit(d.dataset), SNAPSHOT: F.lit(d.day)}) for d in deliveries]
        return reduce(DataFrame.unionByName, alone)
    parts = delivery_parts(decoded_path(F.col("file_path")))
    return read(deliveries, True).withColumns({name: parts[name] for name in ("dataset", SNAPSHOT)}).drop("file_path")


def _keep(spark: SparkSession, lake: Lake, run: str, header: tuple, deliveries: list[Delivery]) -> list[tuple]:
    """Write all rows of deliveries with one header in one job; returns their log rows."""
    kept_rows.write_run(_delivered_rows(spark, header, deliveries), lake.history, run)
    counted = {
        (r["dataset"], r[SNAPSHOT]): r
        for r in kept_rows.read_run(spark, lake.history, run)
        .groupBy("dataset", SNAPSHOT)
        .agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT_RECORD).alias("ragged"))
        .toLocalIterator()
    }
    done = []
    for d in deliveries:
        count = counted.get((d.dataset, d.day))
        size = (count["rows"], count["ragged"]) if count else (0, 0)
        done.append((d.dataset, d.day, *size, run, d.path, d.time, now()))
    return done


def take_in(spark: SparkSession, lake: Lake, run: str) -> tuple[dict[str, int], list[tuple]]:
    """Read all pending deliveries; returns the row count of each dataset touched, and the rejections.

    Deliveries with the same header are read and written by one job, whatever their number. Of
    several deliveries of a day the newest by time is kept, in whatever run they come. Files are
    marked as done by the commit that keeps or rejects their delivery. The stage copy holds the newest
    delivery. Files that another job takes in meanwhile are left to it.
    """
    for attempt in count():
        done = _attempt(spark, lake, f"{run}-{attempt}" if attempt else run)
        if done is not None:
            break
    kept, rejected = done
    datasets = sorted({row[0] for row in kept})
    counts = side_by_side(lambda name: _write_stage(spark, lake, name), datasets)
    return dict(zip(datasets, counts, strict=True)), rejected


def _attempt(spark: SparkSession, lake: Lake, run: str) -> tuple[list[tuple], list[tuple]] | None:
    """Log rows of the deliveries kept and rejected; None if another job was faster with one of them."""
    book = log(spark, lake)
    version = book.version()
    files, number = _unseen(spark, lake, run, version)
    if not number:
        return [], []
    unseen = read_table(spark, lake.pending(run), UNSEEN_SCHEMA)
    arrived = _arrived(files, unseen.where("not stray"))
    taken, older = _newest_of_each_day(arrived, book.rows(SNAPSHOTS, upto=version))
    groups, wrong = _by_header(spark, taken, lake.extra_columns)

    def keep(numbered: tuple[int, tuple]) -> list[tuple]:
        number, (header, deliveries) = numbered
        return _keep(spark, lake, f"{run}-{number}", header, deliveries)

    kept = [row for rows in side_by_side(keep, enumerate(groups.items())) for row in rows]
    strays = [
        (r["dataset"] or None, r[SNAPSHOT], r["path"], "suffix or path off the contract", run)
        for r in unseen.where("stray").toLocalIterator()
    ]
    rejected = [(d.dataset, d.day, d.path, reason, run) for d, reason in [*older, *wrong]] + strays
    rows = {SNAPSHOTS: (kept, LOG_SCHEMA), REJECTED: (rejected, REJECTED_SCHEMA)}
    staged = {name: spark.createDataFrame(r, schema).coalesce(1) for name, (r, schema) in rows.items() if r}
    if _committed(book, {MANIFEST: unseen.drop("stray"), **staged}, version, _same_files_or_days(unseen, kept)):
        return kept, rejected
    for number in range(len(groups)):
        remove(spark, kept_rows.run_path(lake.history, f"{run}-{number}"))
    return None


def _committed(book: Log, rows: dict[str, DataFrame], version: int, clash: Callable[[Log, int, int], bool]) -> bool:
    """Commit rows made from the state at `version`; False if a commit since then clashes with them."""
    staged = book.stage(rows)
    while not book.commit(staged, version):
        last = book.version()
        if clash(book, version, last):
            return False
        version = last
    return True


def _same_files_or_days(unseen: DataFrame, kept: list[tuple]) -> Callable[[Log, int, int], bool]:
    days = {(row[0], row[1]) for row in kept}

    def clash(book: Log, after: int, upto: int) -> bool:
        theirs = book.rows(MANIFEST, after, upto).select(*FILE_IDENTITY)
        if not theirs.join(unseen, FILE_IDENTITY, "left_semi").isEmpty():
            return True
        kept_since = book.rows(SNAPSHOTS, after, upto).select("dataset", SNAPSHOT).distinct()
        return any(tuple(row) in days for row in kept_since.toLocalIterator())

    return clash


def _write_stage(spark: SparkSession, lake: Lake, dataset: str) -> int:
    """The newest delivery as the stage copy, which changes in one rename; its row count."""
    while True:
        run = newest(spark, lake, dataset)["run"]
        hidden = f"{lake.root}/stage/_{dataset}-{new_run()}"
        rows = write_stage(current(spark, lake, dataset), hidden, lake.compression)
        remove(spark, lake.stage(dataset))
        move(spark, hidden, lake.stage(dataset))
        if newest(spark, lake, dataset)["run"] == run:
            return rows


def nothing_pending(spark: SparkSession, lake: Lake) -> bool:
    """Whether a conversion would find nothing to do."""
    files, manifest = landed(spark, lake), log(spark, lake).rows(MANIFEST)
    return pending_files(files, manifest).union(stray_files(files, manifest)).isEmpty()


def move_done(spark: SparkSession, lake: Lake) -> int:
    """Move kept deliveries out of the downloaded state, so that later listings are short; their number."""
    files = landed(spark, lake)
    waiting = pending_files(files, log(spark, lake).rows(MANIFEST)).select("delivery").distinct()
    done = kept_rows.kept(snapshots(spark, lake)).select("delivery").join(waiting, "delivery", "left_anti")
    there = files.where(F.col("state") == STATE_DOWNLOADED).select("delivery").distinct().join(done, "delivery")
    paths = [row[0] for row in there.toLocalIterator()]

    def step(path: str) -> None:
        remove(spark, processed_path(path))
        move(spark, path, processed_path(path))

    side_by_side(step, paths, CONCURRENT_PEEKS)
    return len(paths)


def _tell(rejected: list[tuple]) -> None:
    faults = [f"{path}: {reason}" for _, _, path, reason, _ in rejected if reason != OLDER]
    if faults:
        raise DeliveryRejected("; ".join(faults))


def convert(spark: SparkSession, lake: Lake, run: str) -> dict[str, int]:
    """Take in all pending deliveries; raises if any was rejected, after the others were kept."""
    counts, rejected = take_in(spark, lake, run)
    _tell(rejected)
    return counts


def _publish(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    what: str,
    run: str,
    source: str,
    keep_runs: int,
    version: int,
    seen: dict[str, dict[str, int]] | None = None,
) -> bool:
    """Make a run's tables the ones that are read; older runs go, but for the last `keep_runs`.

    What the writes have `seen` of each table is logged with it. False if others were published since `version`: they may come from a newer delivery.
    """

    def clash(book: Log, after: int, upto: int) -> bool:
        same = (F.col("dataset") == dataset) & (F.col("what") == what)
        return not book.rows(PUBLISHED, after, upto).where(same).isEmpty()

    row = spark.createDataFrame([(dataset, what, run, source, now())], PUBLISHED_SCHEMA)
    rows = {PUBLISHED: row}
    if seen:
        values = [(dataset, what, run, table, metric, n) for table, found in seen.items() for metric, n in found.items()]
        rows[METRICS] = spark.createDataFrame(values, METRICS_SCHEMA).coalesce(1)
    if not _committed(log(spark, lake), rows, version, clash):
        return False
    names = folders(spark, lake.runs(what, dataset))
    ordered = [f"run={r['run']}" for r in _published(spark, lake, dataset, what).orderBy(F.desc("commit")).toLocalIterator()]
    for name in names:
        if name in ordered[keep_runs:] and name not in ordered[:keep_runs]:
            remove(spark, f"{lake.runs(what, dataset)}/{name}")
    return True


def _published(spark: SparkSession, lake: Lake, dataset: str, what: str) -> DataFrame:
    rows = log(spark, lake).rows(PUBLISHED)
    return rows.where((F.col("dataset") == dataset) & (F.col("what") == what))


def _last_published(spark: SparkSession, lake: Lake, dataset: str, what: str) -> Row | None:
    return _published(spark, lake, dataset, what).orderBy(F.desc("commit")).first()


def load_typed(spark: SparkSession, lake: Lake, dataset: str, run: str | None = None, keep_runs: int = KEEP_RUNS) -> int:
    """Newest delivery to typed registry, in a folder of the run, then published."""
    run = run or new_run()
    while True:
        version = log(spark, lake).version()
        source = newest(spark, lake, dataset)["run"]
        registry = typed(current(spark, lake, dataset))
        seen = write_observed(registry, lake.typed(dataset, run), quality.null_metrics())
        if _publish(spark, lake, dataset, TYPED, run, source, keep_runs, version, {TYPED: seen}):
            return seen["rows"]


def read_typed(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """The typed registry of the last published run."""
    row = _last_published(spark, lake, dataset, TYPED)
    if row is None:
        raise LookupError(f"no typed registry of {dataset}")
    return read_table(spark, lake.typed(dataset, row["run"]), TYPED_SCHEMA)


def build_star(spark: SparkSession, lake: Lake, dataset: str, run: str, keep_runs: int = KEEP_RUNS) -> dict[str, int]:
    """Typed registry to the star tables, in a folder of their own, published together.

    Readers follow the last published run, so they never see tables of two runs. Beside the
    location dimension goes its narrow form of one row per key, which the cards read.
    """
    while True:
        version = log(spark, lake).version()
        registry = read_typed(spark, lake, dataset)
        source = _last_published(spark, lake, dataset, TYPED)["source"]
        tables = star.star(registry)

        def write(name: str, tables: dict[str, DataFrame] = tables) -> dict[str, int]:
            return write_observed(tables[name], lake.star(dataset, run, name), {})

        seen = dict(zip(tables, side_by_side(write, tables), strict=True))
        locations = read_table(spark, lake.star(dataset, run, DIM_LOCATION), STAR_SCHEMAS[DIM_LOCATION])
        seen[ONE_LOCATION] = write_observed(star.unique_locations(locations), lake.star(dataset, run, ONE_LOCATION), {})
        if _publish(spark, lake, dataset, STAR, run, source, keep_runs, version, seen):
            return {name: seen[name]["rows"] for name in tables}


def read_star(spark: SparkSession, lake: Lake, dataset: str) -> dict[str, DataFrame]:
    """The star tables of the last published run."""
    row = _last_published(spark, lake, dataset, STAR)
    if row is None:
        raise LookupError(f"no star published for {dataset}")
    return {
        name: read_table(spark, lake.star(dataset, row["run"], name), schema)
        for name, schema in STAR_SCHEMAS.items()
    }


def read_one_location(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """The location dimension with unique keys, of the last published run."""
    row = _last_published(spark, lake, dataset, STAR)
    if row is None:
        raise LookupError(f"no star published for {dataset}")
    return read_table(spark, lake.star(dataset, row["run"], ONE_LOCATION), LOCATION_SCHEMA)


def metrics(spark: SparkSession, lake: Lake, dataset: str) -> dict[tuple[str, str], int]:
    """What the writes of the published typed table and star have counted, by table and metric."""
    rows = log(spark, lake).rows(METRICS).where(F.col("dataset") == dataset)
    runs = {what: _last_published(spark, lake, dataset, what) for what in (TYPED, STAR)}
    if None in runs.values():
        raise LookupError(f"no typed registry and star of {dataset}")
    return {(r["table"], r["metric"]): r["value"] for r in rows.toLocalIterator() if runs[r["what"]]["run"] == r["run"]}


def recorded_counts(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """One row per stage with its row count, as the writes have counted them: no table is read."""
    seen = metrics(spark, lake, dataset)
    counts = {"clean": newest(spark, lake, dataset)["rows"], **{name: seen[name, "rows"] for name in (TYPED, *STAR_SCHEMAS)}}
    return spark.createDataFrame(list(counts.items()), "etapa string, registros long")


def recorded_null_profile(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """How many rows have a date, an area and a species, as the write has counted them."""
    seen = metrics(spark, lake, dataset)
    names = {"registros": "rows", **{name: name for name in quality.NULL_METRICS}}
    schema = ", ".join(f"{name} long" for name in names)
    return spark.createDataFrame([tuple(seen[TYPED, metric] for metric in names.values())], schema)


def checks(spark: SparkSession, lake: Lake, dataset: str) -> dict[str, DataFrame]:
    """What to look at after a load: row counts, values that did not parse, keys that do not fit,
    ragged rows and rejected deliveries.

    Counts come from the log. Keys are looked for only where the counts leave room for such: as many rows as
    unique keys are no duplicates, and a delivery without ragged rows is not read. So a table is read once at most.
    """
    seen = metrics(spark, lake, dataset)
    tables = read_star(spark, lake, dataset)
    fact, locations = tables[FACT_AREA], tables[DIM_LOCATION]
    unique = read_one_location(spark, lake, dataset)
    no_duplicates = seen[DIM_LOCATION, "rows"] == seen[ONE_LOCATION, "rows"]
    no_ragged = newest(spark, lake, dataset)["ragged"] == 0
    duplicates, ragged = quality.duplicate_keys(locations), current_ragged(spark, lake, dataset)
    return {
        "counts": recorded_counts(spark, lake, dataset),
        "null_profile": recorded_null_profile(spark, lake, dataset),
        "duplicate_keys": spark.createDataFrame([], duplicates.schema) if no_duplicates else duplicates,
        "orphan_keys": quality.orphan_keys(fact, unique),
        "deliveries": kept_rows.kept(snapshots(spark, lake, dataset)).select(SNAPSHOT, "rows", "ragged", "delivery"),
        "ragged_rows": spark.createDataFrame([], ragged.schema) if no_ragged else ragged,
        "rejected": rejections(spark, lake),
    }


def export_registry(spark: SparkSession, lake: Lake, dataset: str, database: Database, num_partitions: int) -> None:
    """The typed registry as a database table named after the dataset."""
    export_table(read_typed(spark, lake, dataset), database, dataset, num_partitions)


def export_star(spark: SparkSession, lake: Lake, dataset: str, database: Database, num_partitions: int) -> None:
    """The published star tables as database tables."""
    for name, df in read_star(spark, lake, dataset).items():
        export_table(df, database, name, num_partitions)


def _outdated(spark: SparkSession, lake: Lake) -> list[str]:
    """Datasets whose published star is not made from their newest delivery."""
    days = kept_rows.kept(snapshots(spark, lake)).groupBy("dataset").agg(F.max_by("run", SNAPSHOT).alias("run"))
    out = []
    for row in days.orderBy("dataset").toLocalIterator():
        star_row = _last_published(spark, lake, row["dataset"], STAR)
        if star_row is None or star_row["source"] != row["run"]:
            out.append(row["dataset"])
    return out


def run_all(
    spark: SparkSession, lake: Lake, run: str | None = None, keep_runs: int = KEEP_RUNS, moves_done: bool = False
) -> dict[str, dict[str, int]]:
    """Convert, load and build, in that order; row counts per dataset whose newest delivery changed.

    Without a new delivery nothing is written to any of the tables. What an earlier run did
    not get to is done now. With `moves_done` kept deliveries end in the processed state.
    """
    run = run or new_run()
    counts, rejected = take_in(spark, lake, run)
    report = {}
    for dataset in _outdated(spark, lake):
        rows = counts.get(dataset)
        report[dataset] = {
            "clean": newest(spark, lake, dataset)["rows"] if rows is None else rows,
            "typed": load_typed(spark, lake, dataset, run, keep_runs),
            **build_star(spark, lake, dataset, run, keep_runs),
        }
    if moves_done:
        move_done(spark, lake)
    _tell(rejected)
    return report
