"""Typed registry and star kept up to date by what changed between two deliveries.

Rows lie by period (a month, say) of their date, and every period has marks: its number of rows and two sums of
row hashes, which do not depend on the order of rows. The marks of a new delivery are taken in one pass and
compared with those of the last build. Only periods whose marks differ are written; the others stay in
the folders they are in, and the period table of a run tells which folder that is. Dimensions are kept
as members with the number of their rows: the rows of changed periods are taken off as they were and
added as they are, and a member without rows is gone. The calendar spans the periods' first and last days.

A run is published by one commit, as all others are, and read as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovemart.operators import star
from grovemart.operators.cleaning import typed
from grovemart.plans import jobs
from grovemart.schema import (
    DIM_CALENDAR,
    DIM_LOCATION,
    DIM_SPECIES,
    FACT_AREA,
    FACT_COLUMNS,
    LOCATION_COLUMNS,
    LOCATION_SCHEMA,
    ONE_LOCATION,
    SPECIES_KEY,
    STAR_SCHEMAS,
    TYPED_SCHEMA,
)
from grovemart.sources.files import entries, literal, remove
from grovemart.sources.tables import read_table, replace_table

INCREMENT = "increment"
PERIODS = "periods"
PERIOD = "periodo"
#: The period of rows without a date.
NO_PERIOD = "none"
MARKS = ["rows", "sum", "mixed"]
PERIODS_SCHEMA = T.StructType(
    [
        T.StructField(PERIOD, T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("sum", T.DecimalType(38, 0)),
        T.StructField("mixed", T.LongType()),
        T.StructField("first_day", T.DateType()),
        T.StructField("last_day", T.DateType()),
    ]
)
MEMBERS = {DIM_LOCATION: LOCATION_COLUMNS, DIM_SPECIES: [SPECIES_KEY]}
BY_PERIOD = {jobs.TYPED: TYPED_SCHEMA, FACT_AREA: STAR_SCHEMAS[FACT_AREA]}


def _path(lake: jobs.Lake, dataset: str, table: str, run: str | None = None) -> str:
    return f"{lake.runs(INCREMENT, dataset)}/{table}" + (f"/run={run}" if run else "")


def by_period(registry: DataFrame, unit: str) -> DataFrame:
    """The typed registry with the first day of each row's period."""
    first = F.date_format(F.date_trunc(unit, "data_base"), "yyyy-MM-dd")
    return registry.withColumn(PERIOD, F.coalesce(first, F.lit(NO_PERIOD)))


def marks(rows: DataFrame) -> DataFrame:
    """What tells one content of a period from another, whatever the order of its rows."""
    columns = TYPED_SCHEMA.fieldNames()
    return rows.groupBy(PERIOD).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit("mixed"), *columns)).alias("mixed"),
        F.min("data_base").alias("first_day"),
        F.max("data_base").alias("last_day"),
    )


def _placed(now: DataFrame, before: DataFrame, run: str) -> DataFrame:
    """The periods of a delivery with the run whose folder holds their rows: the old one where nothing changed."""
    old = before.select(PERIOD, F.col("run").alias("_run"), *[F.col(name).alias(f"_{name}") for name in MARKS])
    same = reduce(lambda a, b: a & b, [F.col(name) == F.col(f"_{name}") for name in MARKS])
    placed = now.join(old, PERIOD, "left").withColumn("run", F.when(same, F.col("_run")).otherwise(F.lit(run)))
    return placed.select(*PERIODS_SCHEMA.fieldNames())


def _rows(spark: SparkSession, lake: jobs.Lake, dataset: str, table: str, places: DataFrame) -> DataFrame:
    """Rows of a table by period, with the period; of some places (period and run), whose folders alone are listed
    and read. There are as many as there are periods in the calendar, whatever the number of rows."""
    root = _path(lake, dataset, table)
    folders = [f"{root}/run={r['run']}/{PERIOD}={r[PERIOD]}" for r in places.select("run", PERIOD).toLocalIterator()]
    schema = T.StructType([*BY_PERIOD[table].fields, T.StructField(PERIOD, T.StringType())])
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(*[literal(folder) for folder in folders])


def _write_by_period(rows: DataFrame, path: str) -> None:
    """A folder a period. Periods are gathered, large ones in several files."""
    rows.hint("rebalance", PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(path)


def _merged(before: DataFrame | None, gone: DataFrame | None, come: DataFrame, columns: list[str]) -> DataFrame:
    """Members with the number of their rows, after some rows went and others came."""
    parts = [come.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))]
    if gone is not None:
        parts.append(gone.groupBy(*columns).agg((-F.count(F.lit(1))).alias("n")))
    if before is not None:
        parts.append(before.select(*columns, "n"))
    return reduce(DataFrame.union, parts).groupBy(*columns).agg(F.sum("n").alias("n")).where("n > 0")


def _members_schema(table: str) -> T.StructType:
    return T.StructType([*STAR_SCHEMAS[table].fields, T.StructField("n", T.LongType())])


def update(
    spark: SparkSession, lake: jobs.Lake, dataset: str, run: str | None = None, unit: str = "month", keep_runs: int = jobs.KEEP_RUNS
) -> dict[str, int]:
    """Bring typed registry and star to the newest delivery; the number of periods there are and of those written.

    The first run, and one with another `unit`, writes all periods.
    """
    run = run or jobs.new_run()
    while True:
        version = jobs.log(spark, lake).version()
        source = jobs.newest(spark, lake, dataset)["run"]
        last = jobs._last_published(spark, lake, dataset, INCREMENT)
        fresh = by_period(typed(jobs.current(spark, lake, dataset)), unit)
        before = spark.createDataFrame([], PERIODS_SCHEMA) if last is None else periods(spark, lake, dataset, last["run"])
        replace_table(_placed(marks(fresh), before, run), _path(lake, dataset, PERIODS, run))
        places = periods(spark, lake, dataset, run)
        changed = places.where(F.col("run") == run)
        replaced = before.join(places, [PERIOD, "run"], "left_anti")

        _write_by_period(fresh.join(changed.select(PERIOD), PERIOD, "left_semi"), _path(lake, dataset, jobs.TYPED, run))
        come = _rows(spark, lake, dataset, jobs.TYPED, changed)
        come.select(*FACT_COLUMNS, PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(_path(lake, dataset, FACT_AREA, run))
        for table, columns in MEMBERS.items():
            gone = old = None
            if last is not None:
                gone = _rows(spark, lake, dataset, jobs.TYPED, replaced)
                old = read_table(spark, _path(lake, dataset, table, last["run"]), _members_schema(table))
            replace_table(_merged(old, gone, come, columns), _path(lake, dataset, table, run))
        locations = read_table(spark, _path(lake, dataset, DIM_LOCATION, run), STAR_SCHEMAS[DIM_LOCATION])
        replace_table(star.unique_locations(locations), _path(lake, dataset, ONE_LOCATION, run))
        bounds = places.agg(F.min("first_day").alias("data_inicial"), F.max("last_day").alias("data_final"))
        replace_table(star.calendar(bounds), _path(lake, dataset, DIM_CALENDAR, run))
        if jobs._publish(spark, lake, dataset, INCREMENT, run, source, keep_runs, version):
            break
    _forget(spark, lake, dataset, keep_runs)
    return {"periods": places.count(), "written": changed.count()}


def periods(spark: SparkSession, lake: jobs.Lake, dataset: str, run: str) -> DataFrame:
    """The periods of a run's registry, with the run that wrote them."""
    return read_table(spark, _path(lake, dataset, PERIODS, run), PERIODS_SCHEMA)


def _published_run(spark: SparkSession, lake: jobs.Lake, dataset: str) -> str:
    row = jobs._last_published(spark, lake, dataset, INCREMENT)
    if row is None:
        raise LookupError(f"no increment of {dataset}")
    return row["run"]


def read_typed(spark: SparkSession, lake: jobs.Lake, dataset: str) -> DataFrame:
    """The typed registry of the last published run."""
    run = _published_run(spark, lake, dataset)
    return _rows(spark, lake, dataset, jobs.TYPED, periods(spark, lake, dataset, run)).select(*TYPED_SCHEMA.fieldNames())


def read_star(spark: SparkSession, lake: jobs.Lake, dataset: str) -> dict[str, DataFrame]:
    """The star tables, and the locations with unique keys, of the last published run."""
    run = _published_run(spark, lake, dataset)
    small = {**{name: STAR_SCHEMAS[name] for name in (DIM_LOCATION, DIM_CALENDAR, DIM_SPECIES)}, ONE_LOCATION: LOCATION_SCHEMA}
    tables = {name: read_table(spark, _path(lake, dataset, name, run), schema) for name, schema in small.items()}
    fact = _rows(spark, lake, dataset, FACT_AREA, periods(spark, lake, dataset, run))
    return {**tables, FACT_AREA: fact.select(*FACT_COLUMNS)}


def _forget(spark: SparkSession, lake: jobs.Lake, dataset: str, keep_runs: int) -> None:
    """Remove what published runs wrote and none of the last `keep_runs` reads; runs at work are left alone."""
    runs = [r["run"] for r in jobs._published(spark, lake, dataset, INCREMENT).orderBy(F.desc("commit")).select("run").toLocalIterator()]
    runs = list(dict.fromkeys(runs))
    read = {(r["run"], r[PERIOD]) for run in runs[:keep_runs] for r in periods(spark, lake, dataset, run).select("run", PERIOD).toLocalIterator()}
    gone = []
    for run in runs[keep_runs:]:
        for table in BY_PERIOD:
            folder = _path(lake, dataset, table, run)
            held = {e.name.partition("=")[2]: e.path for e in entries(spark, folder) if e.is_folder}
            kept = {period for period in held if (run, period) in read}
            gone += [folder] if not kept else [path for period, path in held.items() if period not in kept]
        gone += [_path(lake, dataset, table, run) for table in (PERIODS, ONE_LOCATION, DIM_CALENDAR, *MEMBERS)]
    jobs.side_by_side(lambda path: remove(spark, path), gone, jobs.CONCURRENT_PEEKS)
