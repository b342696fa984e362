"""Tables written once per session and shared by the registered queries.

The typed registry is the product of five joins and most queries read it, so it is
written to the shared folder once and read back column by column; so are the dimensions,
each when it is first asked for. The fact is a few columns of the registry and read from
there. A table is reused only while the source files are the same: their paths, times and
sizes are part of its key.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovemart.functions.paths import delivery_path
from grovemart.operators import star
from grovemart.operators.cleaning import clean, typed
from grovemart.plans import binding, increments, jobs, retention
from grovemart.schema import (
    DIM_CALENDAR,
    DIM_LOCATION,
    DIM_SPECIES,
    LOCATION_SCHEMA,
    ONE_LOCATION,
    RAW_HEADERS,
    RAW_SCHEMA,
    STAR_SCHEMAS,
    TYPED_SCHEMA,
)
from grovemart.session import run_dir, unsorted_writes
from grovemart.sources.delimited import RAW_OPTIONS, compressed, write_raw
from grovemart.sources.landing import land, land_file
from grovemart.sources.tables import list_paths, read_table, replace_table
from grovemart.streaming.ingest import ingest_available

SOURCES = ["region", "nation", "customer", "part", "orders", "lineitem"]
DATASET = "registry"
#: The whole registry is text of many repeated values: a tenth of the bytes are written.
COMPRESSION = "gzip"

_made: dict[tuple, str] = {}


class Workspace:
    """What the queries of one session share about one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.state = self._source_state()
        unsorted_writes(spark)

    def typed_registry(self) -> DataFrame:
        def make(path: str) -> None:
            replace_table(typed(clean(binding.raw_registry(self.spark, self.sf_dir))), path)

        return read_table(self.spark, self._once("typed", make), TYPED_SCHEMA)

    def fact(self) -> DataFrame:
        return star.fact_area(self.typed_registry())

    def locations(self) -> DataFrame:
        return self._dimension(DIM_LOCATION, star.dim_location)

    def cities(self) -> DataFrame:
        """The location dimension with unique keys."""

        def make(path: str) -> None:
            replace_table(star.unique_locations(self.locations()), path)

        return read_table(self.spark, self._once(ONE_LOCATION, make), LOCATION_SCHEMA)

    def calendar(self) -> DataFrame:
        return self._dimension(DIM_CALENDAR, star.dim_calendar)

    def species(self) -> DataFrame:
        return self._dimension(DIM_SPECIES, star.dim_species)

    def dirty_star(self) -> tuple[DataFrame, DataFrame]:
        """Facts and locations that do not fit together."""

        def make(path: str) -> None:
            replace_table(binding.dirty_facts(self.spark, self.sf_dir), path)

        facts = read_table(self.spark, self._once("dirty", make))
        return facts, binding.dirty_locations(facts)

    def landed_years(self) -> str:
        """Landing area with all orders: those of a year are delivered on its last day."""

        def make(path: str) -> None:
            orders = self._yearly_orders()
            years = [row[0] for row in orders.select("delivery_year").distinct().toLocalIterator()]
            jobs.side_by_side(lambda year: _land_year(orders, year, path), years)

        return self._once("landing", make)

    def yearly_lake(self) -> jobs.Lake:
        """All years converted, then the last one delivered and converted again.

        What was pending at each of the three moments stays in the lake's pending tables.
        """
        landing = self.landed_years()

        def make(path: str) -> None:
            lake = jobs.Lake(landing, path)
            jobs.convert(self.spark, lake, "landed")
            jobs.convert(self.spark, lake, "converted")
            orders = self._yearly_orders()
            _land_year(orders, orders.agg(F.max("delivery_year")).first()[0], landing)
            jobs.convert(self.spark, lake, "delivered_again")

        return jobs.Lake(landing, self._once("lake", make))

    def moved_lake(self, window: int | None = None) -> jobs.Lake:
        """Every year taken in by a run of its own and moved to the processed state; then the first and the last
        one delivered again. The log has a checkpoint every two commits."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables", window, log_every=2)

        def make(path: str) -> None:
            own, orders = lake(path), self._yearly_orders()
            years = [row[0] for row in orders.select("delivery_year").distinct().orderBy("delivery_year").toLocalIterator()]
            for year in years:
                _land_year(orders, year, own.landing)
                jobs.convert(self.spark, own, f"y{year}")
            jobs.move_done(self.spark, own)
            for year in (years[0], years[-1]):
                _land_year(orders, year, own.landing)

        return lake(self._once("moved", make))

    def swept_lake(self) -> jobs.Lake:
        """The lake of moved years, its first and last year taken in once more; then nothing unreachable is left."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables")

        def make(path: str) -> None:
            own, orders = lake(path), self._yearly_orders()
            years = [row[0] for row in orders.select("delivery_year").distinct().orderBy("delivery_year").toLocalIterator()]
            jobs.side_by_side(lambda year: _land_year(orders, year, own.landing), years)
            jobs.convert(self.spark, own, "first")
            for year in (years[0], years[-1]):
                _land_year(orders, year, own.landing)
            jobs.convert(self.spark, own, "second")
            retention.sweep(self.spark, own, timedelta(0))

        return lake(self._once("swept", make))

    def contended_lake(self) -> jobs.Lake:
        """All years, taken in by two conversions and a stream at the same time."""
        landing = self.landed_years()

        def make(path: str) -> None:
            lake = jobs.Lake(landing, path)
            work = [
                lambda: jobs.convert(self.spark, lake, "one"),
                lambda: jobs.convert(self.spark, lake, "two"),
                lambda: ingest_available(self.spark, lake, f"{path}/checkpoint", "stream"),
            ]
            jobs.side_by_side(lambda job: job(), work)

        return jobs.Lake(landing, self._once("contended", make))

    def rejecting_lake(self) -> jobs.Lake:
        """All years kept; then the last one again with parts of different headers, and another dataset."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables")

        def make(path: str) -> None:
            own = lake(path)
            orders = self._yearly_orders()
            years = [row[0] for row in orders.select("delivery_year").distinct().orderBy("delivery_year").toLocalIterator()]
            jobs.side_by_side(lambda year: _land_year(orders, year, own.landing), years)
            jobs.convert(self.spark, own, "good")
            day = date(years[-1], 12, 31)
            last = orders.where(F.col("delivery_year") == years[-1]).drop("delivery_year")
            turned = last.select(*[F.col(f"`{name}`") for name in reversed(last.columns)])
            _land_year(orders, years[-1], own.landing)
            turned.write.mode("append").options(**RAW_OPTIONS).csv(delivery_path(own.landing, day, DATASET))
            land(last, own.landing, day, "second")
            try:
                jobs.convert(self.spark, own, "mixed")
            except jobs.DeliveryRejected:
                return
            raise AssertionError("a delivery of two headers was taken in")

        return lake(self._once("rejecting", make))

    def ragged_lake(self) -> jobs.Lake:
        """The whole registry as one delivery of which some lines are ragged."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables", compression=COMPRESSION)

        def make(path: str) -> None:
            target = delivery_path(lake(path).landing, date(2022, 8, 16), DATASET)
            binding.write_lines(binding.raw_lines(self.spark, self.sf_dir), target, COMPRESSION)
            jobs.convert(self.spark, lake(path), "ragged")

        return lake(self._once("ragged", make))

    def extended_lake(self) -> jobs.Lake:
        """The whole registry with two columns beyond the contract, in the midst of the others."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables", extra_columns=True, compression=COMPRESSION)

        def make(path: str) -> None:
            target = delivery_path(lake(path).landing, date(2022, 8, 16), DATASET)
            raw = binding.extended(binding.raw_registry(self.spark, self.sf_dir))
            raw.write.options(**RAW_OPTIONS, **compressed(COMPRESSION)).csv(target)
            jobs.run_all(self.spark, lake(path))

        return lake(self._once("extended", make))

    def streamed_lake(self) -> jobs.Lake:
        """All years by the stream; then the last year came again, and so did the first one of another dataset."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables")

        def make(path: str) -> None:
            own, checkpoint = lake(path), f"{path}/checkpoint"
            orders = self._yearly_orders()
            years = [row[0] for row in orders.select("delivery_year").distinct().orderBy("delivery_year").toLocalIterator()]
            wrong = orders.withColumn(RAW_HEADERS[-1], F.lit("1"))
            jobs.side_by_side(lambda year: _land_year(orders, year, own.landing), years[:-1])
            _land_year(wrong, years[-1], own.landing)
            _bring_year(self.spark, wrong, years[0], own.landing, f"{path}/first")
            ingest_available(self.spark, own, checkpoint, "first")
            _land_year(orders, years[-1], own.landing)
            _bring_year(self.spark, orders, years[0], own.landing, f"{path}/second")
            ingest_available(self.spark, own, checkpoint, "second")

        return lake(self._once("streamed", make))

    def incremented_lake(self) -> jobs.Lake:
        """The whole registry, then once more with changes in three of its years; both times by increments.

        Both deliveries read the joined rows from one table."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables", compression=COMPRESSION)

        def joined(path: str) -> None:
            replace_table(binding.raw_registry(self.spark, self.sf_dir), path)

        def make(path: str) -> None:
            raw = read_table(self.spark, self._once("raw", joined), RAW_SCHEMA)
            for run, rows, day in (("first", raw, date(2022, 8, 16)), ("second", binding.changed(raw), date(2022, 8, 17))):
                land(rows, lake(path).landing, day, DATASET, COMPRESSION)
                jobs.convert(self.spark, lake(path), run)
                increments.update(self.spark, lake(path), DATASET, run)

        return lake(self._once("incremented", make))

    def delivered_lake(self) -> jobs.Lake:
        """The whole registry as one delivery, taken through all jobs."""

        def lake(path: str) -> jobs.Lake:
            return jobs.Lake(f"{path}/landing", f"{path}/tables", compression=COMPRESSION)

        def make(path: str) -> None:
            raw = binding.raw_registry(self.spark, self.sf_dir)
            land(raw, lake(path).landing, date(2022, 8, 16), DATASET, COMPRESSION)
            jobs.run_all(self.spark, lake(path))

        return lake(self._once("chain", make))

    def _dimension(self, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        def make(path: str) -> None:
            replace_table(build(self.typed_registry()), path)

        return read_table(self.spark, self._once(name, make), STAR_SCHEMAS[name])

    def _yearly_orders(self) -> DataFrame:
        def make(path: str) -> None:
            orders = binding.raw_orders(self.spark, self.sf_dir)
            orders.write.partitionBy("delivery_year").parquet(path)

        return read_table(self.spark, self._once("yearly", make))

    def _source_state(self) -> int:
        """One number for the source files, from their listing and not their content."""
        files = list_paths(self.spark, [f"{self.sf_dir}/{name}.parquet" for name in SOURCES])
        one = F.xxhash64("path", "modificationTime", "length")
        return files.agg(F.bit_xor(one)).first()[0]

    def _once(self, name: str, make: Callable[[str], None]) -> str:
        """Path of what `make` has written; written again if sources changed or it is gone."""
        key = (self.spark.conf.get("spark.app.id"), self.sf_dir, name, self.state)
        if key not in _made or not self._is_there(_made[key]):
            path = run_dir(self.spark, name)
            make(path)
            _made[key] = path
        return _made[key]

    def _is_there(self, path: str) -> bool:
        try:
            self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        except AnalysisException:
            return False
        return True


def _bring_year(spark: SparkSession, orders: DataFrame, year: int, landing: str, folder: str) -> None:
    """A year of another dataset, written elsewhere and moved to the landing area."""
    write_raw(orders.where(F.col("delivery_year") == year), folder)
    land_file(spark, folder, landing, date(year, 12, 31), "plain", move=True)


def _land_year(orders: DataFrame, year: int, landing: str) -> None:
    land(orders.where(F.col("delivery_year") == year), landing, date(year, 12, 31), DATASET)
