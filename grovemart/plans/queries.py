"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovemart.operators import cards, cleaning, quality, star
from grovemart.plans import binding, increments, jobs, retention
from grovemart.plans.workspace import DATASET, Workspace
from grovemart.schema import (
    CLEAN_SCHEMA,
    DIM_CALENDAR,
    DIM_LOCATION,
    FACT_AREA,
    ONE_LOCATION,
    TYPED_SCHEMA,
)
from grovemart.session import run_dir
from grovemart.sources.delimited import first_lines, read_raw, read_stage, write_raw, write_stage
from grovemart.sources.history import SNAPSHOT
from grovemart.sources.tables import read_table, replace_table
from grovemart.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.raw_registry(spark, sf_dir)


def clean_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(binding.raw_registry(spark, sf_dir))


def typed_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.typed(clean_registry(spark, sf_dir))


def typed_edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that look nearly like dates and numbers."""
    return cleaning.typed(cleaning.clean(binding.raw_registry(spark, sf_dir, edges=True)))


def calendar_edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar does not stretch to years that are none."""
    return star.dim_calendar(typed_edge_rows(spark, sf_dir))


def fill_type_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A numeric fill skips a text column: the missing areas are still missing."""
    renamed = cleaning.rename_columns(binding.raw_registry(spark, sf_dir))
    return renamed.na.fill(0, ["area_ha"])


# Star tables


def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location(Workspace(spark, sf_dir).typed_registry())


def species_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_species(Workspace(spark, sf_dir).typed_registry())


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_bounds(Workspace(spark, sf_dir).typed_registry())


def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_calendar(Workspace(spark, sf_dir).typed_registry())


def area_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_area(Workspace(spark, sf_dir).typed_registry())


# Cards


def area_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.area_total(Workspace(spark, sf_dir).fact())


def area_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir)
    return cards.area_by_year(space.fact(), space.calendar())


def area_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir)
    return cards.area_by_state(space.fact(), space.cities())


def area_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir)
    return cards.area_by_region(space.fact(), space.cities())


def area_by_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir)
    return cards.area_by_species(space.fact(), space.species())


def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir)
    return cards.top_cities(space.fact(), space.cities())


def area_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir)
    return cards.area_grouping_sets(space.fact(), space.calendar(), space.cities())


def area_levels_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels of facts of which some have no day, no species or a city nobody knows."""
    space = Workspace(spark, sf_dir)
    facts, _ = space.dirty_star()
    return cards.area_grouping_sets(facts, space.calendar(), space.cities())


# Sources and sinks


def csv_raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with accents, quotes and separators inside values, written and read back."""
    path = run_dir(spark, "raw")
    micro, city = "Microrregião Geográfica", "Município Geográfico"
    tricky = binding.raw_registry(spark, sf_dir).withColumns(
        {
            micro: F.concat(F.lit('São "'), F.col(micro), F.lit('"; Açaí')),
            city: F.concat(F.col(city), F.lit("; \\ÁÉ, ção")),
        }
    )
    write_raw(tricky, path)
    return cleaning.clean(read_raw(spark, path))


def csv_stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "stage")
    write_stage(clean_registry(spark, sf_dir), path)
    return read_stage(spark, path)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "analytics")
    replace_table(clean_registry(spark, sf_dir), path)
    return cleaning.typed(read_table(spark, path, CLEAN_SCHEMA))


def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice holds the second content only."""
    path = run_dir(spark, "typed-replaced")
    registry = Workspace(spark, sf_dir).typed_registry()
    replace_table(registry.withColumn("area_ha", F.lit(-1)), path)
    replace_table(registry, path)
    return read_table(spark, path, TYPED_SCHEMA)


def sql_over_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the typed registry, grouped by Spark instead of by a database."""
    return spark.sql(
        """
        select sigla_uf, especie_florestal,
               min(data_base) as data_inicial, max(data_base) as data_final,
               count(*) as registros, sum(area_ha) as area_ha
        from {registry}
        group by sigla_uf, especie_florestal
        """,
        registry=Workspace(spark, sf_dir).typed_registry(),
    )


# Landing, history, stream


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries pending when all had landed, after converting them, and after one came again."""
    lake = Workspace(spark, sf_dir).yearly_lake()
    moments = [
        jobs.read_pending(spark, lake, run)
        .select(F.lit(run).alias("momento"), "dataset", SNAPSHOT, "state")
        .distinct()
        for run in ("landed", "converted", "delivered_again")
    ]
    return reduce(DataFrame.unionByName, moments)


def history_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Workspace(spark, sf_dir).yearly_lake()
    return _by_snapshot(jobs.history(spark, lake, DATASET))


def _by_snapshot(history: DataFrame) -> DataFrame:
    return cleaning.typed(history).groupBy(SNAPSHOT).agg(
        F.count(F.lit(1)).alias("registros"),
        F.min("data_base").alias("data_inicial"),
        F.max("data_base").alias("data_final"),
        F.sum("area_ha").alias("area_ha"),
    )


def newest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Workspace(spark, sf_dir).yearly_lake()
    day = jobs.newest(spark, lake, DATASET)[SNAPSHOT]
    return jobs.current(spark, lake, DATASET).withColumn(SNAPSHOT, F.lit(day))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed years through the file stream; a second run finds nothing new."""
    lake = jobs.Lake(Workspace(spark, sf_dir).landed_years(), run_dir(spark, "stream"))
    for _ in range(2):
        ingest_available(spark, lake, f"{lake.root}/checkpoint")
    return jobs.history(spark, lake, DATASET)


def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream kept after a year of each of two datasets came again: their last contents."""
    lake = Workspace(spark, sf_dir).streamed_lake()
    of = [
        _by_snapshot(jobs.history(spark, lake, name)).withColumn("dataset", F.lit(name)) for name in (DATASET, "plain")
    ]
    return of[0].unionByName(of[1])


def redelivery_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bad delivery of a day that was kept before: the old rows stay, others come in, a rejection says why."""
    lake = Workspace(spark, sf_dir).rejecting_lake()
    of = [
        _by_snapshot(jobs.history(spark, lake, name)).withColumn("dataset", F.lit(name)) for name in (DATASET, "second")
    ]
    rejected = jobs.rejections(spark, lake).groupBy("dataset", SNAPSHOT).agg(F.count(F.lit(1)).alias("n"))
    known = of[0].unionByName(of[1]).join(rejected, ["dataset", SNAPSHOT], "left")
    return known.withColumn("rejeitadas", F.coalesce("n", F.lit(0)).cast("long")).drop("n")


def delivery_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different headers the files of each delivery have, from the scan of their first lines."""
    files = jobs.landed(spark, Workspace(spark, sf_dir).rejecting_lake()).select("path", "dataset", SNAPSHOT)
    lines = first_lines(spark, [row["path"] for row in files.toLocalIterator()])
    return files.join(lines, "path").groupBy("dataset", SNAPSHOT).agg(F.count_distinct("line").alias("cabecalhos"))


def open_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is listed of a landing area whose kept deliveries were moved: all of it, and the newest days."""
    space = Workspace(spark, sf_dir)
    looks = {"todos": space.moved_lake(), "janela": space.moved_lake(window=400)}
    seen = [
        jobs.landed(spark, lake).select(F.lit(name).alias("vista"), "dataset", SNAPSHOT, "state").distinct()
        for name, lake in looks.items()
    ]
    return seen[0].unionByName(seen[1])


def _with_log_rows(spark: SparkSession, lake: jobs.Lake) -> DataFrame:
    logged = jobs.snapshots(spark, lake, DATASET).groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("linhas"))
    return _by_snapshot(jobs.history(spark, lake, DATASET)).join(logged, SNAPSHOT, "left")


def compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by a log of a commit a year, with checkpoints; how many rows of the log speak of a day."""
    return _with_log_rows(spark, Workspace(spark, sf_dir).moved_lake())


def contended_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after three jobs took the same files at once: every day is kept by one of them."""
    return _with_log_rows(spark, Workspace(spark, sf_dir).contended_lake())


def swept_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after a sweep: replaced days are gone from disk, and every kept one has one folder."""
    lake = Workspace(spark, sf_dir).swept_lake()
    folders = retention.history_folders(spark, lake).groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("pastas"))
    return _by_snapshot(jobs.history(spark, lake, DATASET)).join(folders, SNAPSHOT, "full")


def ragged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few or too many fields: counted, padded or cut, not dropped."""
    lake = Workspace(spark, sf_dir).ragged_lake()
    profile = quality.null_profile(cleaning.typed(jobs.current(spark, lake, DATASET)))
    ragged = jobs.current_ragged(spark, lake, DATASET).select(F.lit("irregulares").alias("medida"))
    counted = ragged.groupBy("medida").count().withColumnRenamed("count", "valor")
    logged = jobs.snapshots(spark, lake, DATASET).select(F.lit("irregulares no registro").alias("medida"), F.col("ragged").alias("valor"))
    names = profile.columns
    melted = profile.unpivot([], names, "medida", "valor")
    return melted.unionByName(counted).unionByName(logged)


def extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery with columns beyond the contract: they are kept beside the others and can be grouped by."""
    lake = Workspace(spark, sf_dir).extended_lake()
    rows = cleaning.typed(jobs.current(spark, lake, DATASET, extra=True))
    return rows.groupBy(F.col("extra")["Fonte"].alias("fonte")).agg(
        F.count(F.lit(1)).alias("registros"),
        F.count(F.col("extra")["Observação; `nova`"]).alias("observacoes"),
        F.sum("area_ha").alias("area_ha"),
    )


def delivered_star_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one landed CSV delivery through all jobs to the cards."""
    lake = Workspace(spark, sf_dir).delivered_lake()
    tables = jobs.read_star(spark, lake, DATASET)
    cities = jobs.read_one_location(spark, lake, DATASET)
    return cards.area_grouping_sets(tables[FACT_AREA], tables[DIM_CALENDAR], cities)


def incremental_star_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels of a star that was brought from one delivery to the next by what changed."""
    tables = increments.read_star(spark, Workspace(spark, sf_dir).incremented_lake(), DATASET)
    return cards.area_grouping_sets(tables[FACT_AREA], tables[DIM_CALENDAR], tables[ONE_LOCATION])


def incremental_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.read_typed(spark, Workspace(spark, sf_dir).incremented_lake(), DATASET)


def incremental_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.read_star(spark, Workspace(spark, sf_dir).incremented_lake(), DATASET)[DIM_LOCATION]


def incremental_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which run wrote the rows of each month: the second one those that differ, and no others."""
    lake = Workspace(spark, sf_dir).incremented_lake()
    return increments.periods(spark, lake, DATASET, "second").select(increments.PERIOD, F.col("run").alias("corrida"), F.col("rows").alias("registros"))


# Checks


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Workspace(spark, sf_dir).delivered_lake()
    return quality.count_report(
        {
            "clean": jobs.current(spark, lake, DATASET),
            "typed": jobs.read_typed(spark, lake, DATASET),
            **jobs.read_star(spark, lake, DATASET),
        }
    )


def recorded_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and null profile as the writes have seen them, without reading a table."""
    lake = Workspace(spark, sf_dir).delivered_lake()
    counts = jobs.recorded_counts(spark, lake, DATASET)
    profile = jobs.recorded_null_profile(spark, lake, DATASET)
    return counts.union(profile.unpivot([], profile.columns, "etapa", "registros"))


def typed_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(Workspace(spark, sf_dir).typed_registry())


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.preview(Workspace(spark, sf_dir).typed_registry())


def location_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, locations = Workspace(spark, sf_dir).dirty_star()
    return quality.duplicate_keys(locations)


def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, locations = Workspace(spark, sf_dir).dirty_star()
    return quality.orphan_keys(facts, locations)


def area_despite_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area per city and chosen name: renamed cities are not counted twice."""
    facts, locations = Workspace(spark, sf_dir).dirty_star()
    sums = cards.area_per(facts, "codigo_municipio")
    return sums.join(star.one_row_per_key(locations), "codigo_municipio")


QUERIES: dict[str, Query] = {
    "area_by_year": area_by_year,
    "raw_registry": raw_registry,
    "clean_registry": clean_registry,
    "typed_registry": typed_registry,
    "typed_edge_rows": typed_edge_rows,
    "calendar_edge_rows": calendar_edge_rows,
    "fill_type_mismatch": fill_type_mismatch,
    "location_dim": location_dim,
    "species_dim": species_dim,
    "date_bounds": date_bounds,
    "calendar_dim": calendar_dim,
    "area_fact": area_fact,
    "area_total": area_total,
    "area_by_state": area_by_state,
    "area_by_region": area_by_region,
    "area_by_species": area_by_species,
    "top_cities": top_cities,
    "area_grouping_sets": area_grouping_sets,
    "area_levels_dirty": area_levels_dirty,
    "csv_raw_roundtrip": csv_raw_roundtrip,
    "csv_stage_roundtrip": csv_stage_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "table_replace": table_replace,
    "sql_over_registry": sql_over_registry,
    "pending_files": pending_files,
    "history_by_snapshot": history_by_snapshot,
    "latest_snapshot": newest_snapshot,
    "stream_ingest": stream_ingest,
    "stream_redelivery": stream_redelivery,
    "redelivery_rejected": redelivery_rejected,
    "delivery_headers": delivery_headers,
    "open_files": open_files,
    "compacted_history": compacted_history,
    "contended_history": contended_history,
    "swept_history": swept_history,
    "ragged_profile": ragged_profile,
    "extra_columns": extra_columns,
    "delivered_star_cards": delivered_star_cards,
    "incremental_star_cards": incremental_star_cards,
    "incremental_registry": incremental_registry,
    "incremental_locations": incremental_locations,
    "incremental_periods": incremental_periods,
    "stage_counts": stage_counts,
    "recorded_checks": recorded_checks,
    "typed_null_profile": typed_null_profile,
    "preview": preview,
    "location_key_duplicates": location_key_duplicates,
    "fact_orphans": fact_orphans,
    "area_despite_duplicates": area_despite_duplicates,
}

