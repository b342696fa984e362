"""The jobs from the command line, for spark-submit: python -m grovemart <job> ..."""

from __future__ import annotations

import argparse
import json
import os
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from grovemart.operators import cards
from grovemart.operators.quality import preview
from grovemart.plans import increments, jobs
from grovemart.plans.retention import MIN_AGE, sweep
from grovemart.schema import DIM_CALENDAR, DIM_SPECIES, FACT_AREA
from grovemart.session import get_session
from grovemart.sources.jdbc import Database
from grovemart.sources.landing import land_file
from grovemart.streaming.ingest import ingest_available

JOBS = ["land", "convert", "stream", "move-done", "sweep", "typed", "star", "increment", "all", "preview", "checks", "cards", "export-registry", "export-star"]
PASSWORD_VARIABLE = "GROVEMART_DB_PASSWORD"


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="grovemart", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--landing", help="folder deliveries arrive in")
    parser.add_argument("--root", help="folder of all tables")
    parser.add_argument("--dataset", help="file name of the delivery, with or without .csv")
    parser.add_argument("--run", help="name of this run; default: the time")
    parser.add_argument("--source", help="land: file to deliver")
    parser.add_argument("--move", action="store_true", help="land: move the source, by a rename where that is possible")
    parser.add_argument("--window", type=int, help="days before the newest kept one that are still looked at; default: all")
    parser.add_argument("--extra-columns", action="store_true", help="keep deliveries with columns beyond the contract, and these")
    parser.add_argument("--move-done", action="store_true", help="all: move kept deliveries to the processed state at the end")
    parser.add_argument("--date", type=date.fromisoformat, help="land: delivery date, YYYY-MM-DD")
    parser.add_argument("--min-age", type=int, default=MIN_AGE.days, help="sweep: days that unreachable folders are kept")
    parser.add_argument("--unit", default="month", choices=["day", "month", "quarter", "year"], help="increment: period of a folder")
    parser.add_argument("--rows", type=int, default=5, help="preview: rows per table")
    parser.add_argument("--keep-runs", type=int, default=jobs.KEEP_RUNS, help="published runs whose tables are kept")
    parser.add_argument("--partitions", type=int, default=8, help="export: database connections")
    parser.add_argument("--url", help="export: JDBC URL")
    parser.add_argument("--driver", help="export: JDBC driver class")
    parser.add_argument("--user", help=f"export: user; the password is read from {PASSWORD_VARIABLE}")
    return parser.parse_args(arguments)


def dashboard(tables: dict[str, DataFrame], cities: DataFrame) -> dict[str, DataFrame]:
    fact = tables[FACT_AREA]
    return {
        "total": cards.area_total(fact),
        "year": cards.area_by_year(fact, tables[DIM_CALENDAR]).orderBy("ano"),
        "state": cards.area_by_state(fact, cities).orderBy("sigla_uf"),
        "top cities": cards.top_cities(fact, cities),
        "region": cards.area_by_region(fact, cities).orderBy("regiao"),
        "species": cards.area_by_species(fact, tables[DIM_SPECIES]).orderBy("especie_florestal"),
    }


def show(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        print(name)
        df.show(truncate=False)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = jobs.Lake(args.landing, args.root, args.window, extra_columns=args.extra_columns)
    dataset = (args.dataset or "").removesuffix(".csv")
    name = args.run or jobs.new_run()
    if args.job == "land":
        print(land_file(spark, args.source, args.landing, args.date, dataset, args.move))
    elif args.job == "convert":
        print(json.dumps(jobs.convert(spark, lake, name)))
    elif args.job == "stream":
        rejected = ingest_available(spark, lake, f"{lake.root}/checkpoint", name)
        print(json.dumps({"rejected": [[path, reason] for _, _, path, reason, _ in rejected]}))
    elif args.job == "move-done":
        print(json.dumps({"moved": jobs.move_done(spark, lake)}))
    elif args.job == "sweep":
        print(json.dumps(sweep(spark, lake, timedelta(days=args.min_age))))
    elif args.job == "typed":
        print(json.dumps({dataset: jobs.load_typed(spark, lake, dataset, name, args.keep_runs)}))
    elif args.job == "star":
        print(json.dumps(jobs.build_star(spark, lake, dataset, name, args.keep_runs)))
    elif args.job == "increment":
        print(json.dumps(increments.update(spark, lake, dataset, name, args.unit, args.keep_runs)))
    elif args.job == "all":
        print(json.dumps(jobs.run_all(spark, lake, name, args.keep_runs, args.move_done)))
    elif args.job == "preview":
        stages = {"clean": jobs.current(spark, lake, dataset), "typed": jobs.read_typed(spark, lake, dataset)}
        tables = {**stages, **jobs.read_star(spark, lake, dataset)}
        show({table: preview(df, args.rows) for table, df in tables.items()})
    elif args.job == "checks":
        show(jobs.checks(spark, lake, dataset))
    elif args.job == "cards":
        show(dashboard(jobs.read_star(spark, lake, dataset), jobs.read_one_location(spark, lake, dataset)))
    else:
        database = Database(args.url, args.driver, args.user, os.environ.get(PASSWORD_VARIABLE))
        export = jobs.export_registry if args.job == "export-registry" else jobs.export_star
        export(spark, lake, dataset, database, args.partitions)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    run(get_session(f"grovemart-{args.job}"), args)


if __name__ == "__main__":
    main()
