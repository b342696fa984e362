"""The dashboard's questions to the star schema.

Every card first sums the fact per join key. Map-side that leaves one row per key and
task, so a key holding a third of all facts costs no more than any other, and the join
sees one row per key instead of the facts. The sums arrive already partitioned by the
join key. Spark picks the join by the measured sizes; nothing is hinted.

`cities` is the location dimension with unique keys (`star.unique_locations`), which the star
job writes once: a city with several dimension rows counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovemart.schema import LOCATION_KEY, SPECIES_KEY


def _area() -> Column:
    return F.sum("area_ha").alias("area_ha")


def area_per(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(_area())


def area_total(fact: DataFrame) -> DataFrame:
    return fact.agg(_area())


def area_by_year(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    days = calendar.select(F.col("data").alias("data_base"), "ano")
    return area_per(area_per(fact, "data_base").join(days, "data_base"), "ano")


def area_by_state(fact: DataFrame, cities: DataFrame) -> DataFrame:
    states = cities.select(LOCATION_KEY, "sigla_uf", "nome_uf")
    return area_per(area_per(fact, LOCATION_KEY).join(states, LOCATION_KEY), "sigla_uf", "nome_uf")


def area_by_region(fact: DataFrame, cities: DataFrame) -> DataFrame:
    regions = cities.select(LOCATION_KEY, "regiao")
    return area_per(area_per(fact, LOCATION_KEY).join(regions, LOCATION_KEY), "regiao")


def area_by_species(fact: DataFrame, species: DataFrame) -> DataFrame:
    """Null-safe join: facts without a species keep their own row."""
    known = species.select(F.col(SPECIES_KEY).alias("known"))
    sums = area_per(fact, SPECIES_KEY)
    return sums.join(known, F.col(SPECIES_KEY).eqNullSafe(F.col("known"))).drop("known")


def top_cities(fact: DataFrame, cities: DataFrame, n: int = 10) -> DataFrame:
    """The n cities with most area; ties go to the lower code, unknown areas come last.

    Only the keys of the dimension decide who is in; names are looked up for the n winners,
    few enough for Spark to broadcast, so the names are scanned but not shuffled.
    """
    order = [F.desc_nulls_last("area_ha"), F.col(LOCATION_KEY)]
    winners = area_per(fact, LOCATION_KEY).join(cities.select(LOCATION_KEY), LOCATION_KEY).orderBy(*order).limit(n)
    return cities.join(winners, LOCATION_KEY).select(LOCATION_KEY, "municipio", "area_ha").orderBy(*order).limit(n)


LEVELS = ["ano", "regiao", "sigla_uf", LOCATION_KEY, SPECIES_KEY]


def _levels(sums: DataFrame, own: list[str], total: bool = False) -> DataFrame:
    """Areas by each of some columns, in the columns of all levels.

    The g_ columns are grouping bits: 0 where the column is part of the row's level, so a NULL
    species is no subtotal.
    """
    sets = [[name] for name in own] + ([[]] if total else [])
    rolled = sums.groupingSets(sets, *own).agg(
        _area(), *[F.grouping(name).cast("int").alias(f"g_{name}") for name in own]
    )
    values = [F.col(name) if name in own else F.lit(None).cast("string").alias(name) for name in LEVELS]
    bits = [F.col(f"g_{name}") if name in own else F.lit(1).alias(f"g_{name}") for name in LEVELS]
    return rolled.select(*values, "area_ha", *bits)


def area_grouping_sets(fact: DataFrame, calendar: DataFrame, cities: DataFrame) -> DataFrame:
    """Total, year, region, state, city and species areas. Each level equals its card.

    The facts are summed per day, per city and per species, two columns each; each of the
    sums meets its own dimension only, so facts without a day or city never come together.
    """
    days = calendar.select(F.col("data").alias("data_base"), "ano")
    places = cities.select(LOCATION_KEY, "regiao", "sigla_uf")
    by_day = area_per(fact, "data_base").join(days, "data_base")
    by_city = area_per(fact, LOCATION_KEY).join(places, LOCATION_KEY)
    by_species = area_per(fact, SPECIES_KEY)
    return (
        _levels(by_day, ["ano"])
        .unionByName(_levels(by_city, ["regiao", "sigla_uf", LOCATION_KEY]))
        .unionByName(_levels(by_species, [SPECIES_KEY], total=True))
    )
