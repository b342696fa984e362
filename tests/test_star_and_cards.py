import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from grovemart.operators import cards, quality, star
from grovemart.schema import (
    DIM_CALENDAR,
    DIM_LOCATION,
    DIM_SPECIES,
    FACT_AREA,
    LOCATION_COLUMNS,
)
from tests.helpers import PLACES, rows_of, typed_frame

ROWS = [
    (date(2013, 2, 1), "1", "Pinus", 10),
    (date(2013, 2, 1), "1", "Pinus", 10),
    (date(2013, 2, 4), "2", None, 7),
    (date(2014, 1, 1), "2", "", 5),
    (date(2014, 1, 1), "3", "Pinus", None),
    (date(2014, 1, 2), "3", None, 1),
]


@pytest.fixture(scope="module")
def tables(spark):
    return star.star(typed_frame(spark, ROWS))


def test_calendar_is_dense(spark, tables):
    calendar = tables[DIM_CALENDAR]
    assert calendar.count() == (date(2014, 1, 2) - date(2013, 2, 1)).days + 1
    assert calendar.select("data").distinct().count() == calendar.count()


def test_calendar_attributes(spark):
    registry = typed_frame(spark, [(date(2013, 5, 9), "1", "Pinus", 1)])
    assert rows_of(star.dim_calendar(registry)) == [
        (date(2013, 5, 9), "2013", "05", "09", "2013-05", "2013-2")
    ]


def test_no_dates_no_calendar(spark):
    assert star.dim_calendar(typed_frame(spark, [])).count() == 0
    assert star.dim_calendar(typed_frame(spark, [(None, "1", "Pinus", 1)])).count() == 0


def test_dimensions_keep_null_and_empty_apart(tables):
    assert rows_of(tables[DIM_SPECIES]) == sorted([("",), ("Pinus",), (None,)], key=repr)
    assert tables[DIM_LOCATION].columns == LOCATION_COLUMNS
    assert tables[DIM_LOCATION].count() == 3


def test_fact_keeps_every_row(tables):
    assert rows_of(tables[FACT_AREA]) == sorted(ROWS, key=repr)


def test_cards(tables):
    fact, cities = tables[FACT_AREA], star.unique_locations(tables[DIM_LOCATION])
    assert rows_of(cards.area_total(fact)) == [(33,)]
    assert rows_of(cards.area_by_year(fact, tables[DIM_CALENDAR])) == [("2013", 27), ("2014", 6)]
    assert rows_of(cards.area_by_state(fact, cities)) == [("PA", "Pará", 32), ("PR", "Paraná", 1)]
    assert rows_of(cards.area_by_region(fact, cities)) == [("Norte", 32), ("Sul", 1)]
    assert rows_of(cards.area_by_species(fact, tables[DIM_SPECIES])) == sorted(
        [(None, 8), ("", 5), ("Pinus", 20)], key=repr
    )
    assert [tuple(row) for row in cards.top_cities(fact, cities, 2).collect()] == [
        ("1", "Ananindeua", 20),
        ("2", "Marituba", 12),
    ]


def test_top_cities_ties_go_to_the_lower_code(spark):
    registry = typed_frame(spark, [(date(2013, 1, 1), c, "Pinus", a) for c, a in [("3", 5), ("2", 5), ("1", None)]])
    top = cards.top_cities(star.fact_area(registry), star.unique_locations(star.dim_location(registry)))
    assert [row["codigo_municipio"] for row in top.collect()] == ["2", "3", "1"]


def test_sums_exceed_int(spark):
    registry = typed_frame(spark, [(date(2013, 1, 1), "1", "Pinus", 2**31 - 1)] * 3)
    assert cards.area_total(star.fact_area(registry)).first()[0] == 3 * (2**31 - 1)


def test_a_renamed_city_is_not_counted_twice(spark):
    registry = typed_frame(spark, ROWS)
    renamed = registry.limit(1).replace({"Ananindeua": "Ananindeua (old)"}, subset=["municipio"])
    locations = star.dim_location(registry.unionByName(renamed))
    fact = star.fact_area(registry)
    cities = star.unique_locations(locations)
    assert rows_of(quality.duplicate_keys(locations)) == [("1", 2)]
    assert rows_of(cards.area_by_region(fact, cities)) == [("Norte", 32), ("Sul", 1)]
    assert cards.top_cities(fact, cities, 1).first()["municipio"] == "Ananindeua (old)"


def test_orphans(spark, tables):
    known = tables[DIM_LOCATION].where("codigo_municipio <> '2'")
    assert rows_of(quality.orphan_keys(tables[FACT_AREA], known)) == [("2", 2, 12)]
    lost = typed_frame(spark, [(date(2013, 1, 1), None, "Pinus", 4)])
    assert rows_of(quality.orphan_keys(star.fact_area(lost), known)) == [(None, 1, 4)]


def test_null_profile(spark):
    profile = quality.null_profile(typed_frame(spark, [*ROWS, (None, "1", "Pinus", 1)]))
    assert rows_of(profile) == [(7, 6, 6, 5)]


def test_count_report_and_preview(spark, tables):
    assert rows_of(quality.count_report(tables)) == sorted(
        [("dim_localizacao", 3), ("dim_tempo", 336), ("dim_especie", 3), ("fat_area", 6)], key=repr
    )
    first = quality.preview(tables[FACT_AREA], 2).collect()
    assert [row["data_base"] for row in first] == [date(2013, 2, 1)] * 2


def _by_hand(rows):
    """The six groupings in plain Python, inner joins dropping rows without day or city."""
    sums = defaultdict(lambda: None)

    def add(level, value, area):
        key = (level, value)
        sums[key] = sums[key] if area is None else (sums[key] or 0) + area

    for day, city, species, area in rows:
        add("total", None, area)
        add("especie_florestal", species, area)
        if day is not None:
            add("ano", str(day.year), area)
        if city is not None:
            place = dict(zip(LOCATION_COLUMNS, PLACES[city], strict=True))
            for level in ("regiao", "sigla_uf", "codigo_municipio"):
                add(level, place[level], area)
    return dict(sums)


@pytest.mark.parametrize("seed", range(4))
def test_grouping_sets_equal_a_plain_count(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([None, date(2013, 1, 1) + timedelta(days=rng.randrange(900))]),
            rng.choice(["1", "1", "1", "2", "3", None]),
            rng.choice(["Pinus", "Eucalipto", "", None]),
            rng.choice([None, rng.randrange(100)]),
        )
        for _ in range(300)
    ]
    tables = star.star(typed_frame(spark, rows))
    fact, calendar, cities = tables[FACT_AREA], tables[DIM_CALENDAR], star.unique_locations(tables[DIM_LOCATION])
    levels = ["ano", "regiao", "sigla_uf", "codigo_municipio", "especie_florestal"]
    found = {}
    for row in cards.area_grouping_sets(fact, calendar, cities).collect():
        level = next((name for name in levels if row[f"g_{name}"] == 0), "total")
        key = (level, None if level == "total" else row[level])
        assert key not in found
        assert all(row[name] is None for name in levels if name != level)
        found[key] = row["area_ha"]
    assert found == _by_hand(rows)

    def card(df, level):
        return {(level, row[0]): row["area_ha"] for row in df.collect()}

    separate = {("total", None): cards.area_total(fact).first()[0]}
    separate |= card(cards.area_by_year(fact, calendar), "ano")
    separate |= card(cards.area_by_region(fact, cities), "regiao")
    separate |= card(cards.area_by_state(fact, cities), "sigla_uf")
    separate |= card(cards.area_by_species(fact, tables[DIM_SPECIES]), "especie_florestal")
    separate |= {k: v for k, v in found.items() if k[0] == "codigo_municipio"}
    assert separate == found
