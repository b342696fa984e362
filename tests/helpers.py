"""Small hand-made registries."""

from grovemart.schema import RAW_SCHEMA, TYPED_SCHEMA

PLACES = {
    "1": ("Norte", "Pará", "PA", "m1", "Belém", "Belém - PA", "1", "Ananindeua", "Ananindeua - PA"),
    "2": ("Norte", "Pará", "PA", "m1", "Belém", "Belém - PA", "2", "Marituba", "Marituba - PA"),
    "3": ("Sul", "Paraná", "PR", "m9", "Lapa", "Lapa - PR", "3", "São João; do \"Sul\"", "Lapa"),
    None: (None,) * 9,
}


def raw_row(day, city, species, area):
    """A raw row of a known city, all text."""
    return (day, None if day is None else day[-4:], *PLACES[city], species, area)


def raw_frame(spark, rows):
    return spark.createDataFrame([raw_row(*row) for row in rows], RAW_SCHEMA)


def typed_frame(spark, rows):
    """Rows of (date, city, species, area) as a typed registry."""
    full = [
        (day, None if day is None else str(day.year), *PLACES[city], species, area)
        for day, city, species, area in rows
    ]
    return spark.createDataFrame(full, TYPED_SCHEMA)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
