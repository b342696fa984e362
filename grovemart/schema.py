"""Columns, types and names of every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data contract: raw header of each column and its clean name,
# separators, charset, formats, and the names of the star tables.
COLUMN_NAMES = {
    "Ano": "data_base",
    "Ano_PEVS": "ano_data_base",
    "Região": "regiao",
    "Nome UF": "nome_uf",
    "Sigla UF": "sigla_uf",
    "Código Microrregião": "codigo_microrregiao",
    "Nome Microrregião": "nome_microrregiao",
    "Microrregião Geográfica": "microrregiao",
    "Código Município Completo": "codigo_municipio",
    "Município": "municipio",
    "Município Geográfico": "municipio_geografico",
    "Espécie florestal": "especie_florestal",
    "Área (ha)": "area_ha",
}
RAW_HEADERS = list(COLUMN_NAMES)
CLEAN_COLUMNS = list(COLUMN_NAMES.values())

RAW_SEPARATOR = ";"
RAW_ENCODING = "iso-8859-1"
STAGE_SEPARATOR = ","
DATE_FORMAT = "dd/MM/yyyy"
MISSING_AREA = "0"

# Fixed values of the data contract: columns of the star schema.
LOCATION_KEY = "codigo_municipio"
LOCATION_COLUMNS = [
    "regiao",
    "nome_uf",
    "sigla_uf",
    "codigo_microrregiao",
    "nome_microrregiao",
    "microrregiao",
    "codigo_municipio",
    "municipio",
    "municipio_geografico",
]
SPECIES_KEY = "especie_florestal"
FACT_COLUMNS = ["data_base", "codigo_municipio", "especie_florestal", "area_ha"]
CALENDAR_FORMATS = {
    "ano": "yyyy",
    "mes": "MM",
    "dia": "dd",
    "ano_mes": "yyyy-MM",
    "trimestre": "yyyy-Q",
}

DIM_LOCATION = "dim_localizacao"
DIM_CALENDAR = "dim_tempo"
DIM_SPECIES = "dim_especie"
FACT_AREA = "fat_area"
# Not part of the star: the location dimension with unique keys and the columns the cards ask for.
ONE_LOCATION = "localizacao_unica"

# Landing area: year=YYYY/month=MM/day=DD/<state>/<dataset>.csv
STATE_DOWNLOADED = "downloaded"
STATE_PROCESSED = "processed"
FILE_SUFFIX = ".csv"

CORRUPT_RECORD = "_corrupt_record"
# Columns beyond the contract, by their header names.
EXTRA = "extra"
EXTRA_TYPE = T.MapType(T.StringType(), T.StringType())


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_SCHEMA = strings(RAW_HEADERS)
CLEAN_SCHEMA = strings(CLEAN_COLUMNS)
TYPED_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            {"data_base": T.DateType(), "area_ha": T.IntegerType()}.get(name, T.StringType()),
        )
        for name in CLEAN_COLUMNS
    ]
)
CALENDAR_SCHEMA = T.StructType(
    [T.StructField("data", T.DateType())] + strings(list(CALENDAR_FORMATS)).fields
)
LOCATION_SCHEMA = strings([LOCATION_KEY, "regiao", "nome_uf", "sigla_uf", "municipio"])
STAR_SCHEMAS = {
    DIM_LOCATION: strings(LOCATION_COLUMNS),
    DIM_CALENDAR: CALENDAR_SCHEMA,
    DIM_SPECIES: strings([SPECIES_KEY]),
    FACT_AREA: T.StructType([TYPED_SCHEMA[name] for name in FACT_COLUMNS]),
}
