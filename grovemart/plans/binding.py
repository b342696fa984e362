"""The data contract played by the given test tables.

Line items are registry rows, customers are cities, nations are states. Gaps are planted
by rule on every 17th, 19th, 23rd and 29th key: no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovemart.schema import RAW_ENCODING, RAW_HEADERS, RAW_SEPARATOR
from grovemart.sources.delimited import compressed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as(columns: list[Column]) -> list[Column]:
    return [column.alias(header) for header, column in zip(RAW_HEADERS, columns, strict=True)]


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _date_and_place_columns() -> list[Column]:
    nation_code = F.col("n_nationkey").cast("string")
    city_code = F.col("c_custkey").cast("string")
    return [
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.date_format("o_orderdate", "yyyy"),
        F.col("r_name"),
        F.col("n_name"),
        F.concat(F.lit("N"), F.lpad(nation_code, 2, "0")),
        F.concat(nation_code, F.lit("-"), F.col("c_mktsegment")),
        F.col("c_mktsegment"),
        F.concat(F.col("c_mktsegment"), F.lit(" - "), F.col("n_name")),
        city_code,
        F.col("c_name"),
        F.concat(F.col("c_name"), F.lit(" - "), F.col("n_name")),
    ]


def _edge_date(day: Column) -> Column:
    """Day text, on every 31st key with a year that only a tolerant formatter takes."""
    key = F.col("l_orderkey") % 31
    return F.when(key == 1, "01/01/+99999").when(key == 2, "01/01/-0005").otherwise(day)


def _edge_area(area: Column) -> Column:
    """Area text, on every 31st key a bare fraction or a number before a line separator."""
    key = F.col("l_orderkey") % 31
    return (
        F.when(key == 3, ".5")
        .when(key == 4, F.concat(F.coalesce(area, F.lit("1")), F.lit("\u0085")))
        .when(key == 5, F.concat(F.coalesce(area, F.lit("1")), F.lit("\u2028")))
        .otherwise(area)
    )


def raw_registry(spark: SparkSession, sf_dir: str, edges: bool = False) -> DataFrame:
    """One raw row per line item: thirteen text columns under the raw headers.

    With `edges`, dates and areas that look nearly right are planted, too.
    """
    return _registry(spark, sf_dir, edges).drop("l_orderkey")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as lines of delimited text under the header line; some with fields too few or too many."""
    fields = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in RAW_HEADERS]
    key = F.col("l_orderkey") % 37
    line = (
        F.when(key == 1, F.concat_ws(RAW_SEPARATOR, *fields[:-2]))
        .when(key == 2, F.concat_ws(RAW_SEPARATOR, *fields, F.lit("surplus")))
        .otherwise(F.concat_ws(RAW_SEPARATOR, *fields))
    )
    return _registry(spark, sf_dir, False).select(line.alias(RAW_SEPARATOR.join(RAW_HEADERS)))


def write_lines(lines: DataFrame, path: str, compression: str | None = None) -> None:
    """Lines as they are, each file with the header line on top."""
    options = {"header": "true", "encoding": RAW_ENCODING, "sep": "\x01", "quote": "\x00", "escapeQuotes": "false"}
    lines.write.options(**options, **compressed(compression)).csv(path)


def _registry(spark: SparkSession, sf_dir: str, edges: bool) -> DataFrame:
    """The raw columns with the order key.

    Parts are joined to the narrow line items and the wide place columns to the orders,
    so the last and largest shuffle carries the long text on the smaller side only.
    """
    items = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    orders = table(spark, sf_dir, "orders").join(
        _places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    )
    quantity = F.col("l_quantity").cast("int").cast("string")
    species = F.when(F.col("l_partkey") % 29 != 0, F.col("p_type"))
    area = (
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(None))
        .when(F.col("l_orderkey") % 23 == 0, F.lit("-"))
        .when(F.col("l_orderkey") % 19 == 0, F.concat(quantity, F.lit(".7")))
        .otherwise(quantity)
    )
    day, *places = _date_and_place_columns()
    if edges:
        day, area = _edge_date(day), _edge_area(area)
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *_as([day, *places, species, area]), "l_orderkey"
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per order, in the same columns; the year of the order is when it arrives."""
    area = F.floor("o_totalprice").cast("string")
    return (
        table(spark, sf_dir, "orders")
        .join(_places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            *_as(_date_and_place_columns() + [F.col("o_orderpriority"), area]),
            F.year("o_orderdate").alias("delivery_year"),
        )
    )


def dirty_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with renamed cities, city codes the location dimension does not know, and without day or species."""
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    code = F.col("c_custkey").cast("string")
    unknown = F.col("l_orderkey") % 101 == 0
    renamed = (F.col("c_custkey") % 50 == 0) & (F.col("l_linenumber") == 7)
    return items.join(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")),
        F.col("l_orderkey") == F.col("o_orderkey"),
    ).select(
        F.when(unknown, F.concat(F.lit("X"), code)).otherwise(code).alias("codigo_municipio"),
        F.when(renamed, F.concat(F.col("c_name"), F.lit(" (old)")))
        .otherwise(F.col("c_name"))
        .alias("municipio"),
        F.col("l_quantity").cast("int").alias("area_ha"),
        F.when(F.col("l_orderkey") % 13 != 0, F.col("o_orderdate").cast("date")).alias("data_base"),
        F.when(F.col("l_linenumber") != 6, F.col("o_orderpriority")).alias("especie_florestal"),
    )


def dirty_locations(facts: DataFrame) -> DataFrame:
    """City codes and names, without the codes that stand for unknown cities."""
    known = ~F.col("codigo_municipio").startswith("X")
    return facts.where(known).select("codigo_municipio", "municipio").distinct()


def changed(raw: DataFrame) -> DataFrame:
    """The registry as a later delivery has it: rows of 1995 gone, areas of 1996 and city names of 1997 changed."""
    year = F.col("`Ano_PEVS`")
    gone = (year == "1995") & (F.col("`Região`") == "ASIA")
    return raw.where(~gone).withColumns(
        {
            "Área (ha)": F.when(year == "1996", "1").otherwise(F.col("`Área (ha)`")),
            "Município": F.when(year == "1997", F.concat("Município", F.lit(" (novo)"))).otherwise(F.col("Município")),
        }
    )


def extended(raw: DataFrame) -> DataFrame:
    """The registry with a source and a note of each row, which the contract does not know."""
    source = F.concat(F.lit("f"), F.substring("Código Município Completo", -1, 1)).alias("Fonte")
    columns = [F.col(f"`{name}`") for name in raw.columns]
    return raw.select(*columns[:5], source, *columns[5:], F.col("`Espécie florestal`").alias("Observação; `nova`"))
