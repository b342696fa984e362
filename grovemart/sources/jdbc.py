"""Database tables over JDBC: an export of the Parquet tables, and a way back in."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Database:
    """Where a database lives. Credentials are passed in, never kept in code."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        known = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {**self.properties, **{k: v for k, v in known.items() if v is not None}}


def range_options(
    column: str, lower: object, upper: object, num_partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options that split a table read into ranges of a number, date or timestamp column.

    The bounds only place the cuts: rows outside them, and NULLs, are still read.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
    }


def write_options(
    num_partitions: int, batch_size: int = 10_000, keep_definition: bool = True
) -> dict[str, str]:
    """Options of a table replacement: how many connections, and whether to empty or drop it."""
    return {
        "truncate": str(keep_definition).lower(),
        "numPartitions": str(num_partitions),
        "batchsize": str(batch_size),
    }


def read_query(spark: SparkSession, database: Database, sql: str) -> DataFrame:
    """Result of SQL run by the database. It arrives in one partition: for small results only."""
    return spark.read.format("jdbc").options(**database.options()).option("query", sql).load()


def read_bounds(spark: SparkSession, database: Database, table: str, column: str) -> DataFrame:
    sql = f'select min("{column}") as "lower", max("{column}") as "upper" from {table}'
    return read_query(spark, database, sql)


def read_jdbc_table(
    spark: SparkSession,
    database: Database,
    table: str,
    column: str,
    num_partitions: int,
    bounds: tuple[object, object] | None = None,
) -> DataFrame:
    """A whole table, read by `num_partitions` tasks over ranges of `column`.

    Without `bounds` the database is asked for them; an empty table needs no ranges.
    """
    lower, upper = bounds or read_bounds(spark, database, table, column).first()
    reader = spark.read.format("jdbc").options(**database.options()).option("dbtable", table)
    if lower is not None:
        reader = reader.options(**range_options(column, lower, upper, num_partitions))
    return reader.load()


def range_predicates(column: str, cuts: Sequence[str]) -> list[str]:
    """Conditions of which every row meets exactly one: ranges between cuts (SQL literals, ascending), and NULL apart.

    Ranges by bounds put all NULLs into the first range; here they are a partition of their own.
    """
    name = f'"{column}"'
    edges = [f"{name} < {cuts[0]}"] if cuts else [f"{name} is not null"]
    edges += [f"{name} >= {low} and {name} < {high}" for low, high in zip(cuts, cuts[1:])]
    edges += [f"{name} >= {cuts[-1]}"] if cuts else []
    return [*edges, f"{name} is null"]


def hash_predicates(expression: str, parts: int, within: str | None = None) -> list[str]:
    """Conditions of which every row meets exactly one: remainders of a whole number that the database makes
    of a row (`mod("id", 97)`, `hashtext("code")`), and rows for which it is NULL.

    `within` cuts the rows of one condition further: those of a value that a third of all rows have, say.
    """
    start = f"{within} and " if within else ""
    rest = [f"{start}mod(abs({expression}), {parts}) = {i}" for i in range(parts)]
    return [*rest, f"{start}{expression} is null"]


def split_predicates(column: str, cuts: Sequence[str], heavy: Sequence[str], expression: str, parts: int) -> list[str]:
    """Ranges of a column, but for its `heavy` values (SQL literals) and NULLs, which are cut by a hash of the row."""
    name = f'"{column}"'
    *ranges, null = range_predicates(column, cuts)
    if heavy:
        ranges = [f"{one} and {name} not in ({', '.join(heavy)})" for one in ranges]
    return ranges + [p for one in [*(f"{name} = {value}" for value in heavy), null] for p in hash_predicates(expression, parts, one)]


def read_by_predicates(spark: SparkSession, database: Database, table: str, predicates: Sequence[str]) -> DataFrame:
    """A table, read by a task for every condition."""
    options = database.options()
    return spark.read.jdbc(options.pop("url"), table, predicates=list(predicates), properties=options)


class IncompleteExport(RuntimeError):
    """The staged rows are not as many as were written: the old table stays."""


def connect(spark: SparkSession, database: Database) -> JavaObject:
    """A connection of the driver, for a few statements."""
    jvm, options = spark._jvm, database.options()
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        if key not in ("url", "driver"):
            properties.setProperty(key, value)
    jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(options["driver"])
    return jvm.java.sql.DriverManager.getConnection(options["url"], properties)


def swap_statements(table: str, staging: str, there: bool, keep_definition: bool) -> list[str]:
    """What makes staged rows the table's, for one transaction: the rows are put into the table as it is
    defined, or the staged table takes its name."""
    if there and keep_definition:
        return [f"delete from {table}", f"insert into {table} select * from {staging}", f"drop table {staging}"]
    return [*([f"drop table {table}"] if there else []), f"alter table {staging} rename to {table.rpartition('.')[2]}"]


def _in_one_transaction(connection: JavaObject, statements: Sequence[str]) -> None:
    connection.setAutoCommit(False)
    try:
        for sql in statements:
            connection.createStatement().execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise


def _number(connection: JavaObject, sql: str) -> int:
    rows = connection.createStatement().executeQuery(sql)
    rows.next()
    return rows.getLong(1)


def _is_there(connection: JavaObject, table: str) -> bool:
    schema, _, name = table.rpartition(".")
    return connection.getMetaData().getTables(None, schema or None, name, None).next()


def export_table(
    df: DataFrame,
    database: Database,
    table: str,
    num_partitions: int = 8,
    batch_size: int = 10_000,
    keep_definition: bool = True,
    opened: Callable[[SparkSession, Database], JavaObject] = connect,
) -> int:
    """Replace the rows of a table, all or none; returns their number.

    Tasks write a staging table of this run's own. Only if it holds exactly the rows that were written, counted during
    the write, does it take the table's place, in one transaction. A failed or repeated task leaves the table as it was.
    """
    staging = f"{table}_{uuid.uuid4().hex[:12]}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format("jdbc").options(**database.options())
    options = write_options(num_partitions, batch_size, keep_definition=False)
    connection = None
    try:
        writer.options(**options).option("dbtable", staging).mode("errorifexists").save()
        connection = opened(df.sparkSession, database)
        found = _number(connection, f"select count(*) from {staging}")
        if found != seen.get["rows"]:
            raise IncompleteExport(f"{found} instead of {seen.get['rows']} rows of {table}")
        _in_one_transaction(connection, swap_statements(table, staging, _is_there(connection, table), keep_definition))
        return found
    except Exception:
        connection = connection or opened(df.sparkSession, database)
        if _is_there(connection, staging):
            _in_one_transaction(connection, [f"drop table {staging}"])
        raise
    finally:
        if connection is not None:
            connection.close()


def replace_jdbc_table(
    df: DataFrame,
    database: Database,
    table: str,
    num_partitions: int = 8,
    batch_size: int = 10_000,
    keep_definition: bool = True,
) -> None:
    """Replace the rows of a table. A failed task can leave part of them; run it again."""
    (
        df.write.format("jdbc")
        .options(**database.options())
        .options(**write_options(num_partitions, batch_size, keep_definition))
        .option("dbtable", table)
        .mode("overwrite")
        .save()
    )
