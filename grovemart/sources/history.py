"""History of cleaned deliveries: every run writes its own folder, a log says which rows count.

Nothing is overwritten. A delivery becomes visible by its row in the log, after its rows are
there; what a broken run has written is never looked at. Of several rows for a day the last commit counts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from grovemart.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, CORRUPT_RECORD, EXTRA, EXTRA_TYPE, strings
from grovemart.sources.tables import read_table

SNAPSHOT = "snapshot_date"
KEYS = T.StructType([T.StructField("dataset", T.StringType()), T.StructField(SNAPSHOT, T.DateType())])
RUN_SCHEMA = T.StructType(
    CLEAN_SCHEMA.fields + strings([CORRUPT_RECORD]).fields + [T.StructField(EXTRA, EXTRA_TYPE)] + KEYS.fields
)
#: A kept delivery: its rows, how many of them were ragged, its path and time, its run.
LOG_SCHEMA = T.StructType(
    KEYS.fields
    + [
        T.StructField("rows", T.LongType()),
        T.StructField("ragged", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("delivery", T.StringType()),
        T.StructField("delivered_at", T.TimestampType()),
        T.StructField("kept_at", T.TimestampType()),
    ]
)


def run_path(root: str, run: str) -> str:
    return f"{root}/run={run}"


def write_run(df: DataFrame, root: str, run: str) -> None:
    """Rows of any number of deliveries (RUN_SCHEMA), a folder for each."""
    df.write.mode("overwrite").partitionBy(*KEYS.fieldNames()).parquet(run_path(root, run))


def read_run(spark: SparkSession, root: str, run: str) -> DataFrame:
    return read_table(spark, run_path(root, run), RUN_SCHEMA)


def kept(log: DataFrame) -> DataFrame:
    """The last log row of each dataset and day."""
    last = Window.partitionBy("dataset", SNAPSHOT).orderBy(F.desc("commit"), F.desc("run"))
    return log.withColumn("_last", F.row_number().over(last)).where("_last = 1").drop("_last")


def read_snapshot(spark: SparkSession, root: str, run: str, dataset: str, day: date, extra: bool = False) -> DataFrame:
    """The clean rows of one delivery, with its `extra` columns if asked for; only its folder is read."""
    rows = read_run(spark, root, run).where((F.col("dataset") == dataset) & (F.col(SNAPSHOT) == day))
    return rows.select(*CLEAN_COLUMNS, *([EXTRA] if extra else []))


def read_history(spark: SparkSession, root: str, log: DataFrame, extra: bool = False) -> DataFrame:
    """The clean rows of all kept deliveries of a log, with their days, and their `extra` columns if asked for.

    Which runs hold them is a join with the log, so only their folders are read.
    """
    named = T.StructType(RUN_SCHEMA.fields + [T.StructField("run", T.StringType())])
    rows = spark.read.schema(named).option("basePath", root).parquet(root)
    keys = ["dataset", SNAPSHOT, "run"]
    return rows.join(kept(log).select(*keys), keys).select(*CLEAN_COLUMNS, SNAPSHOT, *([EXTRA] if extra else []))
