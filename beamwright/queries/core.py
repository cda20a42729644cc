"""Collects the registered queries and their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beamwright.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

NOW = "2001-08-01 00:00:00"


class Tables:
    """The given tables of one scale, timestamps in the session zone."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        tune(spark)

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        casts = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
        return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its check SQL."""

    def wrap(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


def stamp(col):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def six(col):
    """Six decimals, no negative zero."""
    return F.round(col, 6) + F.lit(0.0)


def now():
    return F.lit(NOW).cast("timestamp")
