"""Retention: which copy is to be deleted when."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beamwright import fixed, schemas
from beamwright.functions import paths


def rule_table(spark: SparkSession, rules: list = fixed.RETENTION_RULES) -> DataFrame:
    return spark.createDataFrame(rules, schemas.RULES)


def scheduled_only(rows: DataFrame) -> DataFrame:
    """Rows that name a path; a missing path means the step did not run."""
    return rows.filter(F.col("path").isNotNull() & (F.col("path") != ""))


def retention_schedule(
    files: DataFrame, *flows: str, settings: dict = fixed.RETENTION_DAYS,
    rules: list = fixed.RETENTION_RULES, one_minute: bool = False,
) -> DataFrame:
    """Due deletions of some flows for ``files(path_kind, path, created_at)``.

    The rules of all flows are united first, so the files are read and joined
    once.  They are a short literal list, so the rule side of the join
    has a fixed size and is broadcast.
    """
    spark = files.sparkSession
    mine = [r for r in rules if r[0] in flows]
    delays = [(k, 60 if one_minute else d * 86400) for k, d in settings.items()]
    delay = spark.createDataFrame(delays, "delay_key string, delay_s bigint")
    table = rule_table(spark, mine).join(F.broadcast(delay), "delay_key")
    due = F.timestamp_micros(F.unix_micros("created_at") + F.col("delay_s") * 1000000)
    return (
        scheduled_only(files)
        .join(F.broadcast(table), "path_kind")
        .withColumn("due_at", due)
        .withColumn("run_name", paths.prune_run_name(F.col("location"), F.col("path")))
        .withColumn("run_key", paths.prune_key(F.col("location")))
        .drop("delay_s")
    )


def union_schedules(*schedules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, schedules)


def due_now(schedule: DataFrame, now) -> DataFrame:
    return schedule.filter(F.col("due_at") <= now)
