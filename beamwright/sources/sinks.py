"""Sinks: partitioned Parquet tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.functions import values


def write_frames(frames: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Frames by scan and kind, sorted by projection and row for range pruning.

    A scan may hold most of all rows: ``maxRecordsPerFile`` keeps files even,
    and the row range in the shuffle key keeps the writing tasks even.
    """
    spread = frames.repartition("scan_id", "kind", F.floor(F.col("row") / 64))
    writer = spread.sortWithinPartitions("scan_id", "kind", "idx", "row").write.partitionBy("scan_id", "kind")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def write_catalogue(tables: dict, path: str) -> None:
    """Datasets, datablocks, attachments: one folder each, by ingest date.

    Rows of a date come together first, so a date gets few files; a date with very many rows is split between tasks.
    """
    for name, df in tables.items():
        df.hint("rebalance", F.col("ingest_date")).write.mode("append").partitionBy("ingest_date").parquet(f"{path}/{name}")


def named_stack(df: DataFrame, prefix: Column, position: str, start: int = 0, step: int = 1, suffix: str = "") -> DataFrame:
    """Output names ``<prefix>_<start + position·step, 5 digits><suffix>``."""
    number = (F.col(position) * step + start).cast("bigint")
    return df.withColumn("number", number).withColumn("file_name", values.output_name(prefix, F.col("number"), suffix))


def write_stack(df: DataFrame, path: str, prefix: Column, position: str, start: int = 0, step: int = 1, suffix: str = "") -> None:
    named_stack(df, prefix, position, start, step, suffix).write.partitionBy("scan_id").parquet(path)


def write_metrics(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def write_plan(plan: DataFrame, path: str) -> None:
    """Copy and prune plans, one row per (endpoint, path, action)."""
    unique = plan.dropDuplicates(["endpoint_key", "rel_path", "action"])
    unique.write.mode("append").partitionBy("action").parquet(path)


def write_pyramid(levels: DataFrame, scales: DataFrame, path: str) -> None:
    levels.write.partitionBy("scan_id", "level").parquet(f"{path}/levels")
    scales.write.parquet(f"{path}/scales")
