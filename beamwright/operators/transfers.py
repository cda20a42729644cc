"""Transfer telemetry."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.functions import paths, values
from beamwright.operators import segments


def resolve_route(transfers: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Absolute source and destination paths and the destination's name.

    The registry is joined by key twice; whether it is small enough to
    broadcast is left to the size estimate Spark has of it.
    """
    src = endpoints.select(F.col("endpoint_key").alias("src_key"), F.col("root_path").alias("src_root"))
    dst = endpoints.select(
        F.col("endpoint_key").alias("dst_key"), F.col("root_path").alias("dst_root"), F.col("name").alias("machine")
    )
    return (
        transfers.join(src, "src_key", "left").join(dst, "dst_key", "left")
        .withColumn("local_path", paths.full_path(F.col("src_root"), F.col("rel_path")))
        .withColumn("remote_path", paths.full_path(F.col("dst_root"), F.col("rel_path")))
        .drop("src_root", "dst_root")
    )


def succeeded_info(transfers: DataFrame) -> DataFrame:
    """Task statistics for succeeded tasks only, missing numbers as zero."""

    def zero(c):
        return F.coalesce(c, F.lit(0)).alias(c)

    info = F.struct(zero("bytes"), zero("bytes_checksummed"), zero("files"), zero("eff_bps"))
    return transfers.withColumn("info", F.when(F.col("status") == "SUCCEEDED", info))


def duration_seconds(start="start_ts", end="end_ts"):
    return (F.unix_micros(end) - F.unix_micros(start)) / 1000000


def metric_gate(transfers: DataFrame, enabled: bool = True) -> DataFrame:
    return transfers.filter(F.lit(enabled) & (F.col("bytes") > 0))


def metric_records(routed: DataFrame) -> DataFrame:
    """One metric record per transfer that moved bytes."""
    begin, end = (F.unix_micros(c) / 1000000 for c in ("start_ts", "end_ts"))
    return metric_gate(routed).select(
        "task_id",
        values.iso_utc(begin).alias("timestamp"),
        values.iso_utc(end).alias("end_timestamp"),
        "local_path", "remote_path",
        F.col("bytes").alias("bytes_transferred"),
        duration_seconds().alias("duration_seconds"),
        F.col("eff_bps").alias("transfer_speed"),
        F.when(F.col("status") == "SUCCEEDED", "success").otherwise("failed").alias("status"),
        "machine", "end_ts",
    )


def machine_gauges(records: DataFrame) -> DataFrame:
    """The last values set per machine."""
    last = F.max_by(
        F.struct("bytes_transferred", "duration_seconds", "transfer_speed"), F.struct("end_ts", "task_id")
    )
    return records.groupBy("machine").agg(last.alias("g")).select("machine", "g.*")


def execution_totals(records: DataFrame) -> DataFrame:
    """Requests and bytes per machine, with the grand total under a null machine."""
    return records.rollup("machine").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("bytes_transferred").alias("total_bytes")
    )


def transfer_summary(transfers: DataFrame, by: list) -> DataFrame:
    """Volumes, speeds and outcome counts; speed is zero without bytes or time."""
    seconds = duration_seconds()
    return (
        transfers.withColumn("_s", seconds).groupBy(*by).agg(
            F.sum("bytes").alias("bytes"),
            F.sum("bytes_checksummed").alias("bytes_checksummed"),
            F.sum("files").alias("files"),
            F.avg("eff_bps").alias("mean_speed"),
            F.sum("_s").alias("seconds"),
            F.count_if(F.col("status") == "SUCCEEDED").alias("succeeded"),
            F.count_if(F.col("status") == "FAILED").alias("failed"),
        )
        .withColumn(
            "speed",
            F.when((F.col("bytes") > 0) & (F.col("seconds") > 0), F.col("bytes") / F.col("seconds")).otherwise(0.0),
        )
    )


def event_verdict(elapsed, max_wait: float = 600):
    """What one poll decides; null means keep waiting."""
    status, nice = F.col("status"), F.col("nice_status")
    return (
        F.when(status.isin(fixed.FINISHED_STATUS), "COMPLETED")
        .when(elapsed > max_wait, "TIMEOUT")
        .when(nice.isin(fixed.BAD_NICE_STATUS), "CANCELLED")
    )


def task_timeout(events: DataFrame, max_wait: float = 600, seconds: int = 3600) -> DataFrame:
    """Verdict of every task: the first poll that decides.

    A finished task counts as completed even when it failed; ``succeeded``
    tells the two apart.  A task with very many polls is spread over segments of
    time and reduced before its polls meet.
    """
    segment = segments.time_segment(F.col("ts"), seconds)
    events = segments.with_key_minimum(events, ["task_id"], segment, "ts", "first_ts")
    elapsed = (F.unix_micros("ts") - F.unix_micros("first_ts")) / 1000000
    judged = events.withColumn("elapsed", elapsed)
    judged = judged.withColumn("verdict", event_verdict(F.col("elapsed"), max_wait))
    order = F.when(F.col("verdict").isNotNull(), F.struct("ts", "event_id"))
    first = F.min_by(F.struct("verdict", "status", "elapsed"), order)
    return (
        judged.groupBy("task_id").agg(first.alias("f"), F.count(F.lit(1)).alias("polls"))
        .select(
            "task_id", "polls",
            F.coalesce("f.verdict", F.lit("WAITING")).alias("verdict"),
            F.coalesce(F.col("f.verdict") == "COMPLETED", F.lit(False)).alias("completed"),
            F.coalesce(F.col("f.status") == "SUCCEEDED", F.lit(False)).alias("succeeded"),
            F.col("f.elapsed").alias("elapsed"),
        )
    )
