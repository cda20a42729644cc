"""Job logs: latest state, transitions, lost jobs, stage durations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.operators import segments

ORDER = ["ts", "event_id"]


def latest_block(events: DataFrame, columns: list) -> DataFrame:
    """The block written last per job: an aggregate, so no per-job sort."""
    return (
        events.groupBy("job_id")
        .agg(F.max_by(F.struct(*columns), F.struct(*ORDER)).alias("b"))
        .select("job_id", "b.*")
    )


def state_transitions(events: DataFrame, seconds: int = 3600) -> DataFrame:
    """Rows whose state differs from the row before (first rows included)."""
    segment = segments.time_segment(F.col("ts"), seconds)
    out = segments.with_previous(events, ["job_id"], ORDER, segment, "state", "previous")
    return out.filter(~F.col("state").eqNullSafe(F.col("previous")))


def retry_runs(events: DataFrame, max_retries: int = 5, seconds: int = 3600, state: str = "NOT_FOUND") -> DataFrame:
    """Every poll with its run of consecutive misses; over the limit is LOST."""
    segment = segments.time_segment(F.col("ts"), seconds)
    out = segments.with_run_length(events, ["job_id"], ORDER, segment, F.col("state") == state, "retries")
    return out.withColumn("verdict", F.when(F.col("retries") > max_retries, "LOST"))


def job_verdicts(events: DataFrame, max_retries: int = 5, seconds: int = 3600, terminal: list | None = None) -> DataFrame:
    """First decisive poll per job: SUCCESS, FAILURE, LOST, or RUNNING so far."""
    from beamwright import fixed

    terminal = terminal or fixed.TERMINAL_JOB_STATES
    runs = retry_runs(events, max_retries, seconds)
    call = (
        F.when(F.col("state") == "COMPLETED", "SUCCESS")
        .when(F.col("state").isin(terminal), "FAILURE")
        .when(F.col("verdict") == "LOST", "LOST")
    )
    order = F.when(F.col("call").isNotNull(), F.struct(*ORDER))
    return (
        runs.withColumn("call", call).groupBy("job_id").agg(F.min_by(F.struct("call", "ts"), order).alias("f"))
        .select("job_id", F.coalesce("f.call", F.lit("RUNNING")).alias("outcome"), F.col("f.ts").alias("decided_at"))
    )


def stage_durations(events: DataFrame, by: list) -> DataFrame:
    seconds = (F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / 1000000
    return events.groupBy(*by).agg(seconds.alias("seconds"), F.count(F.lit(1)).alias("events"))
