"""Ordered computations that stay spread out when one key holds most rows.

A plain window sorts all rows of a key in one task.  Here each key is cut into
segments by a rule on the ordering column (a span of time, a span of numbers, a
text prefix).  The heavy window runs per (key, segment); only one summary row
per segment takes part in the per-key pass that links the segments.  The
result is the same as that of the plain window.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beamwright.session import materialise


def time_segment(ts: Column, seconds: int = 3600) -> Column:
    return F.floor(F.unix_micros(ts) / (seconds * 1000000))


def number_segment(n: Column, width: int = 4096) -> Column:
    return F.floor(n / width)


def prefix_segment(text: Column, length: int) -> Column:
    """Prefixes sort as the texts do."""
    return F.substring(text, 1, length)


def with_range_segment(df: DataFrame, keys: list, order: list, name: str = "_range") -> DataFrame:
    """Number the stretches of the whole table in the order of (keys, order).

    Spark samples the rows and takes splitters that cut the table into partitions of about equal size, whatever the values look
    like; rows that tie stay together. The numbers are written down, as a partition computed again may be cut elsewhere.
    """
    return materialise(df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id()), "ranges")


LINK = ["_key", "_seg"]


def _cut(df: DataFrame, keys: list, segment: Column) -> DataFrame:
    """Rows with their key and segment as structs.

    A struct is never null and equals another with the same nulls inside, so
    rows without a key or an order form a key or a (first) segment of their
    own, as in a plain window, and both uses of the rows below share one
    shuffle by (key, segment).
    """
    return df.withColumn("_key", F.struct(*keys)).withColumn("_seg", F.struct(segment.alias("at")))


def with_key_minimum(df: DataFrame, keys: list, segment: Column, value: str, name: str) -> DataFrame:
    """The least value of the row's key, without bringing a key's rows together."""
    df = _cut(df, keys, segment)
    every = Window.partitionBy("_key")
    lows = df.groupBy(*LINK).agg(F.min(value).alias("_low"))
    lows = lows.select(*LINK, F.min("_low").over(every).alias(name))
    return df.join(lows, LINK).drop(*LINK)


def with_row_number(df: DataFrame, keys: list, order: list, segment: Column, name: str) -> DataFrame:
    """1-based position of every row inside its key."""
    df = _cut(df, keys, segment)
    local = Window.partitionBy(*LINK).orderBy(*order)
    before = Window.partitionBy("_key").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*LINK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*LINK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        df.withColumn("_rn", F.row_number().over(local))
        .join(offsets, LINK)
        .withColumn(name, F.col("_rn") + F.col("_off"))
        .drop("_rn", "_off", *LINK)
    )


def with_previous(df: DataFrame, keys: list, order: list, segment: Column, value: str, name: str) -> DataFrame:
    """The value of the row before, across segment borders."""
    df = _cut(df, keys, segment)
    local = Window.partitionBy(*LINK).orderBy(*order)
    chain = Window.partitionBy("_key").orderBy("_seg")
    last = df.groupBy(*LINK).agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    carry = last.select(*LINK, F.lag("_last").over(chain)[value].alias("_carry"))
    return (
        df.withColumn("_rn", F.row_number().over(local))
        .withColumn("_prev", F.lag(value).over(local))
        .join(carry, LINK)
        .withColumn(name, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev")))
        .drop("_rn", "_prev", "_carry", *LINK)
    )


def with_run_length(df: DataFrame, keys: list, order: list, segment: Column, hit: Column, name: str) -> DataFrame:
    """Length of the unbroken run of ``hit`` rows ending at each row (0 off a run; an unknown hit ends a run)."""
    df = _cut(df, keys, segment).withColumn("_hit", F.coalesce(hit.cast("int"), F.lit(0)))
    upto = Window.partitionBy(*LINK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_breaks", F.sum(1 - F.col("_hit")).over(upto))
    run = Window.partitionBy(*LINK, "_breaks").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_run", F.sum("_hit").over(run))
    tails = df.groupBy(*LINK).agg(
        F.max_by("_run", F.struct(*order)).alias("_tail"),
        F.max("_breaks").alias("_broken"),
    )
    chain = Window.partitionBy("_key").orderBy("_seg")
    so_far = chain.rowsBetween(Window.unboundedPreceding, 0)
    tails = tails.withColumn("_isle", F.sum((F.col("_broken") > 0).cast("int")).over(so_far))
    isle = Window.partitionBy("_key", "_isle").orderBy("_seg").rowsBetween(Window.unboundedPreceding, 0)
    tails = tails.withColumn("_out", F.sum("_tail").over(isle))
    carry = tails.select(*LINK, F.coalesce(F.lag("_out").over(chain), F.lit(0)).alias("_in"))
    first = (F.col("_breaks") == 0) & (F.col("_hit") == 1)
    return (
        df.join(carry, LINK)
        .withColumn(name, F.col("_run") + F.when(first, F.col("_in")).otherwise(0))
        .drop(*LINK, "_hit", "_breaks", "_run", "_in")
    )


def with_batch(df: DataFrame, keys: list, unique: str, size: int, name: str, spread: int = 256) -> DataFrame:
    """Number batches of exactly ``size`` rows (the last may be smaller) per key."""
    part = F.pmod(F.xxhash64(unique), F.lit(spread))
    out = with_row_number(df, keys, [unique], part, "_pos")
    return out.withColumn(name, F.floor((F.col("_pos") - 1) / size)).drop("_pos")
