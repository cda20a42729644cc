"""Helpers shared by the corpus operators."""

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beamwright.session import scratch_dir

# Arrow batches are cut by bytes as well as rows, so that a run of very long texts cannot fill a Python worker.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
HOT_SHARE = 500
"""A key is hot when it holds more than one row in HOT_SHARE; there are fewer than HOT_SHARE such keys in any table."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Cut lineage with a table in the shared folder: lost executors cost nothing that lies before it."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach_by_key(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int, salt: Column) -> DataFrame:
    """Left-join ``facts`` (one row per key, with the key's row count) to ``rows``, whatever the skew.

    Keys with more than a ``HOT_SHARE``-th of all rows number fewer than ``HOT_SHARE``, so their facts are broadcast; the
    rows of these keys then join on a salted key that no fact has, and spread out instead of meeting in one task.
    """
    extra = [c for c in facts.columns if c not in (key, count)]
    tag = uuid.uuid4().hex[:8]
    hot = facts.filter(F.col(count) * HOT_SHARE > F.lit(total))
    hot = F.broadcast(hot.select(F.col(key).alias(f"hot_{tag}"), F.struct(*extra).alias(f"hv_{tag}")))
    cold = facts.filter(F.col(count) * HOT_SHARE <= F.lit(total))
    cold = cold.select(F.struct(F.col(key).alias("k"), F.lit(0).cast("long").alias("s")).alias(f"ck_{tag}"), F.struct(*extra).alias(f"cv_{tag}"))
    marked = rows.join(hot, F.col(key).eqNullSafe(F.col(f"hot_{tag}")), "left")
    is_hot = F.col(f"hv_{tag}").isNotNull()
    marked = marked.withColumn(f"jk_{tag}", F.struct(
        F.col(key).alias("k"), F.when(is_hot, F.shiftrightunsigned(salt, 1) + 1).otherwise(F.lit(0).cast("long")).alias("s")))
    joined = marked.join(cold, F.col(f"jk_{tag}").eqNullSafe(F.col(f"ck_{tag}")), "left")
    value = F.coalesce(F.col(f"hv_{tag}"), F.col(f"cv_{tag}"))
    return joined.select(*rows.columns, *[value[c].alias(c) for c in extra])


def held_out(doc_id: Column) -> Column:
    """The rows no label may be learnt from; a null id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` texts with their label (0 or 1), none held out: those whose ids hash lowest.

    A document labelled more than once has the larger label, an id with several texts the least of them. The chosen ids
    number ``rows`` at most, so they are broadcast.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label")


def give_back() -> None:
    """Return freed memory to the machine. Workers live on after a task, beside executors whose heaps have grown meanwhile."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
