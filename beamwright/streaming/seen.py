"""A durable set of the keys a stream has met, so that each is handled once however late it comes back.

State with a watermark forgets. Here every micro-batch leaves two tables beside its results: the keys it was first to bring, and the
Bloom filter of all keys so far, in blocks of eight 64-bit lanes with one bit a lane (a row a block; filters merge by OR). A
batch joins the filter by block, a row a key: what the filter has not seen is new without any look at the keys; only suspects are
compared with the keys themselves, so the answer is exact and false alarms cost time, not results.

Entries are numbered like the batches of the checkpoint they belong to. Batch n reads entries below n and writes entry n, so a
batch that is run again after a failure meets the same past and leaves the same tables.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.session import scratch_dir
from beamwright.streaming import streams

LANES = 8
WORDS = [f"w{i}" for i in range(LANES)]


def _block(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - depth)


def _bit(key: Column, lane: int) -> Column:
    """The key's bit in one lane: six bits of a second hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 6 * lane).bitwiseAND(F.lit(63))


def bloom(keys: DataFrame, key: str, depth: int) -> DataFrame:
    """The filter of a table of keys: block, w0 to w7."""
    lanes = [F.bit_or(F.expr(f"shiftleft(1L, cast(b{i} as int))")).alias(w) for i, w in enumerate(WORDS)]
    marked = keys.select(_block(F.col(key), depth).alias("block"), *[_bit(F.col(key), i).alias(f"b{i}") for i in range(LANES)])
    return marked.groupBy("block").agg(*lanes)


def merged(*filters: DataFrame) -> DataFrame:
    """One filter for the keys of several of one depth."""
    rows = filters[0].select("block", *WORDS)
    for other in filters[1:]:
        rows = rows.unionByName(other.select("block", *WORDS))
    return rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def suspected(rows: DataFrame, known: DataFrame, key: str, depth: int) -> DataFrame:
    """``rows`` with ``_suspect``: whether the filter may hold the row's key."""
    held = known.select(F.col("block").alias("_block"), *[F.col(w).alias(f"_{w}") for w in WORDS])
    met = rows.withColumn("_at", _block(F.col(key), depth)).join(held, F.col("_at") == F.col("_block"), "left")
    every = F.lit(True)
    for i, w in enumerate(WORDS):
        every &= F.call_function("getbit", F.col(f"_{w}"), _bit(F.col(key), i).cast("int")) == 1
    return met.select(*rows.columns, F.coalesce(every, F.lit(False)).alias("_suspect"))


def take_new(batch: DataFrame, folder: str, number: int, key: str, depth: int = 14) -> DataFrame:
    """The rows of batch ``number`` whose key no earlier batch brought, one a key (null is a key), written and read back.

    ``depth`` sets the size of the filter: 2^depth blocks, each good for about 40 keys before false alarms pass one in a hundred.
    """
    spark = batch.sparkSession
    rows = batch.dropDuplicates([key])
    if number:
        marked = suspected(rows, spark.read.parquet(f"{folder}/filter/batch={number - 1}"), key, depth)
        earlier = spark.read.parquet(f"{folder}/keys").filter(F.col("batch") < number).select(F.struct(F.col("key").alias("k")).alias("_k"))
        suspects = marked.filter("_suspect").withColumn("_k", F.struct(F.col(key).alias("k")))
        # the long table of keys is cut to the suspects before anything is joined to it
        known = earlier.join(suspects.select("_k").distinct(), "_k", "left_semi")
        rows = marked.filter("not _suspect").drop("_suspect").unionByName(suspects.join(known, "_k", "left_anti").drop("_k", "_suspect"))
    fresh = f"{folder}/new/batch={number}"
    rows.write.mode("overwrite").parquet(fresh)
    rows = spark.read.schema(batch.schema).parquet(fresh)
    rows.select(F.col(key).alias("key")).write.mode("overwrite").parquet(f"{folder}/keys/batch={number}")
    own = bloom(rows, key, depth)
    if number:
        own = merged(own, spark.read.parquet(f"{folder}/filter/batch={number - 1}"))
    own.write.mode("overwrite").parquet(f"{folder}/filter/batch={number}")
    return rows


def run_once_per_key(stream: DataFrame, purpose: str, key: str, write: Callable[[DataFrame, str], None], depth: int = 14, where: str | None = None) -> str:
    """Process what is available; ``write(rows, folder)`` gets each micro-batch's rows with new keys, as ``streams.run_batches`` gives all rows.

    ``where`` is the folder of the checkpoint, the seen keys and the results; a later run with the same folder goes on from it.
    """
    where = where or scratch_dir(stream.sparkSession, purpose)

    def each(batch: DataFrame, number: int) -> None:
        write(take_new(batch, f"{where}/seen", number, key, depth), f"{where}/data/{{table}}/batch={number}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{where}/checkpoint")
    streams.run(stream.sparkSession, writer)
    return f"{where}/data"


def durable_intake(files: DataFrame, decisions: dict, purpose: str = "durable-intake", depth: int = 14, where: str | None = None) -> str:
    """Every new file once, for good: routes, schedule and offsite copies as ``streams.write_intake`` writes them, in the returned folder."""

    def write(rows: DataFrame, folder: str) -> None:
        streams.write_intake(streams.routed(rows, decisions), folder)

    return run_once_per_key(files, purpose, "file_path", write, depth, where)
