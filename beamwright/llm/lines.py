"""Lines that repeat across documents, dropped everywhere but in the first document that holds them.

The keys of all lines, as hashes, are partitioned by range and sorted by key, document and position; one pass over each
partition marks every line whose document is not the first of its key. The marks come back per document as a bitmap of 64 lines a
word, with the words before and between marks left out, and only then meet the text. Keys found on more than a
``HOT_SHARE``-th of all lines are fewer than ``HOT_SHARE``: their first document is broadcast, and their lines go nowhere.

Defined results: a null or empty text is one empty line; a line's key has ASCII white space stripped and A-Z in lower case,
and counts from ``least`` code points on; a null doc_id counts as larger than any other; rows with one doc_id are one
document, so a line repeated within it stays; equal rows get equal results. An empty table gives an empty table. Columns of
the input other than doc_id and the text pass through as they are.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from beamwright.llm.common import HOT_SHARE, written

STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, least: int, text: str = "text") -> DataFrame:
    """One row per line with a key that counts: h1, h2 (128 bits of the key), doc_id, text_hash, pos."""
    exploded = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(split_lines(F.col(text))).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(STRIPPED)), UPPER, LOWER)
    return exploded.select("doc_id", "text_hash", "pos", key.alias("key")).filter(F.length("key") >= least).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos")


def dropped_lines(docs: DataFrame, least: int = 10, text: str = "text") -> DataFrame:
    """doc_id, text_hash and pos of every line that goes."""
    keys = written(line_keys(docs, least, text), "line-keys")
    total = keys.count()
    common = keys.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter(F.col("n") * HOT_SHARE > total)
    common = F.broadcast(written(common.drop("n"), "common-lines"))
    later = ~F.col("doc_id").eqNullSafe(F.col("first_doc"))
    hot = keys.join(common, ["h1", "h2"]).filter(later)
    in_order = W.Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "pos")
    cold = keys.join(common, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2").sortWithinPartitions(
        "h1", "h2", F.col("doc_id").asc_nulls_last(), "pos")
    cold = cold.withColumn("first_doc", F.first("doc_id").over(in_order)).filter(later)
    return hot.select("doc_id", "text_hash", "pos").unionByName(cold.select("doc_id", "text_hash", "pos"))


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """Per document the marks of its lines: doc_id, text_hash, marks (word, bits), n_dropped; documents that keep all have no row."""
    words = dropped.repartition("doc_id", "text_hash").groupBy("doc_id", "text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("marks"), F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"))


def _unpacked(marks: str) -> Column:
    """All words of a bitmap, zeros put back."""
    return F.expr(f"""flatten(transform({marks}, (m, j) -> concat(
        array_repeat(0L, m.word - if(j = 0, 0, {marks}[greatest(j - 1, 0)].word + 1)), array(m.bits))))""")


def without_marked(docs: DataFrame, bitmaps: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` whole, under ``doc``, with n_lines, n_dropped and the text that stays, ``kept``."""
    marks = bitmaps.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), _unpacked("marks").alias("words"), "n_dropped")
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("own_id"), F.xxhash64(text).alias("own_hash"))
    met = whole.join(marks.hint("shuffle_hash"), (F.col("own_hash") == F.col("hash")) & F.col("own_id").eqNullSafe(F.col("id")), "left")
    lines = split_lines(F.col("doc")[text])
    stay = F.array_join(F.filter(lines, lambda x, i: F.expr("0") == _bit(i)), "\n")
    return met.select(
        "doc", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("words").isNull(), F.coalesce(F.col("doc")[text], F.lit(""))).otherwise(stay).alias("kept"))


def _bit(i: Column) -> Column:
    word = F.coalesce(F.get("words", F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
    return F.call_function("getbit", word, F.pmod(i, F.lit(64)))


def dedup_lines(docs: DataFrame, least: int = 10, text: str = "text") -> DataFrame:
    return without_marked(docs, drop_bitmaps(dropped_lines(docs, least, text)), text)
