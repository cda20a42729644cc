"""A corpus pipeline: quality filter, line dedup, near-duplicate groups, source mix, token ids.

Each stage reads the documents that the stage before it kept, and writes what it keeps; its decisions take effect there.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from beamwright.llm import bpe, jaccard, lines, mixing, quality
from beamwright.llm.common import table, written

SHARDS = 16


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours vote for them; the others go. Without labels of both classes there is nothing to judge by: all stay."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality")
    if not quality.can_judge(model):
        return docs
    return quality.score(docs, model, threshold=0.7).filter("predicted = 1").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document holds."""
    rows = lines.dedup_lines(docs)
    changed = F.col("doc").withField("text", F.col("kept")).withField("n_chars", F.length("kept").cast("long"))
    return rows.select(F.when(F.col("n_dropped") > 0, changed).otherwise(F.col("doc")).alias("doc")).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the group's least doc_id, nulls last, and of those the one whose text has the least hash.

    Rows equal in doc_id and text are one document; rows that share a doc_id, or have none, but differ in text are not.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))
    # the struct stands for the document, so that a group's least one is a single document; it meets nulls, and serves the
    # join and the window with one shuffle
    groups = jaccard.components(docs.select(key.alias("doc_id"), "text"))
    stay = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("key")).distinct()
    keyed = docs.select(F.struct("*").alias("doc"), key.alias("key"))
    copies = W.Window.partitionBy("key").orderBy(F.lit(1))
    kept = keyed.join(written(stay, "groups"), "key", "left_semi").withColumn("copy", F.row_number().over(copies))
    return kept.filter("copy = 1").select("doc.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: sources weigh 1, 2, 3 in turn, whole documents as often as they are taken, dealt to shards and shuffled there."""
    rows = mixing.mixed(docs, weights=(1, 2, 3), most=3.0, shards=SHARDS)
    return rows.repartition("shard").sortWithinPartitions("shard", "place").select("doc.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, the characters they start at, and the text they decode to as a digest."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rows = bpe.encode(docs, path, pattern, decoded=True)
    return rows.select(
        "doc.doc_id", "doc.source", F.size("ids").cast("long").alias("n_tokens"), "ids", "starts",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding", token_ids),
]

# The votes of the first stage and the draws of the fourth have no form in SQL; tests/llm/test_tables.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
