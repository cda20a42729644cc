"""A mix of sources in stated shares, dealt to output shards by a splitting tree.

Targets: the weights share all words; a source stops at ``most`` times its size and what is left over goes to the others by
weight. A source's target is met by whole passes over its documents in a permuted order, then by the first documents of one
more pass. All are whole: the one at the border is taken if that lands nearer the target (or as near), and does not pass ``most``.
With ``cut``, which is off by default, the last one is cut instead, so the words taken are the target to the word.

Dealing: the permuted documents of a source lie in blocks of ``block_docs``; its number of blocks is its exact quota. A tree
splits the quotas of all sources among the output shards: each node draws, by a multivariate hypergeometric, how many blocks
of each source go left, so that both halves are fair samples and every block is drawn once. A shard then takes its
consecutive run of each source's permuted blocks, and shuffles its documents locally. All draws are seeded by the node's place.

Defined results: a null text has no words; a null source is a source of its own, after the others; a document without words
is taken in whole passes only and counts nothing; repeated rows are documents each; an empty table gives an empty mix. Order
within a source depends on doc_id and text alone, so reruns agree. Other columns of the input pass through.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from beamwright.llm.common import attach_by_key, written

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DOCS = 1024
"""Documents per stretch of a permuted order; stretches are numbered apart and then joined by their sums."""
PLACES = 1 << 14
"""The most blocks that are drawn place by place."""
FAN_OUT = 16


def source_key() -> Column:
    """A source's name, or the null source's, in the order of code points with null last: names start with '=', null is '~'."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~"))


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Light rows of all documents: doc_id, source_key, text_hash, size."""
    light = docs.select(
        "doc_id", source_key().alias("source_key"), F.xxhash64(text).alias("text_hash"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    return written(light, "mix-sizes")


def targets(light: DataFrame, weights=(1, 2, 3), most: float = 3.0) -> DataFrame:
    """Per source: source_key, docs, n_docs (again), source_size, target. One row per source meets in one task, nothing else does.

    With r = most * size / weight, sources stop in the order of r. If all up to the k-th stop, the others get
    (total - what the stopped take) / (weight left) per unit of weight; the true level is that of the first k whose
    successor does not stop at it.
    """
    per = light.groupBy("source_key").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    by_name = W.Window.orderBy("source_key")
    # strings compare by their bytes in UTF-8, which is the order of code points
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)).withColumn(
        "cap", F.col("source_size") * F.lit(most))
    by_stop = W.Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    everything = by_stop.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    upto = by_stop.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    per = per.withColumn("stop", F.col("cap") / F.col("weight")).withColumn("taken", F.sum("cap").over(upto) - F.col("cap")).withColumn(
        "left", weight - F.sum("weight").over(upto) + F.col("weight")).withColumn("total", total)
    # the level if the sources before this one stop and this one does not
    per = per.withColumn("level", (F.col("total") - F.col("taken")) / F.col("left"))
    level = F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return per.select("source_key", "docs", F.col("docs").alias("n_docs"), "source_size", target.alias("target"))


def drawn(left: int, counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """How many of ``left`` blocks drawn without replacement come from each source: a multivariate hypergeometric, at any size.

    Every block is taken with the same probability, which gives a binomial per source; whatever their number, those taken are a
    fair sample of their size, and so stay one when blocks are drawn from them and put back, or drawn from the rest and added,
    until there are ``left``. The correction is about the root of ``left``, so few rounds end at a small draw by places.
    """
    total = int(counts.sum())
    if 2 * left > total:
        return counts - drawn(total - left, counts, rng)
    if left <= PLACES:
        return np.bincount(np.searchsorted(np.cumsum(counts), rng.choice(total, left, replace=False), "right"), minlength=len(counts)) if left else np.zeros_like(counts)
    taken = rng.binomial(counts, left / total)
    over = int(taken.sum()) - left
    return taken - drawn(over, taken, rng) if over > 0 else taken + drawn(-over, counts - taken, rng)


def deal(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """The splitting tree: quotas (source_key, blocks) to (source_key, shard, blocks), shard from 0.

    Each round of groups splits every node into up to ``FAN_OUT`` children by halving; a group holds one row per source.
    """

    def halves(low: int, high: int, counts: np.ndarray, leaves: int):
        if leaves == 1 or high - low == 1:
            yield low, high, counts
            return
        middle = (low + high) // 2
        total = int(counts.sum())
        rng = np.random.default_rng([seed, low, high])
        left = drawn(total * (middle - low) // (high - low), counts, rng)
        yield from halves(low, middle, left, leaves // 2)
        yield from halves(middle, high, counts - left, leaves // 2)

    def split(key: tuple, node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("source_key")
        parts = halves(int(key[0]), int(key[1]), node["blocks"].to_numpy(np.int64), FAN_OUT)
        return pd.concat([pd.DataFrame({"source_key": node["source_key"], "low": lo, "high": hi, "blocks": n}) for lo, hi, n in parts])

    nodes, width = quotas.select("source_key", F.lit(0).alias("low"), F.lit(shards).alias("high"), "blocks"), shards
    while width > 1:
        nodes = nodes.groupBy("low", "high").applyInPandas(split, "source_key string, low int, high int, blocks bigint")
        width = -(-width // FAN_OUT)
    return nodes.select("source_key", F.col("low").alias("shard"), "blocks")


def place(light: DataFrame, goal: DataFrame, seed: int) -> DataFrame:
    """``light`` with the goal's columns, each document's place in its source's permutation, and the words before it: pos, words_before."""
    known = attach_by_key(light, goal, "source_key", "docs", light.count(), F.xxhash64("doc_id", "text_hash"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), 1)
    stretch = F.lit(float(1 << 63)) / F.ceil(F.col("n_docs") / BUCKET_DOCS)
    known = written(known.withColumn("draw", draw).withColumn("bucket", F.floor(F.col("draw") / stretch).cast("long")), "mix-drawn")
    before = W.Window.partitionBy("source_key").orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = known.groupBy("source_key", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("words")).select(
        "source_key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_words"))
    inside = W.Window.partitionBy("source_key", "bucket").orderBy("draw", "doc_id", "text_hash")
    numbered = known.withColumn("row", F.row_number().over(inside)).withColumn("inner", F.sum("size").over(inside.rowsBetween(W.Window.unboundedPreceding, -1)))
    return numbered.join(starts, ["source_key", "bucket"]).withColumn("pos", F.col("row") - 1 + F.col("docs_before")).withColumn(
        "words_before", F.coalesce("inner", F.lit(0)) + F.col("bucket_words")).drop("row", "inner", "docs_before", "bucket_words", "draw", "bucket")


def plan(docs: DataFrame, weights=(1, 2, 3), most: float = 3.0, seed: int = 17, text: str = "text", cut: bool = False) -> DataFrame:
    """Per document what the mix takes of it: whole ``passes``, then ``extra`` words of one more; (source_key, pos) names a document.

    ``extra`` is 0 or the document's size where ``cut`` is off.
    """
    light = sizes(docs, text)
    goal = written(targets(light, weights, most), "mix-targets")
    rows = place(light, goal, seed).withColumn("quota", F.round("target").cast("long"))
    rows = rows.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(F.lit(0)).cast("long"))
    rest = F.col("quota") - F.col("passes") * F.col("source_size")
    if cut:
        extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("words_before")))
    else:
        upto = F.col("words_before") + F.col("size")
        nearer = (F.col("words_before") + upto <= 2 * rest) & (F.col("passes") * F.col("source_size") + upto <= most * F.col("source_size"))
        extra = F.when(nearer, F.col("size")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("extra", extra)
    return written(rows.drop("words_before", "quota"), "mix-plan")


def dealt(planned: DataFrame, shards: int = 16, block_docs: int = 8, seed: int = 17) -> DataFrame:
    """``planned`` with ``units``: an entry for each time the mix takes the document, with pass, words, shard, and its place in the shard."""
    per = planned.groupBy("source_key").agg(
        F.first("n_docs").alias("rows"), F.first("passes").alias("passes"), F.max(F.when(F.col("extra") > 0, F.col("pos") + 1)).alias("more"))
    per = written(per.withColumn("blocks", F.ceil((F.col("passes") * F.col("rows") + F.coalesce("more", F.lit(0))) / block_docs)), "mix-quotas")
    runs = W.Window.partitionBy("source_key").orderBy("shard")
    ends = deal(per.select("source_key", "blocks"), shards, seed).withColumn("end", F.sum("blocks").over(runs)).groupBy("source_key").agg(
        F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ends"))
    facts = written(ends.join(per.select("source_key", "rows"), "source_key"), "mix-runs")
    rows = attach_by_key(planned, facts, "source_key", "rows", planned.count(), F.xxhash64("doc_id", "text_hash"))
    return rows.withColumn("units", F.expr(f"""transform(
        concat(if(passes > 0, transform(sequence(1, passes), p -> struct(p as pass, size as words)), array()),
               if(extra > 0, array(struct(passes + 1 as pass, extra as words)), array())),
        u -> struct(u.pass as pass, u.words as words,
            filter(ends, e -> e.end > floor(((u.pass - 1) * n_docs + pos) / {block_docs}))[0].shard as shard,
            xxhash64({seed + 1}, doc_id, text_hash, u.pass) as place))""")).drop("ends")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++)"), 1), 1, words.cast("int")), "")


def mixed(docs: DataFrame, weights=(1, 2, 3), most: float = 3.0, shards: int = 16, seed: int = 17, text: str = "text", cut: bool = False) -> DataFrame:
    """The mix itself: under ``doc`` each document as often as it is taken, its text cut where only its first words are, with shard and place.

    Rows equal in doc_id, source and text are told apart by number; they are interchangeable.
    """
    units = dealt(plan(docs, weights, most, seed, text, cut), shards, seed=seed)
    keys = ["k_id", "k_source", "k_hash"]
    taken = units.groupBy(F.struct("doc_id").alias("k_id"), F.col("source_key").alias("k_source"), F.col("text_hash").alias("k_hash")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "size", "units"))).alias("copies"))
    whole = docs.select(
        F.struct("*").alias("doc"), F.struct("doc_id").alias("k_id"), source_key().alias("k_source"), F.xxhash64(text).alias("k_hash"))
    numbered = whole.withColumn("copy", F.row_number().over(W.Window.partitionBy(*keys).orderBy(F.lit(1))))
    met = numbered.join(taken, keys).withColumn("mine", F.element_at("copies", F.col("copy")))
    rows = met.withColumn("unit", F.explode("mine.units"))
    if cut:
        part = F.when(F.col("unit.words") < F.col("mine.size"), first_words(F.col("doc")[text], F.col("unit.words"))).otherwise(F.col("doc")[text])
        rows = rows.withColumn("doc", F.col("doc").withField(text, part))
    return rows.select("doc", "unit.shard", "unit.place")
