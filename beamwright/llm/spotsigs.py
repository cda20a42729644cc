"""SpotSigs fingerprints: chains of content words that follow common words.

Each common word of a text is an anchor; its signature is the anchor and the next ``chain`` content words, ``gap`` apart. The
fingerprint is the sorted list of the hashes of a text's signatures, a repeated one counted as often as it occurs. A word with
no anchor within ``reach`` words before or after it starts a chain too, so passages and texts without anchors have signatures.
No count over the text decides, so a passage has the same signatures in any text, but for those near its ends.

Sets are compared by Jaccard likeness. Sets whose sizes lie in the ratio r cannot be more alike than r, so comparisons go by
classes of size: ``near_pairs`` joins neighbouring classes only, over the rarest part of each set, after equal fingerprints
have become one class.

Defined results: a null text is the empty text, whose fingerprint is empty; two empty fingerprints are alike (1), an empty
and another are not (0). In ``chained`` a document's next is the one before it by
doc_id, nulls last, rows with equal doc_id by text; the last one's next is the first; a lone document is its own next. An
empty table gives an empty table. Of the input only doc_id and the text are read.
"""

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType

from beamwright.llm.common import written
from beamwright.llm.jaccard import Shingler

# The commonest function words of English, French, German and Spanish.
COMMON = frozenset("""
a an and are as at be by for from has he in is it of on or that the this to was were will with
au avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une
aber auf das dem den der des die ein eine er es für ist mit nicht sich sie und von war zu
al como con del el en es la las lo los más no o para por que se su una y
""".split())
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class WordCodes(Shingler):
    """Hashes of a text's words in their order; words are runs of ASCII letters and digits and of other than ASCII characters."""

    def __init__(self):
        super().__init__(words=1)
        self.space[:128] = [not chr(b).isalnum() for b in range(128)]
        self.code[self.space] = self.code[32]

    def __call__(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return np.concatenate([self._spans(part, False) for part in self.chunks(raw)]) if len(raw) else np.empty(0, np.uint64)


@lru_cache(maxsize=1)
def _codes() -> tuple[WordCodes, np.ndarray]:
    codes = WordCodes()
    return codes, np.unique(np.concatenate([codes(w) for w in COMMON]))


def signatures(text: str, chain: int = 2, gap: int = 1, reach: int = 8) -> np.ndarray:
    """Sorted 64-bit hashes of a text's signatures and their occurrences; the last chains are cut short by the end of the text."""
    words, anchors = _codes()
    codes = words(text)
    if not len(codes):
        return codes
    common = anchors[np.minimum(np.searchsorted(anchors, codes), len(anchors) - 1)] == codes
    content = np.append(codes[~common], np.zeros(chain * gap, np.uint64))
    upto = np.cumsum(~common)

    def chains(at: np.ndarray) -> np.ndarray:
        out = codes[at] * _A
        for step in range(chain):
            out = (out ^ (out >> np.uint64(29))) * _B + content[upto[at] + step * gap] * _C
        out = np.sort(out ^ (out >> np.uint64(32)))
        # the n-th occurrence of a signature is an element of its own, so that sets compare as multisets do
        new = np.append(True, out[1:] != out[:-1])
        runs = np.flatnonzero(new)
        nth = np.arange(len(out)) - runs[np.cumsum(new) - 1]
        out = (out + nth.astype(np.uint64) * _A) * _B
        return np.unique(out ^ (out >> np.uint64(31)))

    at, before = np.arange(len(codes)), np.append(0, np.cumsum(common))
    near = before[np.minimum(at + reach + 1, len(codes))] - before[np.maximum(at - reach, 0)]
    return chains(np.flatnonzero(common | (near == 0)))


def text_of(fingerprint: np.ndarray) -> str:
    """A fingerprint as text: the web-safe base64 of its numbers, in their order."""
    return base64.urlsafe_b64encode(fingerprint.astype(">u8").tobytes()).decode().rstrip("=")


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard likeness; sets whose sizes alone keep it below ``floor`` are not looked at."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < floor * large:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    found = shared / (small + large - shared)
    return found if found >= floor else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many of the next document's first characters (or all)."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = signatures(changed) if changed != text else own
    return (len(text), hashlib.sha256(changed.encode()).hexdigest(), text_of(own), text_of(other), likeness(own, other), likeness(own, next_own))


PER_STRETCH = 20
WIDE = 512


def stretch_of(docs: DataFrame, stretches: int):
    """A column that numbers ``stretches`` stretches of doc_ids, descending, about equal in rows; nulls are the last.

    The bounds are quantiles of the ids that hash lowest, ``PER_STRETCH`` a stretch. They only balance tasks; no result
    depends on them. Many bounds are looked up in two steps.
    """
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(stretches * PER_STRETCH)
    ids = sorted((r[0] for r in ids.collect()), reverse=True)
    bounds = sorted(set(ids[PER_STRETCH - 1 :: PER_STRETCH]), reverse=True)
    kind = docs.schema["doc_id"].dataType
    listed = lambda values: F.array(*[F.lit(v) for v in values]).cast(ArrayType(kind))
    over = lambda values: F.size(F.filter(values, lambda b: b > F.col("doc_id")))
    if len(bounds) <= WIDE:
        place = over(listed(bounds))
    else:
        groups = [bounds[i : i + WIDE] for i in range(0, len(bounds), WIDE)]
        group = F.greatest(over(listed([g[0] for g in groups])), F.lit(1))
        place = (group - 1) * WIDE + over(F.element_at(F.array(*map(listed, groups)), group))
    return F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(place).cast("int")


def _row(columns, kinds, names, first):
    columns = columns or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([first, *[pa.array(c, t) for c, t in zip(columns, kinds)]], names)


ARROW = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def chained(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and the next document, in descending doc_id.

    Each stretch of doc_ids lies in one task, which goes through it in order, a document at a time; the texts are shuffled
    once. The last document of a stretch meets the first of the next in a join: two texts a stretch.
    """
    kind = docs.schema["doc_id"].dataType
    stretches = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("stretch", stretch_of(docs, stretches))
    fields = f"doc_id {kind.simpleString()}, {TYPES}"

    def work(batches):
        held = None
        for batch in batches:
            ids, out = [], []
            for doc_id, text, stretch in zip(batch.column(0), batch.column(1), batch.column(2)):
                text, stretch = text.as_py(), stretch.as_py()
                own = signatures(text)
                if held is not None and held[3] == stretch:
                    ids.append(held[0])
                    out.append(compared(held[1], held[2], text, own))
                held = (doc_id.as_py(), text, own, stretch)
            yield _row(list(zip(*out)), ARROW, ["doc_id", *COLUMNS], pa.array(ids, to_arrow_type(kind)))

    def finish(batches):
        for batch in batches:
            out = []
            for text, after in zip(batch.column(1), batch.column(2)):
                text, after = text.as_py(), after.as_py()
                out.append(compared(text, signatures(text), after, signatures(after)))
            yield _row(list(zip(*out)), ARROW, ["doc_id", *COLUMNS], batch.column(0))

    order = [F.col("stretch"), F.col("doc_id").desc_nulls_last(), F.col("text")]
    inner = texts.repartitionByRange(stretches, "stretch").sortWithinPartitions(*order).mapInArrow(work, fields)

    # one row a stretch: its first and last id, and the stretch that follows
    ends = written(texts.groupBy("stretch").agg(F.max("doc_id").alias("first_id"), F.min("doc_id").alias("last_id")), "stretches")
    by_number = W.Window.orderBy("stretch")
    everything = by_number.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    ends = ends.withColumn("following", F.coalesce(F.lead("stretch").over(by_number), F.min("stretch").over(everything)))
    ends = F.broadcast(written(ends, "stretches"))
    same = texts.join(ends, "stretch")
    heads = same.filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("stretch").agg(F.min("text").alias("after"))
    tails = same.filter(F.col("doc_id").eqNullSafe(F.col("last_id"))).groupBy("following").agg(F.first("doc_id").alias("doc_id"), F.max("text").alias("text"))
    last = tails.join(heads.withColumnRenamed("stretch", "following"), "following").select("doc_id", "text", "after").mapInArrow(finish, fields)
    return inner.unionByName(last)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` whole, under ``doc``, with ``signatures`` (sorted hashes)."""

    def work(batches):
        for batch in batches:
            made = [signatures(t.as_py() or "").view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], ["doc", "signatures"])

    source = docs.select(F.struct("*").alias("doc"), F.col("text"))
    return source.mapInArrow(work, f"doc {source.schema['doc'].dataType.simpleString()}, signatures array<bigint>")


def near_pairs(printed: DataFrame, id_col: str, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Membership (id, class_id) of all rows, and pairs (a, b, likeness) of classes with a likeness of ``threshold`` or more.

    Rows with equal fingerprints are one class, so copies are not paired with each other; null and repeated ids are members like any other. Classes
    fall into size classes, each 1/threshold times as wide as the one before, and only meet in their own and the
    next. There a pair must share one of the first signatures of both, in the order of rarity, and have lengths that
    allow the threshold from where they meet on. Empty fingerprints are one class that pairs with none.
    """
    class_id = F.concat(F.hex(F.xxhash64("signatures")), F.hex(F.xxhash64(F.lit(1), "signatures")))
    named = printed.select(F.col(id_col).alias("id"), class_id.alias("class_id"), F.col("signatures").alias("s"))
    members = named.select("id", "class_id")
    sets = named.filter(F.size("s") > 0).select(F.col("class_id").alias("id"), "s").dropDuplicates(["id"])
    sets = written(sets.withColumn("size", F.size("s")).withColumn("cls", F.floor(F.log("size") / F.log(F.lit(1 / threshold))).cast("int")), "spot-sets")
    each = sets.select("id", "size", "cls", F.explode("s").alias("sig"))
    often = each.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = each.join(often, "sig").withColumn("rank", F.row_number().over(W.Window.partitionBy("id").orderBy("n", "sig")))
    # signatures found once come first in the order and need no entry
    alone = F.col("size") - F.count("*").over(W.Window.partitionBy("id"))
    entries = ranked.withColumn("pos", F.col("rank") + alone).filter(F.col("pos") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1)
    entries = written(entries.select("sig", "id", "size", "cls", "pos"), "spot-index")
    a = entries.select("sig", F.explode(F.array("cls", F.col("cls") + 1)).alias("cls"), F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("pos").alias("pos_a"), F.col("cls").alias("own"))
    b = entries.select("sig", "cls", F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("pos").alias("pos_b"))
    need = F.lit(threshold / (1 + threshold)) * (F.col("size_a") + F.col("size_b")) - 1e-9
    met = a.join(b, ["sig", "cls"]).filter(
        ((F.col("own") < F.col("cls")) | (F.col("a") < F.col("b"))) & (F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b")) + 1 >= need))
    pairs = met.select("a", "b").distinct()
    left, right = (sets.select(F.col("id").alias(c), F.col("s").alias(f"s_{c}")) for c in "ab")
    shared = F.size(F.array_intersect("s_a", "s_b"))
    found = pairs.join(left, "a").join(right, "b").withColumn("likeness", shared / (F.size("s_a") + F.size("s_b") - shared))
    return members, found.filter(F.col("likeness") >= threshold).select("a", "b", "likeness")
