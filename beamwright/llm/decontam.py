"""Benchmark passages in documents: found by word windows, then cut out, or their documents dropped.

Test items become windows of normalised words (an item with fewer words is one window), one row per distinct window. The windows
are broadcast as a hash set, in as many passes as keep every broadcast below ``WINDOWS_AT_ONCE`` rows and ``BYTES_AT_ONCE`` bytes;
each pass scans every word window of the training texts against its part, and a hit counts only if the words themselves are
equal. The texts stay where they are: only hits (document, place, which items) are shuffled, and the words they cover meet as
bitmaps of 64 words. All of it is built-in functions.

Defined results: A-Z count as a-z; words are runs of letters a-z, digits and anything beyond ASCII. A null or empty text, or one
without words, has no words, hits nothing and stays as it is; an item without words has no windows. A text with fewer words than a
window cannot hold it. Rows equal in doc_id and text get equal results each, and rows that share a doc_id (or have none) but
differ in text are told apart. Items with one item_id are one item; all items without item_id are one item that is counted but
has no place in the list of ids. An empty table of items marks nothing, an empty table of documents gives an empty table. Only
doc_id and the text (item_id and text) are read, so other columns cannot clash; ``removed`` passes all columns through.
"""

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"0-9a-z\x{80}-\x{10FFFF}"
"""What words are made of once A-Z are in lower case. Java matches these ranges five times as fast as all but the separators."""
SEPARATORS_ANY_CASE = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WINDOWS_AT_ONCE = 1 << 18
BYTES_AT_ONCE = 64 << 20


def words(text: Column) -> Column:
    """Words in lower case (A-Z only); texts that are all ASCII take the short way."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(f"[{WORD}]+"), F.lit(0))


def item_windows(items: DataFrame, size: int, text: str = "text") -> DataFrame:
    """One row per distinct window: ``h``, its words ``window``, the sorted ids of the items that hold it, ``items``, whether
    one of them has no id, ``unnamed``, and a 128-bit name of that set of items, ``held``."""
    cut = items.select("item_id", words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    cut = cut.withColumn("n", F.least(F.lit(size), F.size("w")))
    cut = cut.select("item_id", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("at"))
    rows = cut.select("item_id", F.slice("w", F.col("at"), F.col("n")).alias("window")).groupBy("window").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"), F.max(F.col("item_id").isNull()).alias("unnamed"))
    held = F.struct(F.xxhash64("items", "unnamed").alias("a"), F.xxhash64(F.lit(1), "items", "unnamed").alias("b"))
    return rows.select(F.xxhash64("window").alias("h"), "window", "items", "unnamed", held.alias("held"))


def _trace(word) -> Column:
    """A hash of a window's first, middle and last word; ``word`` maps places in it to words."""
    return F.xxhash64(*[word(place) for place in ("0", "(length - 1) div 2", "length - 1")])


def scanned(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """A row for every place of a document where a window lies, as ``hits`` gives it, and one for every row of ``docs``, with
    ``pos`` -1, no ``held``, and its number of words as ``length``.

    ``windows`` is a written table as ``item_windows`` makes it. Words are taken from a text once per pass. Places whose first,
    middle and last words are in no window of the pass are left out by one number before the whole window is looked at.
    """
    bytes_ = F.sum(F.aggregate("window", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 8))
    n, size, lengths = windows.agg(F.count("*"), F.coalesce(bytes_, F.lit(0)), F.sort_array(F.collect_set(F.size("window")))).first()
    passes = max(1, ceil(n / WINDOWS_AT_ONCE), ceil(size / BYTES_AT_ONCE))
    first = lengths[0] if lengths else 0
    texts = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("w"))
    if len(lengths) > 1:
        texts = texts.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("length"))
    else:
        texts = texts.withColumn("length", F.lit(first))
    last = F.greatest(F.size("w") - F.col("length"), F.lit(-1)) if lengths else F.lit(-1)
    # a filter on the number of words, or one that Spark infers from an inner explode, would take all words once more
    places = texts.select("*", F.explode_outer(F.sequence(F.lit(-1), last)).alias("pos"))
    places = places.withColumn("trace", _trace(lambda place: F.get("w", F.col("pos") + F.expr(f"cast({place} as int)"))))
    here, is_place = F.slice("w", F.greatest("pos", F.lit(0)) + 1, F.col("length")), F.col("pos") >= 0
    found = []
    for k in range(passes):
        part = windows.filter(F.pmod("h", F.lit(passes)) == k).select("h", "window", "held", F.size("window").alias("length"))
        traces = part.select(_trace(lambda place: F.get("window", F.expr(f"cast({place} as int)"))).alias("_trace")).distinct()
        is_doc = (F.col("pos") < 0) & F.lit(k == 0) & (F.col("length") == first)
        near = places.join(F.broadcast(traces), F.col("trace") == F.col("_trace"), "left").filter(is_doc | (is_place & F.col("_trace").isNotNull()))
        part = part.select("h", "window", "held")
        met = near.join(F.broadcast(part), is_place & (F.xxhash64(here) == F.col("h")) & (here == F.col("window")), "left")
        met = met.filter(~is_place | F.col("held").isNotNull())
        found.append(met.select("doc_id", "text_hash", "pos", F.when(is_place, F.col("length")).otherwise(F.size("w")).alias("length"), "held"))
    return reduce(DataFrame.unionByName, found)


def hits(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """A row for every place of a document where a window lies: doc_id, text_hash, pos (word number from 0), length, held."""
    return scanned(docs, windows, text).filter("pos >= 0")


def covered(found: DataFrame) -> DataFrame:
    """Per document the words that hits cover, 64 words to a row: doc_id, text_hash, chunk, bits."""
    chunks = F.explode(F.expr("sequence(cast(pos div 64 as int), cast((pos + length - 1) div 64 as int))")).alias("chunk")
    rows = found.select("*", chunks)
    rows = rows.withColumn("lo", F.greatest(F.col("pos") - F.col("chunk") * 64, F.lit(0)))
    rows = rows.withColumn("n", F.least(F.col("pos") + F.col("length") - F.col("chunk") * 64, F.lit(64)) - F.col("lo"))
    bits = F.expr("shiftleft(if(n = 64, -1L, shiftleft(1L, n) - 1), lo)")
    return rows.groupBy("doc_id", "text_hash", "chunk").agg(F.bit_or(bits).alias("bits"))


def marked(docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a hit), n_items, items (their ids as sorted strings), contaminated."""
    windows = written(item_windows(items, size, text), "item-windows")
    # the documents' numbers of words come with the hits, so that their texts are read and cut into words once
    kept = written(scanned(docs, windows, text), "item-hits")
    found = kept.filter("pos >= 0")
    key = ["doc_id", "text_hash"]
    n_hit = covered(found).groupBy(*key).agg(F.sum(F.bit_count("bits")).cast("long").alias("n_hit"))
    sets = windows.select("held", "items", "unnamed").dropDuplicates(["held"])
    met = found.select(*key, "held").distinct().join(sets, "held")
    ids = met.select(*key, "unnamed", F.explode_outer("items").alias("id")).groupBy(*key).agg(
        F.array_sort(F.collect_set("id")).alias("items"), F.max("unnamed").cast("int").alias("unnamed"))
    same = lambda other: [F.col("d.doc_id").eqNullSafe(F.col(f"{other}.doc_id")), F.col("d.text_hash") == F.col(f"{other}.text_hash")]
    rows = kept.filter("pos < 0").select(*key, F.col("length").cast("long").alias("n_words")).alias("d")
    rows = rows.join(n_hit.alias("h"), same("h"), "left").join(ids.alias("i"), same("i"), "left")
    hit = F.coalesce("h.n_hit", F.lit(0).cast("long"))
    held = F.coalesce("i.items", F.array().cast("array<string>"))
    return rows.select(
        "d.doc_id", "d.n_words", hit.alias("n_hit"), (F.size(held) + F.coalesce("i.unnamed", F.lit(0))).cast("long").alias("n_items"),
        held.alias("items"), (hit > 0).alias("contaminated"))


def removed(docs: DataFrame, items: DataFrame, what: str = "spans", size: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without the items' passages (``what="spans"``: hit words go, each with the separators before it) or without the
    documents that hold any (``what="documents"``). All columns stay as they are, but for the text of a document that is cut."""
    if what not in ("spans", "documents"):
        raise ValueError(f"what is 'spans' or 'documents', not {what!r}")
    windows = written(item_windows(items, size, text), "item-windows")
    bits = covered(hits(docs, windows, text))
    whole = docs.select(F.struct("*").alias("doc")).withColumn("h", F.xxhash64(F.col("doc")[text]))
    same = F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash"))
    if what == "documents":
        return whole.join(bits.select("doc_id", "text_hash").distinct(), same, "left_anti").select("doc.*")
    marks = bits.groupBy("doc_id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("chunk", "bits"))).alias("marks"))
    pieces = F.regexp_extract_all(F.col("doc")[text], F.lit(f"[{SEPARATORS_ANY_CASE}]*[^{SEPARATORS_ANY_CASE}]+"), F.lit(0))
    rest = F.regexp_extract(F.col("doc")[text], f"[{SEPARATORS_ANY_CASE}]*$", 0)
    word = lambda i: F.coalesce(F.col("marks")[F.floor(i / 64).cast("int")], F.lit(0).cast("long"))
    stay = F.filter(pieces, lambda x, i: F.call_function("getbit", word(i), F.pmod(i, F.lit(64))) == 0)
    cut = F.when(F.col("marks").isNull(), F.col("doc")[text]).otherwise(F.concat(F.array_join(stay, ""), rest))
    return whole.join(marks, same, "left").select(F.col("doc").withField(text, cut).alias("doc")).select("doc.*")
