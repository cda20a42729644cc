"""Exact Jaccard join of word-shingle sets, by set relations.

Shingles are hashed to 64 bits and ordered by how often a fixed-size sketch of the whole corpus says they occur, rarest
first; two sets of likeness 3/4 share one of the first quarter (and one) of their shingles, so only those are indexed. Work on an
index list uses what is known of other sets, at two levels:

* Every list has a pivot, the set nearest to the others. Each set is held against the one pivot it meets in most lists; linked sets
  form components, and a list whose sets all lie in one component holds nothing new. That is the whole work for groups of
  copies: one comparison per set, never one per pair.
* The lists that still join several components are cut into blocks by size and position. Pairs of blocks whose greatest
  possible overlap is too small are skipped whole. For sets with the same pivot, the overlaps already computed
  bound the overlap of the two: it is accepted or skipped without a look at the sets.

What is left is held against bitmaps of the sets, which bound an overlap from above, and then compared whole.

Sets equal as sets are one class from the start. Set ids are 64-bit digests; a second digest shows a clash, and
the run starts over with another seed.

Defined results: words are runs of anything but ASCII white space, A-Z in lower case; a null or blank text has no shingle
and is linked with nothing; a text of fewer words than a shingle has is one shingle; a null doc_id counts as larger than
any other and is a component's id only where all its members have none; repeated rows give repeated rows; an empty table
gives an empty table. Of the input only doc_id and the text are read.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from beamwright.llm import graph
from beamwright.llm.common import HOT_SHARE, attach_by_key, written

SKETCH_BITS = 22
SKETCH_PART = 1 << 16
SUBLIST = 20_000
"""Sets per part of an index list; longer lists are split by set id, into ``PARTS`` parts at most."""
PARTS = 1023
PART_STEP = 0x1F3D5B79A1B2D
BITMAP = 1024
FILTER_BITS = 24
CHUNK = 1 << 20
BLOCK, BLOCK_TEXTS = 1 << 18, 256
"""Bytes and texts whose shingles are made together."""
RANK_BITS = 26
M64 = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    The hash of a span is a difference of prefix sums of byte codes times powers of an odd number, divided by the power at its
    start: one pass over the bytes serves all shingles.
    """

    def __init__(self, words: int = 5, seed: int = 0):
        self.words = words
        rng = np.random.default_rng(20_000 + seed)
        self.code = rng.integers(1, M64, 256, np.uint64, endpoint=True)
        self.code[65:91] = self.code[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.code[self.space] = self.code[32]
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 1
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.powers) <= n:
            size = len(self.powers)
            for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 1 << 64))):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, old * np.uint64(pow(base, size, 1 << 64))]))

    def _spans(self, raw: np.ndarray, whole: bool) -> np.ndarray:
        blank = self.space[raw]
        before = np.concatenate([[True], blank[:-1]])
        kept = ~blank | ~before
        place = np.cumsum(kept) - kept
        starts = place[~blank & before]
        ends = place[blank & ~before]
        if len(ends) < len(starts):
            ends = np.append(ends, int(kept.sum()))
        if len(starts) >= self.words:
            first, last = starts[: len(starts) - self.words + 1], ends[self.words - 1 :]
        elif whole and len(starts):
            first, last = starts[:1], ends[-1:]
        else:
            return np.empty(0, np.uint64)
        n = int(kept.sum())
        self._grow(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.code[raw[kept]] * self.powers[:n], dtype=np.uint64)])
        return _mixed((sums[last] - sums[first]) * self.inverses[first])

    def _gap(self, raw: np.ndarray, at: int) -> int:
        """The first white space from ``at`` on, or the end."""
        for low in range(at, len(raw), CHUNK):
            gaps = np.flatnonzero(self.space[raw[low : low + CHUNK]])
            if len(gaps):
                return low + int(gaps[0])
        return len(raw)

    def chunks(self, raw: np.ndarray):
        """Parts of a long text that overlap by one word less than a shingle has, cut at white space."""
        start, size = 0, CHUNK
        while len(raw) - start > size:
            end = self._gap(raw, start + size)
            blank = self.space[raw[start:end]]
            begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
            if end == len(raw):
                break
            if len(begins) < self.words:
                size *= 2
                continue
            yield raw[start:end]
            start, size = start + (int(begins[1 - self.words]) if self.words > 1 else end - start), CHUNK
        yield raw[start:]

    def __call__(self, text: str | None) -> np.ndarray:
        return self._whole(np.frombuffer((text or "").encode(), np.uint8))

    def _whole(self, raw: np.ndarray) -> np.ndarray:
        if not len(raw):
            return np.empty(0, np.uint64)
        parts = list(self.chunks(raw))
        return np.unique(np.concatenate([self._spans(part, len(parts) == 1) for part in parts]))

    def _together(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sets of texts that lie one after another, with a space put after each: a span's hash does not depend on where it starts."""
        raw = np.insert(raw, bounds[1:], 32)
        blank = self.space[raw]
        before = np.concatenate([[True], blank[:-1]])
        kept = ~blank | ~before
        place = np.cumsum(kept) - kept
        at = np.flatnonzero(~blank & before)
        starts, ends = place[at], place[blank & ~before]
        own = np.searchsorted(at, bounds + np.arange(len(bounds)))
        words = np.diff(own)
        sizes = np.where(words >= self.words, words - self.words + 1, words > 0)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        first = np.arange(cuts[-1]) + np.repeat(own[:-1] - cuts[:-1], sizes)
        last = np.minimum(first + self.words - 1, np.repeat(own[1:] - 1, sizes))
        n = int(kept.sum())
        self._grow(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.code[raw[kept]] * self.powers[:n], dtype=np.uint64)])
        begins = starts[first]
        shingles = _mixed((sums[ends[last]] - sums[begins]) * self.inverses[begins])
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            shingles[low:high].sort()
        new = np.ones(len(shingles), bool)
        new[1:] = shingles[1:] != shingles[:-1]
        new[cuts[:-1][sizes > 0]] = True
        return shingles[new], np.concatenate([[0], np.cumsum(new)])[cuts]

    def blocks(self, texts: pa.Array):
        """The sets of all ``texts`` in order, some texts at a time: their shingles one set after another, and the sets' bounds therein."""
        if not len(texts):
            return
        texts = texts.fill_null("").cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(texts):
            full = int(np.searchsorted(bounds, bounds[first] + BLOCK, "right")) - 1
            last = max(first + 1, min(full, first + BLOCK_TEXTS))
            part, own = raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
            if last == first + 1 and len(part) > CHUNK:
                shingles = self._whole(part)
                yield shingles, np.array([0, len(shingles)])
            else:
                yield self._together(part, own)
            first = last


def _totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def set_digests(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of every set, as signed 64-bit numbers."""
    a = _mixed(_totals(_mixed(shingles ^ np.uint64(0x9E3779B97F4A7C15)), bounds) + np.diff(bounds).astype(np.uint64))
    b = _mixed(_totals(_mixed(shingles + np.uint64(0xD1B54A32D192ED03)), bounds))
    return a.view(np.int64), b.view(np.int64)


def parities(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A bitmap of every set: whether an odd number of its members falls on each place.

    Two sets differ in at least as many members as their bitmaps in places.
    """
    n = len(bounds) - 1
    places = (shingles & np.uint64(BITMAP - 1)).astype(np.int64) + np.repeat(np.arange(n) * BITMAP, np.diff(bounds))
    return np.packbits((np.bincount(places, minlength=n * BITMAP) & 1).astype(np.uint8)).view(np.int64)


def describe(docs: DataFrame, words: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """One pass over the texts: per document (doc_id, n_shingles, set_id, digest, text_key, bits), and each task's part of the sketch (piece, counts)."""
    kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "n_shingles", "set_id", "digest", "text_key", "bits", "piece", "counts"]

    def work(batches):
        shingler, counts, held, size = Shingler(words, seed), np.zeros(1 << SKETCH_BITS, np.uint32), [], 0
        bitmap, ids = pa.list_(pa.int64()), None

        def add():
            counts[:] += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(counts)).astype(np.uint32)

        for batch in batches:
            ids, sizes, digests, bits = batch.column(0), [], [], []
            for shingles, bounds in shingler.blocks(batch.column(1)):
                sizes.append(np.diff(bounds))
                digests.append(set_digests(shingles, bounds))
                bits.append(parities(shingles, bounds))
                held.append((shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32))
                size += len(shingles)
                if size > 1 << 22:
                    add()
                    held, size = [], 0
            if not sizes:
                continue
            columns = [pa.array(np.concatenate(c), pa.int64()) for c in (sizes, *zip(*digests))]
            maps = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * (BITMAP // 64), pa.int32()), pa.array(np.concatenate(bits)))
            yield pa.RecordBatch.from_arrays(
                [ids, *columns, batch.column(2), maps.cast(bitmap), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], names)
        if ids is None:
            return
        if held:
            add()
        pieces = [(i, c) for i, c in enumerate(counts.reshape(-1, SKETCH_PART)) if c.any()]
        empty = pa.nulls(len(pieces), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(pieces), ids.type), empty, empty, empty, empty, pa.nulls(len(pieces), bitmap), pa.array([i for i, _ in pieces], pa.int32()),
             pa.array([zlib.compress(c.tobytes(), 1) for _, c in pieces], pa.binary())], names)

    fields = f"doc_id {kind.simpleString()}, n_shingles bigint, set_id bigint, digest bigint, text_key bigint, bits array<bigint>, piece int, counts binary"
    both = written(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(work, fields), "sets")
    return both.filter("piece IS NULL").drop("piece", "counts"), both.filter("piece IS NOT NULL").select("piece", "counts")


def sketch(counts: DataFrame) -> np.ndarray:
    """The corpus counts of all buckets: pieces add up in tasks as they stream by; the sum has one size, whatever the input."""

    def work(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, some in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(piece, np.zeros(SKETCH_PART, np.uint64))
                own += np.frombuffer(zlib.decompress(some.as_py()), np.uint32)
        for piece, own in sums.items():
            own = np.minimum(own, np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["piece", "counts"])

    total = np.zeros((1 << SKETCH_BITS) // SKETCH_PART * SKETCH_PART, np.uint32).reshape(-1, SKETCH_PART)
    for row in counts.repartition("piece").mapInArrow(work, "piece int, counts binary").toLocalIterator():
        total[row.piece] = np.frombuffer(bytes(row.counts), np.uint32)
    return total.ravel()


def postings(docs: DataFrame, words: int, seed: int, counts: np.ndarray) -> DataFrame:
    """The index: for the first shingles of every set in the corpus order, list (a shingle, or a part of its list), set_id and place.

    ``place`` packs the set's size, the shingle's position and the part, in 27, 26 and 10 bits. A set met again in one task is
    not indexed again.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def work(batches):
        shingler, often, met = Shingler(words, seed), shared.value, set()
        usual = int(often.mean())
        for batch in batches:
            lists, ids, places = [], [], []
            for shingles, bounds in shingler.blocks(batch.column(0)):
                set_ids, sizes = set_digests(shingles, bounds)[0], np.diff(bounds)
                count = often[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)
                ordered = count << RANK_BITS | np.arange(len(shingles)) - np.repeat(bounds[:-1], sizes)
                new = np.zeros(len(sizes), bool)
                for i, (low, high, set_id) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), set_ids.tolist())):
                    if low < high and set_id not in met:
                        met.add(set_id)
                        ordered[low:high].sort()
                        new[i] = True
                taken = np.where(new, sizes - (3 * sizes + 3) // 4 + 1, 0)
                begins, owner = np.repeat(bounds[:-1], taken), np.repeat(set_ids, taken)
                pos = np.arange(len(owner)) - np.repeat(np.cumsum(taken) - taken, taken)
                first = begins + (ordered[begins + pos] & (1 << RANK_BITS) - 1)
                split = np.minimum(1 + np.maximum(0, count[first] - 2 * usual) // SUBLIST, PARTS)
                part = np.where(split > 1, 1 + owner % split, 0)
                lists.append(shingles[first].view(np.int64) ^ part * PART_STEP)
                ids.append(owner)
                places.append(np.repeat(sizes, taken) << 36 | pos << 10 | part)
            if lists:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (lists, ids, places)], ["list", "set_id", "place"])

    return docs.select("text").mapInArrow(work, "list bigint, set_id bigint, place bigint")


def index_lists(index: DataFrame) -> DataFrame:
    """The lists that hold sets of like size: list, token, part, set_id, size, pos, pivot (pos, set_id, size).

    The pivot is the set with the fewest shingles rarer than the list's: in a family of edited copies that is the one nearest
    to the common original.

    In a whole list a set stays if the next smaller or larger is within the ratio that the likeness needs; parts stay whole.
    """
    size, part = F.expr("place >> 36"), F.expr("place & 1023")
    by_size = W.Window.partitionBy("list").orderBy("place")
    compared = index.select("list", "set_id", "place", F.lag("place").over(by_size).alias("below"), F.lead("place").over(by_size).alias("above"))
    meets = compared.filter("(place & 1023) > 0 OR 4 * (below >> 36) >= 3 * (place >> 36) OR 4 * (place >> 36) >= 3 * (above >> 36)")
    early = F.expr("(place >> 10) & 67108863").cast("int")
    pivot = F.min(F.struct(early.alias("pos"), "set_id", size.cast("int").alias("size"))).over(W.Window.partitionBy("list"))
    return meets.select("list", "set_id", "place", pivot.alias("pivot")).select(
        F.expr(f"list ^ ((place & 1023) * {PART_STEP})").alias("token"), part.cast("int").alias("part"), "set_id", size.cast("int").alias("size"),
        F.expr("(place >> 10) & 67108863").cast("int").alias("pos"), "pivot")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int, seed: int) -> DataFrame:
    """The sets (set_id, shingles) of the wanted texts (text_key), made again and dealt by id; few others are among them.

    A bitmap of the wanted texts' hashes, of one fixed size, goes to all tasks and holds back nearly all other texts, so that
    these are not cut into shingles once more.
    """
    place = F.shiftrightunsigned("text_key", 64 - FILTER_BITS)
    bits = wanted.select(F.shiftrightunsigned("text_key", 64 - FILTER_BITS + 6).cast("int").alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    words_ = np.zeros(1 << FILTER_BITS - 6, np.int64)
    words_[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(words_)

    def work(batches):
        shingler, known, met = Shingler(words, seed), shared.value.view(np.uint64), set()
        for batch in batches:
            at = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            asked = known[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
            for shingles, bounds in shingler.blocks(batch.column(0).filter(pa.array(asked.astype(bool)))):
                found = []
                for low, high, set_id in zip(bounds[:-1].tolist(), bounds[1:].tolist(), set_digests(shingles, bounds)[0].tolist()):
                    if low < high and set_id not in met:
                        met.add(set_id)
                        found.append((set_id, shingles[low:high].view(np.int64)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i for i, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))], ["set_id", "shingles"])

    made = docs.select("text", F.xxhash64("text").alias("text_key")).mapInArrow(work, "set_id bigint, shingles array<bigint>")
    return made.dropDuplicates(["set_id"])


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow the likeness: the overlap is at most half of both sizes less the differing places."""
    left, right = (classes.select(F.col("set_id").alias(c), F.col("bits").alias(f"bits_{c}"), F.col("size").alias(f"size_{c}")) for c in "ab")
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    met = pairs.join(left, "a").join(right, "b").withColumn("apart", apart)
    return met.filter("7 * (size_a + size_b - apart) >= 6 * (size_a + size_b)").select("a", "b")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Written ``pairs`` (a, b) with the sizes of both sets and of their intersection: size_a, size_b, shared.

    Both sides read the one shuffle that deals the sets by their ids. A set that is ``b`` for very many others goes out in
    several copies, so that those others need not meet in one task.
    """
    total = pairs.count()
    per_copy = max(total // HOT_SHARE, 1000)
    copies = pairs.groupBy("b").agg(F.count("*").alias("n")).withColumn("copies", F.ceil(F.col("n") / per_copy))
    dealt = attach_by_key(pairs.select("a", "b"), copies, "b", "n", total, F.xxhash64("a")).withColumn("slot", F.pmod(F.xxhash64("a"), F.col("copies")))
    left = dealt.drop("copies").join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("set_b")).join(copies.select("b", "copies"), "b")
    right = right.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    return left.join(right, ["b", "slot"]).select(
        "a", "b", F.size("set_a").alias("size_a"), F.size("set_b").alias("size_b"), F.size(F.array_intersect("set_a", "set_b")).alias("shared"))


LIKE = "7 * shared >= 3 * (size_a + size_b)"
"""4 * intersection >= 3 * union, by the sizes of the two sets."""


def star_pairs(lists: DataFrame) -> DataFrame:
    """For every set the pivot it meets in most lists: a (set), b (pivot). Parts of one list meet by their pivots."""
    fits = F.expr("4 * least(size, pivot.size) >= 3 * greatest(size, pivot.size)")
    met = lists.filter(F.col("set_id") != F.col("pivot.set_id")).filter(fits).select(F.col("set_id").alias("a"), F.col("pivot.set_id").alias("b"))
    heads = lists.filter("part > 0").select("token", "pivot").distinct()
    tops = heads.withColumn("top", F.min("pivot").over(W.Window.partitionBy("token"))).select(F.col("pivot.set_id").alias("a"), F.col("top.set_id").alias("b"))
    tops = tops.filter("a <> b")
    most = met.union(tops).groupBy("a", "b").agg(F.count("*").alias("n")).groupBy("a").agg(F.max(F.struct("n", "b")).alias("best"))
    return most.select("a", F.col("best.b").alias("b"))


def open_pairs(lists: DataFrame, star: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of different components that some list still leaves open: a, b, sure (linked by what is known already)."""
    known = star.select(F.col("a").alias("set_id"), F.col("b").alias("of"), "shared", F.col("size_b").alias("of_size"))
    root = roots.select(F.col("id").alias("set_id"), "root")
    facts = lists.select("set_id", "size").distinct().join(known, "set_id", "left").join(root, "set_id", "left").select(
        "set_id", F.coalesce("root", "set_id").alias("root"), F.coalesce("of", "set_id").alias("of"),
        F.coalesce("shared", "size").alias("shared"), F.coalesce("of_size", "size").alias("of_size"))
    entries = lists.select("token", "set_id", "size", "pos").join(written(facts, "facts"), "set_id")
    entries = written(entries.withColumn("rest", F.expr("size - pos")), "entries")
    several = written(entries.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token"), "tokens")
    entries = entries.join(several, "token").withColumn(
        "block", F.struct(F.floor(F.log(F.col("size")) * 8).cast("int").alias("s"), F.floor(16 * F.col("pos") / F.col("size")).cast("int").alias("p")))
    entries = written(entries, "entries")
    blocks = entries.groupBy("token", "block").agg(
        F.min("size").alias("least"), F.max("size").alias("most"), F.max("rest").alias("rest"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    a, b = (blocks.select("token", *[F.col(c).alias(f"{c}_{s}") for c in blocks.columns[1:]]) for s in "ab")
    met = a.join(b, "token").filter(
        "4 * most_a >= 3 * least_b AND 4 * most_b >= 3 * least_a AND 7 * least(rest_a, rest_b) >= 3 * (least_a + least_b) AND lo_a < hi_b")
    a, b = (entries.select("token", *[F.col(c).alias(f"{c}_{s}") for c in entries.columns if c != "token"]) for s in "ab")
    pairs = met.select("token", "block_a", "block_b").join(a, ["token", "block_a"]).join(b, ["token", "block_b"]).filter("""
        root_a < root_b AND 4 * least(size_a, size_b) >= 3 * greatest(size_a, size_b) AND 7 * least(rest_a, rest_b) >= 3 * (size_a + size_b)
        AND (of_a <> of_b OR 7 * (least(shared_a, shared_b) + least(size_a - shared_a, size_b - shared_b)) >= 3 * (size_a + size_b))""")
    sure = F.expr("of_a = of_b AND 7 * (shared_a + shared_b - of_size_a) >= 3 * (size_a + size_b)")
    return pairs.select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b"), "root_a", "root_b", sure.alias("sure")).distinct()


def classes_and_links(docs: DataFrame, words: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per document its set (doc_id, n_shingles, set_id); per set its documents (set_id, n, first_doc); per linked set (id, root)."""
    for seed in range(8):
        described, counts = describe(docs, words, seed)
        classes = described.filter("n_shingles > 0").groupBy("set_id").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.min("digest").alias("lo"), F.max("digest").alias("hi"),
            F.first("n_shingles").alias("size"), F.first("bits").alias("bits"), F.min("text_key").alias("text_key"))
        classes = written(classes, "classes")
        if classes.filter("lo <> hi").isEmpty():
            break
    else:
        raise RuntimeError("set digests clash for every seed")
    lists = written(index_lists(postings(docs, words, seed, sketch(counts))), "lists")
    pairs = written(promising(star_pairs(lists), classes), "star-pairs")
    star = written(overlaps(pairs, sets_of(docs, texts_of(pairs, classes), words, seed)), "star")
    roots = graph.components(star.filter(LIKE).select("a", "b"))
    still = written(open_pairs(lists, star, roots), "open-pairs")
    unsure = written(promising(still.filter("NOT sure").select("a", "b").distinct(), classes), "unsure-pairs")
    compared = overlaps(unsure, sets_of(docs, texts_of(unsure, classes), words, seed)).filter(LIKE).select("a", "b")
    links = star.filter(LIKE).select("a", "b").union(still.filter("sure").select("a", "b")).union(compared)
    return described, classes, graph.components(written(links, "links"))


def texts_of(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The text_key of one text of every set in the pairs."""
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    return ids.join(classes.select("set_id", "text_key"), "set_id").select("text_key")


def components(docs: DataFrame, words: int = 5) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the least doc_id reachable over links, its own included)."""
    described, classes, roots = classes_and_links(docs, words)
    rooted = classes.join(roots.withColumnRenamed("id", "set_id"), "set_id", "left").select(
        "set_id", "n", "first_doc", F.coalesce("root", "set_id").alias("root"))
    rooted = written(rooted, "rooted")
    per_root = written(rooted.groupBy("root").agg(F.count("*").alias("sets"), F.min("first_doc").alias("component_id")), "per-root")
    facts = attach_by_key(rooted.select("set_id", "n", "root"), per_root, "root", "sets", rooted.count(), F.xxhash64("set_id"))
    filled = described.filter("n_shingles > 0")
    known = attach_by_key(filled, facts.select("set_id", "n", "component_id"), "set_id", "n", described.count(), F.xxhash64("doc_id"))
    blank = described.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return known.select("doc_id", "n_shingles", "component_id").union(blank.select("doc_id", "n_shingles", "component_id"))
