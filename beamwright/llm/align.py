"""Which tokens of two tokenizers cover the same bytes, for every document, with corpus-wide link counts.

Both tokenizers read the same bytes of a text, a space before it. Where tokens of both end, the text is cut into groups; every
stretch between neighbouring ends belongs to one token of each side and is one link. The links go into an inverted index: a task
gathers whole documents with ``LINKS`` links or a little more to a block, and for each pair of ids the block has the bitmap of its documents,
one plane per bit of how often the document holds the pair (gaps between set bits, a byte each). The union of the planes says in how
many documents a pair occurs, the planes' set bits times their weight how many links it has; documents lie in one block only, so
both add up over blocks. Only those sums are shuffled by pair. They come back to the blocks, whose postings add them up per document.

Defined results: texts that are null, empty, or whose tokens do not spell the space and the text in bytes (such as texts with U+2581)
have no tokens and get zeros and no groups. A document is one row: repeated rows, and rows without doc_id, each get a result and
each count towards the pairs. An empty table gives an empty table. Only doc_id and the text are read, so other columns cannot
clash. A task holds one block and a run of documents, or one longer document.
"""

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.llm.bpe import SPACE
from beamwright.llm.common import written

LINKS = 1 << 21
BLOCK_DOCUMENTS = (1 << 16) - 1
RUN = 1 << 19
"""Characters whose tokens are laid out at a time."""
CACHED_UNITS = 300_000
CACHED_LINKS = 1 << 22
CACHED_LENGTH = 48
WORD_MARK = "▁"


class ByteLevel:
    """The byte-level tokenizer of a ``tokenizers`` file; its pattern begins a piece at every lone space between two other characters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores already
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocab = self.model.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token)  # one character a byte

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text after a space."""
        return [e.ids for e in self.model.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]


class WordPieces:
    """A piece tokenizer that puts a space before the text and has no piece with a space after another character.

    Its texts can then be cut before a space that follows another character; a model for which this does not hold is refused.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(WORD_MARK in p.lstrip(WORD_MARK) for p in pieces) or "".join(self.model.encode("a  b ", out_type=str)) != "▁a▁▁b▁":
            raise ValueError("the model joins words or drops spaces: its texts cannot be cut into words")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(WORD_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text after a space; none for texts that they do not spell."""
        some = self.model.encode(texts, num_threads=1) if texts else []
        return [ids if b"".join(map(self.bytes.__getitem__, ids)) == b" " + t.encode() else [] for ids, t in zip(some, texts)]


def lay_out(a, b, texts: list[str]):
    """(ids, ends in bytes, tokens per text) of both sides for texts laid end to end, each after a space, and the texts' own ends.

    A text whose tokens do not spell it is laid out as no bytes.
    """
    ids_b = b.encode(texts)
    ids_a = [ids if spelt else [] for ids, spelt in zip(a.encode(texts), ids_b)]
    n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
    flat_a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(n_a.sum()))
    flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
    sizes = np.array([len(t.encode()) + 1 if ids else 0 for t, ids in zip(texts, ids_b)], np.int64)
    end_a, end_b, end = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b]), np.cumsum(sizes)
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    if (np.append(0, end_a)[last_a] != end).any() or (np.append(0, end_b)[last_b] != end).any():
        raise ValueError("a tokenizer's tokens do not add up to its text")
    return flat_a, end_a, n_a, flat_b, end_b, n_b, end


def aligned(a, b, table, texts: list[str]):
    """Per text: counts, the groups as text; and for all links of the texts laid end to end: id pair and text number."""
    flat_a, end_a, n_a, flat_b, end_b, n_b, end = lay_out(a, b, texts)
    marks = np.zeros(int(end[-1]) + 1 if len(end) else 1, np.uint8)
    marks[end_a] |= 1
    marks[end_b] |= 2
    at = np.flatnonzero(marks)
    both = marks[at] == 3
    cuts = at[both]
    of_a, of_b = np.searchsorted(end_a, at, "left"), np.searchsorted(end_b, at, "left")
    pairs = flat_a[of_a] * len(b.lengths) + flat_b[of_b]
    links_to, groups_to = np.searchsorted(at, end, "right"), np.searchsorted(cuts, end, "right")
    n_links, n_groups = np.diff(links_to, prepend=0), np.diff(groups_to, prepend=0)
    text_of = np.repeat(np.arange(len(texts)), n_links)
    # groups as text: a group's tokens of one side, then of the other
    a_to, b_to = np.append(0, np.searchsorted(end_a, cuts, "right")), np.append(0, np.searchsorted(end_b, cuts, "right"))
    sep_a, sep_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
    sep_a[a_to[1:] - 1] = 1
    sep_b[b_to[1:] - 1] = 1
    sep_b[np.cumsum(n_b)[n_b > 0] - 1] = 2
    slots = np.empty(len(flat_a) + len(flat_b), np.int64)
    slots[np.arange(len(flat_a)) + np.repeat(b_to[:-1], np.diff(a_to))] = 2 * flat_a + sep_a
    slots[np.arange(len(flat_b)) + np.repeat(a_to[1:], np.diff(b_to))] = 2 * len(a.lengths) + 3 * flat_b + sep_b
    parts = iter(table[slots].tobytes().translate(None, b"\0").split(b"\n"))
    groups = [next(parts) if n else b"" for n in n_b.tolist()]
    return n_a, n_b, n_groups, n_links, groups, pairs, text_of


class Units:
    """Texts cut before lone spaces between two other characters, where both tokenizers always begin a token: what lies between is aligned once."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), WordPieces(b_path)
        separators = [(len(self.a.lengths), (",", "|")), (len(self.b.lengths), (",", ";", "\n"))]
        self.table = np.array([f"{i}{s}" for n, some in separators for i in range(n) for s in some], "S")
        self.lone_space = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = np.zeros((0, 4), np.int64)
        self.starts, self.pairs, self.groups = np.zeros(1, np.int64), np.zeros(0, np.int64), []

    def cut(self, text: str) -> list[str]:
        """Units of the text, each without the space before it."""
        units = text.split(" ")
        return units if "" not in units and list(map(str.strip, units)) == units else self.lone_space.split(text)

    def learn(self, units: list[str]) -> None:
        *counts, groups, pairs, _ = aligned(self.a, self.b, self.table, units)
        self.number.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.counts = np.concatenate([self.counts, np.stack(counts, 1)])
        self.starts = np.append(0, np.cumsum(self.counts[:, 3]))
        self.pairs = np.concatenate([self.pairs, pairs])
        self.groups += groups

    def align(self, texts: list[str]):
        """As ``aligned``, with each unit looked up."""
        if len(self.groups) > CACHED_UNITS or len(self.pairs) > CACHED_LINKS:
            self.forget()
        cut = [self.cut(t) if t else [] for t in texts]
        new = list({u for some in cut for u in some}.difference(self.number))
        if new:
            self.learn(new)
        n = np.array([len(c) for c in cut], np.int64)
        unit = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(n.sum()))
        for u in new:
            if len(u) > CACHED_LENGTH:
                del self.number[u]
        ends = np.cumsum(n)
        unspelt = np.append(0, np.cumsum(self.counts[unit, 1] == 0))
        spelt = unspelt[ends] == unspelt[ends - n]  # one unit that is not spelt leaves its text without tokens
        groups = [b";".join(map(self.groups.__getitem__, unit[e - k : e].tolist())) if ok else b"" for e, k, ok in zip(ends.tolist(), n.tolist(), spelt)]
        unit, n = unit[np.repeat(spelt, n)], np.where(spelt, n, 0)
        ends = np.cumsum(n)
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.counts[unit], 0)])
        counts = sums[ends] - sums[ends - n]
        links = self.counts[unit, 3]
        at = np.repeat(self.starts[unit] - (np.cumsum(links) - links), links) + np.arange(links.sum())
        return *counts.T, groups, self.pairs[at], np.repeat(np.arange(len(texts)), counts[:, 3])


@lru_cache(maxsize=2)
def units(a_path: str, b_path: str) -> Units:
    return Units(a_path, b_path)


def to_gaps(ordinals: np.ndarray, starts: np.ndarray) -> bytes:
    """Set bits of bitmaps laid one after another as gaps, a byte each; 255 stands for 255 unset bits and is followed by more."""
    gaps = np.diff(ordinals, prepend=0)
    gaps[starts] = ordinals[starts]
    out = np.full(int((gaps // 255 + 1).sum()), 255, np.uint8)
    out[np.cumsum(gaps // 255 + 1) - 1] = gaps % 255
    return out.tobytes()


def from_gaps(gaps: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap number, bit) of every set bit, given how many bits each bitmap has."""
    raw = np.frombuffer(gaps, np.uint8)
    reached = np.cumsum(raw, dtype=np.int64)[raw != 255]
    firsts = np.cumsum(sizes) - sizes
    before = np.append(0, reached)[firsts]
    number = np.repeat(np.arange(len(sizes)), sizes)
    return number, reached - before[number]


def postings(pairs: np.ndarray, ordinals: np.ndarray):
    """The index of one block: distinct pairs, how many documents and links each has, and the planes of their bitmaps."""
    keys, times = np.unique(pairs << 16 | ordinals, return_counts=True)
    pair, ordinal = keys >> 16, keys & 0xFFFF
    starts = np.flatnonzero(np.diff(pair, prepend=-1))
    planes = []
    for bit in range(int(times.max()).bit_length()):
        here = (times >> bit) & 1 == 1
        sizes = np.add.reduceat(here.astype(np.int64), starts)
        firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
        planes.append({"gaps": to_gaps(ordinal[here], firsts), "sizes": sizes.astype(np.uint16).tobytes()})
    return pair[starts], np.diff(np.append(starts, len(keys))), np.add.reduceat(times, starts), planes


def index_rows(docs: DataFrame, a_path: str, b_path: str, text: str = "text", groups: bool = False) -> DataFrame:
    """Rows of two kinds: one per document (``ordinal`` is set; ``groups`` has its groups as text, if asked for), one per block of the
    inverted index (``pairs`` is set)."""
    source = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (f"block bigint, ordinal int, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
              "pairs array<bigint>, docs array<bigint>, links array<bigint>, planes array<struct<gaps:binary,sizes:binary>>")
    names = [field.split()[0] for field in schema.split(", ")]

    def work(batches):
        known = units(a_path, b_path)
        types = {}
        block, gathered, n_docs, n_links = TaskContext.get().partitionId() << 32, [], 0, 0

        def rows(n, **columns):
            columns = {c: columns[c] if c in columns else pa.nulls(n, types[c]) for c in names}
            return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, types[c]) for c, v in columns.items()], names)

        def index():
            pairs, n, links, planes = postings(*map(np.concatenate, zip(*gathered)))
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))
            return rows(1, block=[block], pairs=one(pairs), docs=one(n), links=one(links), planes=[planes])

        for batch in batches:
            types = types or dict(zip(names, [
                pa.int64(), pa.int32(), batch.schema.field(0).type, *[pa.int64()] * 4, *[pa.string()] * 2, *[pa.list_(pa.int64())] * 3,
                pa.list_(pa.struct([("gaps", pa.binary()), ("sizes", pa.binary())]))]))
            texts = batch.column(1).to_pylist()
            run = np.cumsum([len(t) for t in texts]) // RUN
            cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
            for start, stop in zip(cuts, cuts[1:]):
                if n_links >= LINKS or n_docs + stop - start > BLOCK_DOCUMENTS:
                    if n_links:
                        yield index()
                    block, gathered, n_docs, n_links = block + 1, [], 0, 0
                n_a, n_b, n_groups, links, listed, pairs, text_of = known.align(texts[start:stop])
                yield rows(
                    stop - start, block=np.full(stop - start, block), ordinal=np.arange(n_docs, n_docs + stop - start), doc_id=batch.column(0).slice(start, stop - start),
                    n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=links, groups_sha256=[hashlib.sha256(g).hexdigest() if g else "" for g in listed],
                    **({"groups": [g.decode() for g in listed]} if groups else {}))
                gathered.append((pairs, text_of + n_docs))
                n_docs, n_links = n_docs + stop - start, n_links + len(pairs)
        if n_links:
            yield index()

    return source.mapInArrow(work, schema)


def pair_counts(index: DataFrame) -> DataFrame:
    """Per id pair its code (``pair``), in how many documents it is linked, and its links, from the bitmaps' sums: pair, docs, links."""
    rows = index.filter("pairs is not null").select(F.inline(F.arrays_zip("pairs", "docs", "links")))
    return rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def document_scores(index: DataFrame, n_b: int) -> DataFrame:
    """Per document (block, ordinal) the links whose pair no other pair of its second id exceeds, ``n_best``, and the sum of counts over its links.

    ``n_b`` is the size of the second vocabulary, and so the most rows that are broadcast.
    """
    counts = pair_counts(index).withColumn("b", F.col("pair") % n_b)
    top = F.broadcast(counts.groupBy("b").agg(F.max("links").alias("top")))
    scored = counts.join(top, "b").select("pair", (F.col("links") * 2 + (F.col("links") == F.col("top")).cast("long")).alias("score"))
    blocks = index.filter("pairs is not null")
    asked = blocks.select(F.col("block").alias("asked_by"), F.explode("pairs").alias("pair")).join(scored, "pair")

    def add_up(block: pa.Table, scores: pa.Table) -> pa.Table:
        pairs = block.column("pairs")[0].values.to_numpy()
        score = np.empty(len(pairs), np.int64)
        score[np.searchsorted(pairs, scores.column("pair").to_numpy())] = scores.column("score").to_numpy()
        best, total = np.zeros(BLOCK_DOCUMENTS, np.int64), np.zeros(BLOCK_DOCUMENTS, np.int64)
        for bit, plane in enumerate(block.column("planes")[0].as_py()):
            pair, ordinal = from_gaps(plane["gaps"], np.frombuffer(plane["sizes"], np.uint16).astype(np.int64))
            np.add.at(best, ordinal, (score[pair] & 1) << bit)
            np.add.at(total, ordinal, (score[pair] >> 1) << bit)
        some = np.flatnonzero(total)
        return pa.table({"block": pa.array(np.full(len(some), block.column("block")[0].as_py())), "ordinal": pa.array(some, pa.int32()),
                         "n_best": best[some], "count_sum": total[some]})

    groups = blocks.select("block", "pairs", "planes").groupBy("block").cogroup(asked.groupBy("asked_by"))
    return groups.applyInArrow(add_up, "block bigint, ordinal int, n_best bigint, count_sum bigint")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_a and n_b (tokens), n_groups, n_links, groups_sha256 (of `a,a|b;a|b,b`; empty without tokens), groups if asked
    for, n_best (links whose pair has the most links of all pairs of its second id, ties included) and count_sum (pairs' links over the links)."""
    from sentencepiece import SentencePieceProcessor

    index = written(index_rows(docs, a_path, b_path, text, groups), "pair-index")
    scores = document_scores(index, SentencePieceProcessor(model_file=b_path).vocab_size())
    rows = index.filter("ordinal is not null").join(scores, ["block", "ordinal"], "left")
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
                       "groups_sha256", *(["groups"] if groups else []))
