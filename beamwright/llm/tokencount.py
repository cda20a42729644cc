"""Token counts that follow edits.

A document is kept as a tree of segments: runs of pre-tokens with their characters and tokens, and their sums above. Segments
begin only where the pattern cuts whatever else the text holds: before a lone white-space character between two others.
An edit re-encodes the segments it touches, the characters around it that decide the cuts at their ends included, and
renews the sums on the way up; the rest keeps its counts. The result equals a count of the whole edited text.

Defined results: a null text is the empty text with no tokens; edits apply one after the other to the text so far, their bounds
are drawn into it, and a null replacement is empty; a document without edits keeps its counts; a text without a place to cut is
one segment. Repeated rows are documents each; an empty table gives an empty table. Other columns pass through.

``stored`` makes the trees a table: a text with the characters and tokens of its segments. ``apply_edits`` takes such a table and gives
the next one; it encodes nothing but what the edits touch, and documents without edits pass by without leaving the JVM.
"""

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.llm.bpe import SPACE, read_ranks

SEGMENT = 512
CUT = re.compile(f"[^{SPACE}](?=[{SPACE}][^{SPACE}])")
CONTEXT = 2
"""A cut depends on the character before it and the two after it."""


class Node:
    """A segment (with its text) or the sums of two nodes."""

    __slots__ = ("chars", "tokens", "text", "left", "right")

    def __init__(self, chars: int, tokens: int, text: str | None = None, left: "Node | None" = None, right: "Node | None" = None):
        self.chars, self.tokens, self.text, self.left, self.right = chars, tokens, text, left, right


def joined(left: Node | None, right: Node | None) -> Node | None:
    if left is None or right is None:
        return left or right
    return Node(left.chars + right.chars, left.tokens + right.tokens, None, left, right)


def balanced(segments: list[Node]) -> Node | None:
    """Segments under a tree of least depth."""
    while len(segments) > 1:
        segments = [joined(*segments[i : i + 2]) if i + 1 < len(segments) else segments[i] for i in range(0, len(segments), 2)]
    return segments[0] if segments else None


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


class Counter:
    def __init__(self, path: str, pattern: str, segment: int = SEGMENT):
        self.encoding, self.segment, self.encoded = _encoding(path, pattern), segment, 0

    def build(self, text: str) -> Node | None:
        """The tree of a text; ``encoded`` grows by the characters it had to encode."""
        segments, start = [], 0
        while start < len(text):
            cut = CUT.search(text, start + self.segment - 1)
            end = cut.end() if cut else len(text)
            segments.append(Node(end - start, len(self.encoding.encode_ordinary(text[start:end])), text[start:end]))
            start = end
        self.encoded += len(text)
        return balanced(segments)

    def _around(self, node: Node, low: int, high: int):
        """What lies left of the segments that overlap [low, high), their text, and what lies right of them."""
        if node.text is not None:
            return None, node.text, None
        middle = node.left.chars
        if high <= middle:
            before, text, after = self._around(node.left, low, high)
            return before, text, joined(after, node.right)
        if low >= middle:
            before, text, after = self._around(node.right, low - middle, high - middle)
            return joined(node.left, before), text, after
        before, first, _ = self._around(node.left, low, middle)
        _, second, after = self._around(node.right, 0, high - middle)
        return before, first + second, after

    def edit(self, tree: Node | None, start: int, end: int, replacement: str) -> Node | None:
        """The tree after characters [start, end) became ``replacement``."""
        total = tree.chars if tree else 0
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        if tree is None:
            return self.build(replacement)
        low, high = max(start - CONTEXT, 0), min(end + CONTEXT, total)
        before, text, after = self._around(tree, low, max(high, low + 1))
        offset = start - (before.chars if before else 0)
        changed = text[:offset] + replacement + text[offset + end - start :]
        return joined(joined(before, self.build(changed)), after)


def segments(node: Node | None):
    """The segments of a tree in the order of the text."""
    stack = [node] if node else []
    while stack:
        node = stack.pop()
        if node.text is not None:
            yield node
        else:
            stack += [node.right, node.left]


def _recounted(batch, texts: int, path: str, pattern: str):
    """(tokens before, tree after, characters re-encoded) for each text of a batch and the edits beside it."""
    for text, changes in zip(batch.column(texts), batch.column(texts + 1)):
        counter = Counter(path, pattern)
        tree = counter.build(text.as_py() or "")
        before, counter.encoded = tree.tokens if tree else 0, 0
        for change in changes.as_py() or []:
            tree = counter.edit(tree, change["start"], change["end"], change["replacement"] or "")
        yield before, tree, counter.encoded


def recount(docs: DataFrame, path: str, pattern: str, text: str = "text", edits: str = "edits", whole: bool = True) -> DataFrame:
    """``docs`` whole, under ``doc``, counted before and after its ``edits`` (an array of start, end, replacement).

    Adds n_tokens, n_tokens_edited, n_chars_reencoded and edited_sha256, and, if ``whole``, edited_text and the leaves of its
    tree, segment_tokens.
    """
    names = ["n_tokens", "n_tokens_edited", "n_chars_reencoded", "edited_sha256", *(["edited_text", "segment_tokens"] if whole else [])]
    arrow = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]

    def work(batches):
        for batch in batches:
            out = []
            for before, tree, encoded in _recounted(batch, 1, path, pattern):
                digest, parts = hashlib.sha256(), []
                for part in segments(tree):
                    digest.update(part.text.encode())
                    parts += [part] if whole else []
                row = (before, tree.tokens if tree else 0, encoded, digest.hexdigest())
                out.append((*row, "".join(p.text for p in parts), [p.tokens for p in parts]) if whole else row)
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, arrow)]], ["doc", *names])

    source = docs.select(F.struct(*[c for c in docs.columns if whole or c not in (text, edits)]).alias("doc"), F.col(text).alias("text"), F.col(edits).alias("edits"))
    kinds = ["bigint", "bigint", "bigint", "string", "string", "array<int>"]
    fields = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return source.mapInArrow(work, f"doc {source.schema['doc'].dataType.simpleString()}, {fields}")


LENGTHS = pa.list_(pa.int32())
STORE = "text string, segment_chars array<int>, segment_tokens array<int>, n_tokens bigint"


def _row(tree: Node | None):
    """A tree as its text and the leaves' characters and tokens."""
    leaves = list(segments(tree))
    return "".join(n.text for n in leaves), [n.chars for n in leaves], [n.tokens for n in leaves], tree.tokens if tree else 0


def _tree(text: str, chars: list, tokens: list) -> Node | None:
    """The tree of a stored row; nothing is encoded."""
    leaves, start = [], 0
    for length, count in zip(chars, tokens):
        leaves.append(Node(length, count, text[start : start + length]))
        start += length
    return balanced(leaves)


def _with_trees(rows: DataFrame, work, more: list) -> DataFrame:
    """``work(batch)`` yields, for each row of a batch, the stored row of its tree and the ``more`` numbers."""
    names = [*(f.split()[0] for f in STORE.split(", ")), *more]
    kinds = [pa.string(), LENGTHS, LENGTHS, pa.int64(), *[pa.int64()] * len(more)]

    def each(batches):
        for batch in batches:
            columns = list(zip(*work(batch))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc", *names])

    numbers = "".join(f", {n} bigint" for n in more)
    return rows.mapInArrow(each, f"doc {rows.schema['doc'].dataType.simpleString()}, {STORE}{numbers}")


def stored(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The segment trees of ``docs``, to be written: other columns under ``doc``, text, segment_chars, segment_tokens and n_tokens.

    The only place where whole texts are encoded. A null text is stored as the empty one, without segments.
    """

    def work(batch):
        counter = Counter(path, pattern)
        for value in batch.column(1):
            yield _row(counter.build(value.as_py() or ""))

    # an empty struct has no Arrow form, so a row number stands in where the text is the only column
    others = [c for c in docs.columns if c != text]
    doc = F.struct(*others) if others else F.struct(F.monotonically_increasing_id().alias("row"))
    return _with_trees(docs.select(doc.alias("doc"), F.col(text).alias("text")), work, [])


def apply_edits(store: DataFrame, edits: Column, path: str, pattern: str) -> DataFrame:
    """The store after ``edits`` (an array of start, end, replacement; null or empty: none), with n_tokens_before and n_chars_reencoded.

    Only documents with edits are read into trees; their sums follow from the touched segments.
    """
    held = ("doc", "text", "segment_chars", "segment_tokens", "n_tokens")
    rows = store.select(*held, edits.alias("edits"))
    touched = F.coalesce(F.size("edits") > 0, F.lit(False))

    def work(batch):
        counter = Counter(path, pattern)
        for text, chars, tokens, before, changes in zip(*[batch.column(i) for i in range(1, 6)]):
            tree, counter.encoded = _tree(text.as_py(), chars.as_py(), tokens.as_py()), 0
            for change in changes.as_py():
                tree = counter.edit(tree, change["start"], change["end"], change["replacement"] or "")
            yield *_row(tree), before.as_py(), counter.encoded

    changed = _with_trees(rows.filter(touched), work, ["n_tokens_before", "n_chars_reencoded"])
    same = rows.filter(~touched).select(*held, F.col("n_tokens").alias("n_tokens_before"), F.lit(0).cast("bigint").alias("n_chars_reencoded"))
    return changed.unionByName(same)
