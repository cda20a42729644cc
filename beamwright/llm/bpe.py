"""Byte-level BPE encoding and decoding.

The rank file becomes a ``tokenizers`` BPE model over the byte alphabet: each byte is one printable character, and every way
to split a vocabulary entry into two entries is a merge, ordered by the entry's rank. Texts are cut by the tokenizer's
pattern; each distinct piece of a run of texts is encoded once, in one batch call. Offsets come from the lengths of the
tokens' bytes. Decoding joins the bytes of all ids before it reads characters, so a character split over tokens is whole.

Defined results: a null text is the empty text; an empty text has no ids and decodes to no bytes; repeated rows give
repeated rows; an empty table gives an empty table; of the input only the named columns are read, so other columns cannot
clash. Texts of any length are worked through in windows cut where the pattern cuts for certain.
"""

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.llm.common import give_back

WINDOW = 1 << 18
CACHED_PIECES = 300_000
CACHED_LENGTH = 48
PART = 128
"""Rows whose ids are held at a time."""
# White space as the pattern's library defines it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes by the ranks of one file and the pattern that splits texts."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, models

        ranks = read_ranks(path)
        alphabet = byte_alphabet()
        self.letters = dict(enumerate(alphabet))
        self.bytes_of_letter = {c: b for b, c in enumerate(alphabet)}
        name = {token: "".join(map(alphabet.__getitem__, token)) for token in ranks}
        merges = sorted(
            (rank, ranks[token[:i]], ranks[token[i:]], name[token[:i]], name[token[i:]])
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks)
        model = models.BPE({name[t]: r for t, r in ranks.items()}, [m[3:] for m in merges], ignore_merges=True, cache_capacity=0)
        self.model = Tokenizer(model)
        vocab = sorted((r, name[t]) for t, r in ranks.items())
        self.token_bytes = {r: bytes(map(self.bytes_of_letter.__getitem__, t)) for r, t in vocab}
        self.digits = {r: str(r) for r in self.token_bytes}
        pattern = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"(?!\S)", f"(?![^{SPACE}])").replace(r"\s", f"[{SPACE}]")
        self.pattern = regex.compile(pattern)
        self.safe_cut = regex.compile(f"[^{SPACE}](?= [^{SPACE}])")
        self.seen: dict[str, tuple[int, ...]] = {}

    def windows(self, text: str):
        """Parts of a text, cut before a lone space between two other characters: the pattern always cuts there."""
        start = 0
        while len(text) - start > WINDOW:
            cut = self.safe_cut.search(text, start + WINDOW)
            if cut is None:
                break
            yield text[start : cut.end()]
            start = cut.end()
        yield text[start:]

    def encode_pieces(self, pieces: list[list[str]]) -> list[list[int]]:
        """Ids of each list of pieces; pieces not met before are encoded together."""
        if len(self.seen) > CACHED_PIECES:
            self.seen.clear()
        new = list({p for some in pieces for p in some}.difference(self.seen))
        mapped = [p.encode().decode("latin-1").translate(self.letters) for p in new]
        ids = {p: tuple(e.ids) for p, e in zip(new, self.model.encode_batch_fast(mapped, add_special_tokens=False))}
        self.seen.update(ids)
        out = [list(chain.from_iterable(map(self.seen.__getitem__, some))) for some in pieces]
        for p in new:
            if len(p) > CACHED_LENGTH:
                del self.seen[p]
        return out

    def encode(self, texts: list[str]):
        """Yields (index of the text, ids of its next window), texts in order, windows in order."""
        run, size = [], 0
        for i, text in enumerate(texts):
            for window in self.windows(text):
                run.append((i, self.pattern.findall(window)))
                size += len(window)
                if size >= WINDOW:
                    yield from zip([k for k, _ in run], self.encode_pieces([p for _, p in run]))
                    run, size = [], 0
        yield from zip([k for k, _ in run], self.encode_pieces([p for _, p in run]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def char_offsets(codec_: Codec, ids: list[int], text: str) -> np.ndarray:
    """The character in which each token's first byte lies."""
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    lengths = np.fromiter((len(codec_.token_bytes[i]) for i in ids), np.int64, len(ids))
    return character[np.cumsum(lengths) - lengths] if len(ids) else np.empty(0, np.int64)


def _batches(column: pa.Array):
    return [t or "" for t in column.to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` as it is, under ``doc``, with ``ids`` and the characters where the tokens start, ``starts``.

    With ``decoded`` the ids are decoded again in the same task, which then needs the vocabulary once only.
    """

    def work(batches):
        c = codec(path, pattern)
        for batch in batches:
            for part in (batch.slice(at, PART) for at in range(0, batch.num_rows, PART)):
                texts = _batches(part.column(1))
                ids: list[list[int]] = [[] for _ in texts]
                for i, some in c.encode(texts):
                    ids[i] += some
                starts = [char_offsets(c, k, t) for k, t in zip(ids, texts)]
                columns = [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64()))]
                if decoded:
                    columns.append(pa.array([c.decode(k).decode("utf-8", "replace") for k in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)
        c.seen.clear()
        give_back()

    names = ["doc", "ids", "starts", *(["decoded"] if decoded else [])]
    source = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"))
    row = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(work, f"doc {row}, ids array<int>, starts array<bigint>" + (", decoded string" if decoded else ""))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text its ids stand for (bytes that are no character become U+FFFD)."""

    def work(batches):
        c = codec(path, pattern)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            texts = [c.decode(k or []).decode("utf-8", "replace") for k in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(work, f"{fields}, decoded string")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids again, and return counts and digests only: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids and decoded bytes are digested window by window, so memory does not grow with a text.
    """

    def work(batches):
        c = codec(path, pattern)
        for batch in batches:
            texts = _batches(batch.column(1))
            counts = [0] * len(texts)
            id_digests = [hashlib.sha256() for _ in texts]
            byte_digests = [hashlib.sha256() for _ in texts]
            for i, ids in c.encode(texts):
                if ids:
                    id_digests[i].update((b"," if counts[i] else b"") + ",".join(map(c.digits.__getitem__, ids)).encode())
                    byte_digests[i].update(c.decode(ids))
                    counts[i] += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array([d.hexdigest() for d in id_digests]),
                 pa.array([d.hexdigest() for d in byte_digests])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
