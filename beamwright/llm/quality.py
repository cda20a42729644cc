"""Quality by the votes of labelled neighbours in a latent semantic space.

A text becomes counts of terms: its words, hashed, and how it is written (the shapes of its words and of neighbouring words, words
that repeat, its lines). Counts are damped by their root and weighted by how few sampled documents hold the term. The labelled
sample's weighted terms are decomposed; its vectors in the leading directions, at most ``sample`` of them, are broadcast. Every document is projected, its cosine with every labelled
vector is computed exactly, a block of documents against all of them at a time, and its ``k`` nearest vote with their
similarity as weight.

Defined results: a null text is the empty text; a text without terms gets the labelled mean, as does every text when no
label of a class is there; labels that are null count as no label; a document labelled more than once has the larger label;
a null doc_id is not held out and has no label. Repeated rows are documents each; an empty table gives an empty table. Labels,
lang, source and doc_id enter no score; other columns are not read.
"""

import re
from collections.abc import Iterable
from string import punctuation as PUNCTUATION
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.llm.common import held_out, labelled_sample, written

STYLE = 3080
"""Terms of style; hashed words follow them."""
WORDS = 4096
TERMS = STYLE + WORDS
WINDOW = 1 << 18
BLOCK = 512
WORD_WEIGHT = 0.5
"""Hashed words weigh so much beside terms of style: at 1 their sheer number hides how a text is written."""
CACHED_WORDS = 200_000
_CLASSES = [(re.compile(r"[a-zß-öø-ÿ]+"), "a"), (re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[0-9]+"), "0"), (re.compile(r"([^aA0])\1+"), r"\1+")]


class Terms:
    """Counts of a text's terms. The table of words met so far is bounded and only saves time."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def code(self, word: str) -> int:
        """The term of the word's shape (below 1009) and that of the word."""
        found = self.known.get(word)
        if found is None:
            text = word
            for pattern, letter in _CLASSES:
                text = pattern.sub(letter, text)
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            shape = (crc32(text.encode()) + 7 * min(len(word) // 8, 3)) % 1009
            found = self.known[word] = shape + 1009 * (crc32(word.lower().strip(PUNCTUATION).encode()) % WORDS)
        return found

    def windows(self, text: str) -> Iterable[str]:
        """Parts cut at white space; a part without any is taken as it is."""
        start = 0
        while len(text) - start > WINDOW:
            end = max(text.rfind(" ", start, start + WINDOW), text.rfind("\n", start, start + WINDOW)) + 1
            end = end or start + WINDOW
            yield text[start:end]
            start = end
        yield text[start:]

    def add(self, text: str | None, counts: np.ndarray) -> None:
        """Add the text's counts to a row of zeros."""
        tail, words = [], []
        for part in self.windows(text or ""):
            some = part.split()
            if not some:
                continue
            near = tail + some
            codes = np.fromiter(map(self.code, near), np.int64, len(near))
            shapes = codes % 1009
            same = np.fromiter(map(hash, near), np.int64, len(near))
            own = len(tail)
            counts[:1009] += np.bincount(shapes[own:], minlength=1009)
            counts[STYLE:] += np.bincount(codes[own:] // 1009, minlength=WORDS)
            pairs = (shapes[:-1] * 31 + shapes[1:])[max(own - 1, 0) :] % 2039
            counts[1024 : 1024 + 2039] += np.bincount(pairs, minlength=2039)
            for back in (1, 2):
                counts[3071 + back] += (same[back:] == same[:-back])[max(own - back, 0) :].sum()
            words.append(same[own:])
            tail = near[-2:]
        if words:
            words = np.concatenate(words)
            counts[3074], counts[3075] = len(words), len(words) - len(np.unique(words))
        lines = (text or "").split("\n")
        counts[3076], counts[3077] = len(lines), len(lines) - len(set(lines))


def matrix(terms: Terms, texts: list[str | None]) -> np.ndarray:
    rows = np.zeros((len(texts), TERMS), np.float32)
    for row, text in zip(rows, texts):
        terms.add(text, row)
    return np.sqrt(rows, out=rows)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def decompose(weighted: np.ndarray, dims: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular directions, by subspace iteration from a fixed start."""
    basis = np.random.default_rng(5).normal(size=(weighted.shape[1], min(dims, *weighted.shape))).astype(weighted.dtype)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    return basis


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 4096, dims: int = 32) -> dict:
    """The model: term weights, directions, the labelled vectors (``sample`` at most) and their labels."""
    texts = written(labelled_sample(docs, labels, label, sample), "quality-sample")

    def work(batches):
        terms = Terms()
        for batch in batches:
            for part in (batch.slice(at, BLOCK) for at in range(0, batch.num_rows, BLOCK)):
                rows = matrix(terms, part.column(0).to_pylist())
                at = [np.flatnonzero(r).astype(np.int32) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(at, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(rows, at)], pa.list_(pa.float32()))], ["label", "at", "value"])

    seen = texts.repartition(docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(work, "label int, at array<int>, value array<float>").toArrow()
    marks = seen.column("label").to_numpy().astype(float)
    if not len(marks):
        return {"weights": np.ones(TERMS, np.float32), "basis": np.zeros((TERMS, 1), np.float32), "vectors": np.zeros((0, 1)), "labels": marks, "mean": 0.5}
    at, value = seen.column("at").combine_chunks(), seen.column("value").combine_chunks()
    rows = np.zeros((len(marks), TERMS), np.float32)
    rows[np.repeat(np.arange(len(marks)), at.value_lengths().to_numpy()), at.flatten().to_numpy()] = value.flatten().to_numpy()
    weights = (0.1 + np.log(2 / ((rows > 0).mean(axis=0) + 1e-3))).astype(np.float32)
    weights[STYLE:] *= WORD_WEIGHT
    # in place: the sample's matrix is the largest thing the driver holds
    rows *= weights
    rows /= np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), np.float32(1e-12))[:, None]
    basis = decompose(rows, dims)
    return {"weights": weights, "basis": basis, "vectors": unit(rows @ basis), "labels": marks, "mean": float(marks.mean())}


def can_judge(model: dict) -> bool:
    """Whether there are labels of both classes; without, every score is one number and no filter should go by it."""
    return len(set(model["labels"].tolist())) > 1


def votes(model: dict, rows: np.ndarray, k: int = 15, power: float = 8.0) -> np.ndarray:
    """The mean label of the ``k`` nearest labelled vectors, weighted by a power of the cosine."""
    vectors, labels = model["vectors"], model["labels"]
    out = np.full(len(rows), model["mean"])
    k = min(k, len(labels))
    for start in range(0, len(rows) if k else 0, BLOCK):
        cosine = unit((rows[start : start + BLOCK] * model["weights"]) @ model["basis"]) @ vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** power
        total = weight.sum(axis=1)
        some = total > 0
        out[start : start + BLOCK][some] = (weight * labels[near]).sum(axis=1)[some] / total[some]
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: dict, threshold: float = 0.7) -> DataFrame:
    """``docs`` whole, under ``doc``, with held_out, score and predicted, by whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        terms, m = Terms(), shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                scores = votes(m, matrix(terms, part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc", "held_out", "score", "predicted"])

    source = docs.select(F.struct("*").alias("doc"), held_out(F.col("doc_id")).alias("held_out"), F.col("text"))
    return source.mapInArrow(work, f"doc {source.schema['doc'].dataType.simpleString()}, held_out boolean, score double, predicted int")
