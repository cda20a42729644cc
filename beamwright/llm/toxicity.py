"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram (3 to 5 bytes of the lower-case text, spaces included), hashed. From a bounded sample of
labelled texts come the document counts per class; the ``features`` that tell the classes apart best are kept, each with
the log ratio of its smoothed rates as value. A logistic regression over these values gives the weights.

Defined results: a null text is the empty text, and a text without any kept n-gram has the score of the intercept; labels
that are null count as no label; a document labelled more than once has the larger label; a null doc_id is not held out
and has no label; without labels of both classes every score is the smoothed rate of the labels there are. Repeated rows are
documents each; an empty table gives an empty table. Labels, lang, source and doc_id enter no score; other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.llm.common import held_out, labelled_sample, written

LENGTHS = (3, 4, 5)
BITS = 20
WINDOW = 1 << 20
LEAST_DOCS = 3


def grams(text: str | None):
    """Hashed n-grams, a part of the text at a time; the parts overlap, so none is lost."""
    raw = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode(), np.uint8)
    for start in range(0, max(len(raw) - LENGTHS[-1] + 1, 1), WINDOW):
        part = raw[start : start + WINDOW + LENGTHS[-1] - 1].astype(np.uint64)
        packed, out = part, []
        for n in range(2, LENGTHS[-1] + 1):
            packed = packed[:-1] | (part[n - 1 :] << np.uint64(8 * n - 8))
            if n in LENGTHS:
                out.append((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
        yield np.concatenate(out).astype(np.int64)


def present(text: str | None, kept: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashed n-grams; with ``kept`` (number of the feature + 1 per hash) the numbers of the kept ones."""
    parts = []
    for part in grams(text):
        if kept is not None:
            part = kept[part]
            part = part[part > 0].astype(np.int64) - 1
        parts.append(np.unique(part))
    return np.unique(np.concatenate(parts))


def _class_counts(sample: DataFrame) -> DataFrame:
    def work(batches):
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[label, present(text.as_py())] += 1
        used = np.flatnonzero(counts.any(axis=0))
        for some in (used[i : i + 65536] for i in range(0, len(used), 65536)):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0, some]), pa.array(counts[1, some])], ["hash", "neg", "pos"])

    return sample.mapInArrow(work, "hash int, neg bigint, pos bigint").groupBy("hash").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))


def logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, n_columns: int, penalty: float = 1.0, steps: int = 200):
    """Weights and intercept of a logistic regression on sparse rows, by Adam over all rows."""
    rate = (labels.sum() + 1) / (len(labels) + 2)
    theta = np.append(np.zeros(n_columns), np.log(rate / (1 - rate)))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    cell = values[columns]
    for step in range(1, steps + 1):
        logit = np.bincount(rows, theta[columns] * cell, len(labels)) + theta[-1]
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels
        slope = np.append(np.bincount(columns, error[rows] * cell, n_columns) + penalty * theta[:-1], error.sum()) / len(labels)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], theta[-1]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 16_000, features: int = 2048) -> dict:
    """The model: ``hashes`` of the kept n-grams, ``weights`` (regression weight times log-count ratio) and ``intercept``.

    At most ``sample`` labelled texts and ``features`` n-grams take part, whatever the size of the tables.
    """
    texts = written(labelled_sample(docs, labels, label, sample), "toxic-sample")
    n = dict(texts.groupBy("label").count().collect())
    neg, pos = n.get(0, 0), n.get(1, 0)
    if not neg or not pos:
        rate = (pos + 1) / (neg + pos + 2)
        return {"hashes": np.empty(0, np.int64), "weights": np.empty(0), "intercept": float(np.log(rate / (1 - rate)))}
    spread = texts.repartition(docs.sparkSession.sparkContext.defaultParallelism)
    gap = F.col("pos") / pos - F.col("neg") / neg
    counts = _class_counts(spread).filter(F.col("pos") + F.col("neg") >= LEAST_DOCS)
    best = counts.orderBy((gap * gap / (F.col("pos") + F.col("neg"))).desc(), "hash").limit(features).toArrow()
    hashes = best.column("hash").to_numpy().astype(np.int64)
    ratio = np.log((best.column("pos").to_numpy() + 1) / (pos + 2)) - np.log((best.column("neg").to_numpy() + 1) / (neg + 2))
    kept = np.zeros(1 << BITS, np.int16)
    kept[hashes] = np.arange(1, len(hashes) + 1)

    def work(batches):
        for batch in batches:
            found = [present(t.as_py(), kept).astype(np.int32) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["label", "found"])

    seen = spread.mapInArrow(work, "label int, found array<int>").toArrow()
    found = seen.column("found").to_pylist()
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    columns = np.array([c for f in found for c in f], np.int64)
    weights, intercept = logistic(rows, columns, ratio, seen.column("label").to_numpy().astype(float), len(hashes))
    return {"hashes": hashes, "weights": weights * ratio, "intercept": float(intercept)}


def score(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, by its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        m = shared.value
        kept = np.zeros(1 << BITS, np.int16)
        kept[m["hashes"]] = np.arange(1, len(m["hashes"]) + 1)
        for batch in batches:
            logits = np.array([m["weights"][present(t.as_py(), kept)].sum() for t in batch.column(2)], float) + m["intercept"]
            scores = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        work, f"doc_id {kind}, held_out boolean, score double, predicted int")
