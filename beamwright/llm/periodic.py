"""Periodic runs of words, found through a dictionary of basic factors, and texts with their repetitions taken out.

For each power-of-two length every place of a document gets the name of the factor (that many words) that begins there; names
of the next length are pairs of names, and a factor that occurs once in its document is left out from then on, as longer ones at its
place occur once too. Where the next occurrence of a factor of length L lies d words on, L <= d < 2L, and the one after it
another d, the three are in arithmetic progression and propose period d; two more names say whether the words between repeat
as well. What is left is extended word by word to both sides, once per run, and kept if it is long enough.

A run of at least three periods is proposed at the length L with L <= period < 2L, where some factor occurs once per period; as
it is the next occurrence that counts, no multiple of a smaller period is proposed.

Defined results: a null, empty or blank text has no words and no runs and collapses to the empty text. Words are told apart by their
bytes. A document is one row: repeated rows and null ids get results of their own; an empty table gives an empty table. Of the
input only the named column is read, the rest is kept under ``doc``, so names cannot clash. A task holds a few numbers per word of
a batch of documents; texts are worked through ``BYTES`` bytes at a time, but a longer text whole.
"""

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES = 1 << 21
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def proposals(names: np.ndarray, ends: np.ndarray, least: int):
    """Yields (places, periods) level by level: the words from a place on repeat with that period over two periods at least.

    ``names`` numbers the words of all documents, ``ends`` has the end of the document for each place. Periods of which ``least`` do not fit
    into a document are not looked for.
    """
    n, length = len(names), 1
    names = names.astype(np.int64)
    places = np.arange(n)
    longest = int((ends - places).max(initial=0))
    while length * least <= longest and len(places):
        order = places[np.argsort(names[places], kind="stable")]
        again = (names[order[1:]] == names[order[:-1]]) & (ends[order[1:]] == ends[order[:-1]])
        step = np.zeros(n, np.int64)
        step[order[:-1][again]] = (order[1:] - order[:-1])[again]
        first = np.flatnonzero((step >= length) & (step < 2 * length))
        period = step[first]
        chained = step[first + period] == period
        first, period = first[chained], period[chained]
        # the factor that ends where the first period ends, and the one a period later
        tail = first + period - length
        whole = (names[tail] == names[tail + period]) if len(tail) else np.zeros(0, bool)
        yield first[whole], period[whole]
        repeated = np.zeros(n, bool)
        repeated[order[1:][again]] = True
        repeated[order[:-1][again]] = True
        places = np.flatnonzero(repeated)
        places = places[places + 2 * length <= ends[places]]
        places = places[repeated[places + length]]
        pair = names[places] * (int(names.max(initial=0)) + 1) + names[places + length]
        _, new = np.unique(pair, return_inverse=True)
        names = -1 - np.arange(n)  # a factor that occurs once equals no other
        names[places] = new
        length *= 2


def _extent(words: np.ndarray, place: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The widest stretch around place in [low, high) whose words repeat with the period."""
    end, step = place + period, 32
    while end < high:
        part = words[end : min(end + step, high)]
        differ = np.flatnonzero(part != words[end - period : end - period + len(part)])
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + len(part), 2 * step
    start, step = place, 32
    while start > low:
        at = max(low, start - step)
        differ = np.flatnonzero(words[at:start] != words[at + period : start + period])
        if len(differ):
            start = at + int(differ[-1]) + 1
            break
        start, step = at, 2 * step
    return start, end


def runs_of(words: np.ndarray, ends: np.ndarray, least: int, shortest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` (3 or more) periods and ``shortest`` words, by start and period."""
    found = []
    for places, periods in proposals(words, ends, least):
        order = np.lexsort((places, periods))
        known = {}  # period: where the last stretch looked at with it ends
        for place, period in zip(places[order].tolist(), periods[order].tolist()):
            if place + period < known.get(period, 0):
                continue
            high = int(ends[place])
            low = int(np.searchsorted(ends, high, "left"))
            start, end = _extent(words, place, period, low, high)
            known[period] = end
            if end - start >= max(shortest, least * period):
                found.append((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def _batch(texts: list[bytes], least: int, shortest: int):
    """(runs, collapsed text) of each text."""
    split = [t.split() for t in texts]  # bytes split at ASCII white space only
    number = defaultdict(count().__next__)
    words = np.fromiter((number[w] for some in split for w in some), np.int64)
    sizes = np.array([len(s) for s in split])
    bounds = np.cumsum(sizes)
    runs = [[] for _ in split]
    for start, length, period in runs_of(words, np.repeat(bounds, sizes), least, shortest):
        k = int(np.searchsorted(bounds, start, "right"))
        runs[k].append((start - int(bounds[k] - sizes[k]), length, period))
    return [(r, collapse(s, r)) for r, s in zip(runs, split)]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 4, shortest: int = 6) -> DataFrame:
    """``docs`` under ``doc``, with ``runs`` (start, length, period; by start, then period) and the text without the
    repetitions, ``collapsed``. A run has at least ``least`` periods (3 or more) and ``shortest`` words, and cannot be extended."""
    if least < 3:
        raise ValueError("runs of fewer than three periods are not proposed")

    def work(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            run = np.cumsum([len(t) for t in texts]) // BYTES
            cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
            for start, stop in zip(cuts, cuts[1:]):
                runs, kept = zip(*_batch(texts[start:stop], least, shortest))
                listed = [[dict(zip(RUN.names, r)) for r in some] for some in runs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(listed, pa.list_(RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc", "runs", "collapsed"])

    source = docs.select(F.struct("*").alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    row = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(work, f"doc {row}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length/period, of equal ones the first; null if there is none."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def listing(runs: Column) -> Column:
    """A line `start,length,period` for each run."""
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in RUN.names))
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
