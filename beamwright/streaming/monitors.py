"""Stateful processors: one decision per task, job, deletion or sinogram."""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from beamwright import fixed
from beamwright.operators import transfers


def _ms(ts) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


class _TaskProcessor(StatefulProcessor):
    """Keeps two numbers per task: first poll and earliest deciding poll.

    A verdict stays for one more span of waiting, so that later polls of the
    task stay silent, and then leaves the state.
    """

    def __init__(self, max_wait_us: int):
        self.max_wait = max_wait_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("task", "first bigint, at bigint, event bigint, verdict string, done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, at, event, verdict, done = self.state.get() if self.state.exists() else (None, None, None, None, False)
        if done:
            return
        known = first
        for chunk in rows:
            low = int(chunk["us"].min())
            first = low if first is None else min(first, low)
            calls = chunk[chunk["verdict"].notna()]
            if len(calls):
                best = calls.sort_values(["us", "event_id"]).iloc[0]
                if at is None or (int(best["us"]), int(best["event_id"])) < (at, event):
                    at, event, verdict = int(best["us"]), int(best["event_id"]), str(best["verdict"])
            # a poll after the limit proves that the limit passed without a decision
            late = int(chunk["us"].max())
            if late > first + self.max_wait and (at is None or at > first + self.max_wait):
                at, event, verdict = first + self.max_wait, -1, "TIMEOUT"
        if at is not None and at > first + self.max_wait:
            at, verdict = first + self.max_wait, "TIMEOUT"
        decided = at is not None
        self.state.update((first, at, event, verdict, decided))
        if known is None:
            self.handle.registerTimer((first + self.max_wait) // 1000 + 1)
        if decided:
            self.handle.registerTimer((first + 2 * self.max_wait) // 1000 + 2)
            yield self._row(key, verdict, (at - first) / 1e6)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        first, at, event, verdict, done = self.state.get()
        if not done:
            self.state.update((first, first + self.max_wait, -1, "TIMEOUT", True))
            self.handle.registerTimer((first + 2 * self.max_wait) // 1000 + 2)
            yield self._row(key, "TIMEOUT", self.max_wait / 1e6)
        elif expiredTimerInfo.getExpiryTimeInMs() > (first + 2 * self.max_wait) // 1000:
            self.state.clear()

    @staticmethod
    def _row(key, verdict, elapsed):
        return pd.DataFrame({
            "task_id": [key[0]], "verdict": [verdict.split(":")[0]], "completed": [verdict.startswith("COMPLETED")],
            "succeeded": [verdict == "COMPLETED:SUCCEEDED"], "elapsed": [float(elapsed)]})

    def close(self) -> None:
        pass


def task_monitor(events: DataFrame, max_wait: float = 600, delay: str = "1 minute") -> DataFrame:
    """One verdict per task, at its first decisive poll or when the wait is over."""
    call = transfers.event_verdict(F.lit(0.0), max_wait)
    named = F.when(call == "COMPLETED", F.concat(call, F.lit(":"), "status")).otherwise(call)
    judged = events.withWatermark("ts", delay).select(
        "task_id", "event_id", "ts", F.unix_micros("ts").alias("us"), named.alias("verdict"))
    return judged.groupBy("task_id").transformWithStateInPandas(
        _TaskProcessor(int(max_wait * 1_000_000)),
        "task_id bigint, verdict string, completed boolean, succeeded boolean, elapsed double", "Append", "EventTime")


class _JobProcessor(StatefulProcessor):
    """Keeps the run of misses and the last state per job."""

    def __init__(self, max_retries: int, terminal: list):
        self.max_retries, self.terminal = max_retries, set(terminal)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("job", "misses int, last string, done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        misses, last, done = self.state.get() if self.state.exists() else (0, None, False)
        batch = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        found = []
        if not done:
            for ts, state in zip(batch["ts"], batch["state"]):
                misses = misses + 1 if state == "NOT_FOUND" else 0
                call = ("SUCCESS" if state == "COMPLETED" else "FAILURE" if state in self.terminal
                        else "LOST" if misses > self.max_retries else None)
                if state != last:
                    found.append((key[0], ts, last, state, call))
                elif call:
                    found.append((key[0], ts, last, state, call))
                last = state
                if call:
                    done = True
                    break
        self.state.update((misses, last, done))
        if found:
            yield pd.DataFrame(found, columns=["job_id", "ts", "previous", "state", "outcome"])

    def close(self) -> None:
        pass


def job_monitor(events: DataFrame, max_retries: int = 5, terminal: list = fixed.TERMINAL_JOB_STATES) -> DataFrame:
    """State changes of each job up to its outcome; rows with an outcome end the job.

    A job's polls of one micro-batch are sorted in one task, so the batch size
    (files or bytes per trigger) bounds the work per job.
    """
    rows = events.select("job_id", "event_id", "ts", "state")
    return rows.groupBy("job_id").transformWithStateInPandas(
        _JobProcessor(max_retries, terminal),
        "job_id bigint, ts timestamp, previous string, state string, outcome string", "Append", "None")


class _DueProcessor(StatefulProcessor):
    """Holds back rows until event time passes their due time.

    Rows lie in state as Arrow blocks, by slots of due time: a slot of one level is as wide as ``FAN`` of the level below, those of
    level 0 a millisecond. A slot has a timer at its first due time. When that fires, all that is due leaves the slot's
    blocks at once and the rest goes down a level, so a row is written again once per level at most, and a call
    to the state serves many rows.
    """

    FAN, BLOCK = 64, 50_000
    ROWS = pa.schema([("due_ms", pa.int64())] + [(c, pa.string()) for c in ("path", "location", "source", "check")])

    def __init__(self, span_ms: int):
        self.top = 0
        while self.FAN ** (self.top + 1) < span_ms:
            self.top += 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "level int, slot bigint", "blocks int, first bigint")
        self.blocks = handle.getMapState("blocks", "level int, slot bigint, block int", "rows binary")

    def _keep(self, tables: Iterable[pa.Table], level: int) -> None:
        """Rows into slots of a level, up to ``BLOCK`` rows at a time and whatever is left at the end."""
        held: list[pa.Table] = []
        for table in tables:
            held.append(table)
            if sum(map(len, held)) >= self.BLOCK:
                self._put(pa.concat_tables(held), level)
                held = []
        if held:
            self._put(pa.concat_tables(held), level)

    def _put(self, table: pa.Table, level: int) -> None:
        table = table.sort_by("due_ms").combine_chunks()
        due = table.column("due_ms").to_numpy()
        slot = due // self.FAN**level
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(due)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            at, first = (level, int(slot[low])), int(due[low])
            n, known = self.slots.getValue(at) if self.slots.containsKey(at) else (0, None)
            for batch in table.slice(low, high - low).to_batches(max_chunksize=self.BLOCK):
                self.blocks.updateValue((*at, n), (batch.serialize().to_pybytes(),))
                n += 1
            if known is None or first < known:
                self.handle.registerTimer(first)
                known = first
            self.slots.updateValue(at, (n, known))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chunks = (c[c["due_ms"].notna()] for c in rows)
        self._keep((pa.Table.from_pandas(c[self.ROWS.names], self.ROWS, preserve_index=False) for c in chunks), self.top)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at_ms = int(expiredTimerInfo.getExpiryTimeInMs())
        now = max(at_ms, int(timerValues.getCurrentWatermarkInMs()))
        for level in range(self.top + 1):
            at = (level, at_ms // self.FAN**level)
            if not self.slots.containsKey(at):
                continue
            later: list[pa.Table] = []
            for block in range(self.slots.getValue(at)[0]):
                raw = self.blocks.getValue((*at, block))[0]
                self.blocks.removeKey((*at, block))
                table = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(raw), self.ROWS)])
                # blocks are sorted by due time
                n = int(np.searchsorted(table.column("due_ms").to_numpy(), now, side="right"))
                if n:
                    yield table.slice(0, n).to_pandas()
                if n < len(table):
                    later.append(table.slice(n))
                if sum(map(len, later)) >= self.BLOCK:
                    self._keep(later, level - 1)
                    later = []
            self.slots.removeKey(at)
            self._keep(later, level - 1)

    def close(self) -> None:
        pass


def deferred_prune(schedule: DataFrame, delay: str = "1 hour", bucket_seconds: int = 3600, spread: int = 16) -> DataFrame:
    """Schedule rows, each emitted once event time has passed its ``due_at``.

    Rows wait in state keyed by a span of due times and a hash of the path, so
    neither a busy hour nor a busy location ends up under one key.
    """
    due_ms = F.unix_millis("due_at")
    rows = schedule.withWatermark("created_at", delay).select(
        F.floor(due_ms / (bucket_seconds * 1000)).alias("bucket"), F.pmod(F.xxhash64("path"), F.lit(spread)).alias("part"),
        "created_at", due_ms.alias("due_ms"), "path", "location", "source", "check")
    return rows.groupBy("bucket", "part").transformWithStateInPandas(
        _DueProcessor(bucket_seconds * 1000), "due_ms bigint, path string, location string, source string, check string", "Append", "EventTime")


class _SinogramProcessor(StatefulProcessor):
    """Keeps detector rows by angle until all angles of a sinogram are there; a row that comes again replaces the first."""

    def __init__(self, wait_ms: int):
        self.wait = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "idx int", "vals binary")
        self.seen = handle.getValueState("seen", "n int, want int, done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, want, done = self.seen.get() if self.seen.exists() else (0, 0, False)
        fresh, last = n == 0, 0
        for chunk in rows:
            if done:
                continue
            for idx, values in zip(chunk["idx"], chunk["values"]):
                at = (int(idx),)
                n += not self.rows.containsKey(at)
                self.rows.updateValue(at, (np.asarray(values, "f4").tobytes(),))
            want, last = int(chunk["want"].iloc[0]), max(last, _ms(chunk["ts"].max()))
        if not done and n >= want:
            held = sorted(((int(k[0]), np.frombuffer(bytes(v[0]), "f4")) for k, v in self.rows.iterator()), key=lambda r: r[0])
            self.rows.clear()
            done = True
            yield self._frame(key, held, None)
        if fresh and last:
            # the same timer ends the wait of an incomplete sinogram and the memory of a complete one
            self.handle.registerTimer(last + self.wait)
        self.seen.update((n, want, done))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.seen.exists():
            return
        n, want, done = self.seen.get()
        self.rows.clear()
        self.seen.clear()
        if not done:
            yield self._frame(key, [(-1, [])], f"{n} of {want} projections")

    @staticmethod
    def _frame(key, held, issue):
        return pd.DataFrame({
            "scan_id": [key[0]] * len(held), "row": [key[1]] * len(held), "idx": [r[0] for r in held],
            "values": [np.asarray(r[1], "f8") for r in held], "issue": [issue] * len(held)})

    def close(self) -> None:
        pass


def scan_assembler(rows: DataFrame, wait: float = 3600, delay: str = "1 minute") -> DataFrame:
    """Complete sinograms from detector rows that arrive in any order.

    ``rows(scan_id, row, idx, values, ts, want)`` with ``want`` angles per
    sinogram, complete when that many different angles are there.  State is one
    detector row's projections; it ends with the sinogram, and the mark that it
    came after ``wait`` seconds, when incomplete ones leave an issue row.
    """
    marked = rows.withWatermark("ts", delay).select("scan_id", "row", "idx", "values", "ts", "want")
    return marked.groupBy("scan_id", "row").transformWithStateInPandas(
        _SinogramProcessor(int(wait * 1000)),
        "scan_id string, row int, idx int, values array<double>, issue string", "Append", "EventTime")
