"""Streams in several micro-batches equal the batch result."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.operators import catalogue, jobs
from beamwright.session import scratch_dir
from beamwright.streaming import monitors, streams

T0 = dt.datetime(2024, 1, 1)


def staged(spark, batches, schema):
    """Each list of rows becomes one file, hence one micro-batch."""
    where = scratch_dir(spark, "staged")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(where)
    return streams.read_table(spark, where, files_per_trigger=1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


TASK = "task_id long, event_id long, ts timestamp, status string, nice_status string"


def test_task_monitor_emits_once_and_times_out(spark):
    batches = [
        [(1, 1, at(0), "ACTIVE", "OK"), (2, 2, at(0), "ACTIVE", "OK"), (3, 3, at(5), "ACTIVE", "OK")],
        [(1, 4, at(30), "SUCCEEDED", "OK"), (3, 5, at(40), "ACTIVE", "PERMISSION_DENIED")],
        [(1, 6, at(60), "FAILED", "OK"), (9, 7, at(2000), "ACTIVE", "OK")],
        [(9, 8, at(2010), "FAILED", "OK")],
    ]
    out = streams.run_to_table(monitors.task_monitor(staged(spark, batches, TASK)), "t", 2).collect()
    got = {r.task_id: (r.verdict, r.completed, r.succeeded) for r in out}
    assert got == {1: ("COMPLETED", True, True), 2: ("TIMEOUT", False, False), 3: ("CANCELLED", False, False), 9: ("COMPLETED", True, False)}
    assert len(out) == 4


def test_job_monitor_over_batches_equals_batch(spark):
    states = ["PENDING", "NOT_FOUND", "NOT_FOUND", "RUNNING"] + ["NOT_FOUND"] * 6 + ["COMPLETED"]
    rows = [(1, i, at(i), s) for i, s in enumerate(states)] + [(2, 100 + i, at(i), s) for i, s in enumerate(["RUNNING", "COMPLETED"])]
    rows += [(3, 200, at(0), "RUNNING"), (3, 201, at(1), "CANCELLED"), (4, 300, at(0), "RUNNING")]
    schema = "job_id long, event_id long, ts timestamp, state string"
    batches = [[r for r in rows if r[2] < at(5)], [r for r in rows if at(5) <= r[2] < at(8)], [r for r in rows if r[2] >= at(8)]]
    out = streams.run_to_table(monitors.job_monitor(staged(spark, batches, schema)), "j", 2)
    got = {r.job_id: r.outcome for r in out.filter("outcome is not null").collect()}
    want = {r.job_id: r.outcome for r in jobs.job_verdicts(spark.createDataFrame(rows, schema), seconds=3).collect()}
    assert got == {1: "LOST", 2: "SUCCESS", 3: "FAILURE"}
    assert want == got | {4: "RUNNING"}


def test_assembler_over_batches(spark):
    schema = "scan_id string, row int, idx int, values array<float>, ts timestamp, want int"
    a = [("a", 0, i, [float(i)], at(i), 4) for i in (3, 1)]
    b = [("a", 0, i, [float(i)], at(10 + i), 4) for i in (0, 2)] + [("b", 0, 0, [9.0], at(10), 2)]
    c = [("z", 0, 0, [1.0], at(100000), 1)]
    d = [("z", 1, 0, [1.0], at(100001), 1)]
    out = streams.run_to_table(monitors.scan_assembler(staged(spark, [a, b, c, d], schema)), "a", 2).collect()
    whole = sorted((r.idx, r["values"]) for r in out if r.scan_id == "a")
    assert whole == [(i, [float(i)]) for i in range(4)]
    assert [r.issue for r in out if r.scan_id == "b"] == ["1 of 2 projections"]


def test_intake_drops_repeats_across_batches(spark):
    schema = "file_path string, arrived_at timestamp, is_export_control boolean, send_offsite boolean"
    row = ("/global/raw/x/f.h5", at(0), False, True)
    again = ("/global/raw/x/f.h5", at(50), False, True)
    other = ("/global/raw/x/g.h5", at(60), True, True)
    files = staged(spark, [[row, row], [again, other]], schema)
    flows = streams.intake_stream(files, {f: True for f in fixed.FLOW_PARAMETERS})
    where = streams.run_batches(flows, "i", streams.write_intake, 2)
    routes = spark.read.parquet(f"{where}/routes")
    assert routes.count() == 6 and routes.filter("run_order = 0").count() == 2
    assert spark.read.parquet(f"{where}/schedule").count() == 4
    assert [r.rel_path for r in spark.read.parquet(f"{where}/offsite").collect()] == ["raw/x/f.h5"]


def test_late_metrics_are_dropped(spark):
    schema = "machine string, end_ts timestamp, task_id string, bytes_transferred long, duration_seconds double, transfer_speed double"
    # late rows are judged by the watermark one batch back, hence the extra batch
    batches = [[("m", at(10), "a", 5, 1.0, 1.0)], [("m", at(20000), "b", 7, 1.0, 1.0)], [("m", at(20010), "b2", 7, 1.0, 1.0)],
               [("m", at(20), "late", 100, 1.0, 1.0)], [("m", at(40000), "c", 1, 1.0, 1.0)]]
    out = streams.run_to_table(streams.metrics_stream(staged(spark, batches, schema)), "m", 2)
    first = out.orderBy("window_start").first()
    assert (first.requests, first.bytes) == (1, 5)


def test_deferred_rows_wait_for_event_time(spark):
    schema = "path string, location string, source string, check string, created_at timestamp, due_at timestamp"
    day = 86400
    batches = [[("p", "L", "A", "B", at(0), at(2 * day)), ("q", "L", "A", None, at(0), at(9 * day))],
               [("r", "L", "A", "B", at(3 * day), at(5 * day))], [("s", "L", "A", "B", at(3 * day + 60), at(5 * day))]]
    out = streams.run_to_table(monitors.deferred_prune(staged(spark, batches, schema)), "d", 2)
    assert [r.path for r in out.collect()] == ["p"]


class Held:
    """State and timers of one key in memory; counts the calls."""

    def __init__(self):
        self.maps, self.timers, self.calls = {}, set(), 0

    def getMapState(self, name, *_):
        held, outer = self.maps.setdefault(name, {}), self

        class State:
            def __getattr__(self, call):
                outer.calls += 1
                return {"containsKey": held.__contains__, "getValue": held.__getitem__, "removeKey": held.pop, "updateValue": held.__setitem__}[call]

        return State()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Clock:
    def __init__(self, at):
        self.at = at

    getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: self.at


@pytest.mark.parametrize("block", [7, 50_000])
def test_deferred_rows_leave_state_when_due_in_few_calls(monkeypatch, block):
    monkeypatch.setattr(monitors._DueProcessor, "BLOCK", block)
    rng, held, span = random.Random(5), Held(), 400_000
    keeper = monitors._DueProcessor(span)
    keeper.init(held)
    waiting, got, want, mark = [], [], [], -1
    n = 20 if block == 7 else 3000
    for batch in range(6):
        rows = [(rng.choice([rng.randrange(-span, span), 1234]), f"p{batch}_{i}" if i % 9 else None, "L", None if i % 2 else "A", None if i % 3 else "B") for i in range(n)]
        frame = pd.DataFrame([*rows, (None, "never", "L", "A", "B")], columns=["due_ms", "path", "location", "source", "check"])
        calls = held.calls
        list(keeper.handleInputRows(None, iter([frame[: n // 2], frame[n // 2 :]]), Clock(mark)))
        assert block == 7 or held.calls - calls < n / 2  # rows of one slot share a call
        mark, waiting = rng.randrange(mark, span) if batch < 5 else 2 * span, waiting + rows
        want.append(sorted((r for r in waiting if r[0] <= mark), key=repr))
        waiting, out = [r for r in waiting if r[0] > mark], []
        while due := sorted(t for t in held.timers if t <= mark):
            for t in due:
                held.timers.remove(t)
                for frame in keeper.handleExpiredTimer(None, Clock(mark), Clock(t)):
                    out += [tuple(None if pd.isna(x) else x for x in r) for r in frame.itertuples(index=False)]
        got.append(sorted(out, key=repr))
    assert got == want and not any(held.maps.values()) and not held.timers


def test_a_repeated_row_does_not_complete_a_sinogram(spark):
    schema = "scan_id string, row int, idx int, values array<float>, ts timestamp, want int"
    row = lambda i, s, v=1.0: ("s", 0, i, [float(i), v], at(s), 3)
    batches = [[row(0, 0), row(1, 1)], [row(1, 2, 9.0)], [row(2, 3)], [("t", 0, 0, [0.0], at(20_000), 2)], [("t", 0, 0, [0.0], at(20_001), 2)]]
    out = streams.run_to_table(monitors.scan_assembler(staged(spark, batches, schema)), "s", 2).collect()
    got = sorted((r.idx, list(r["values"])) for r in out if r.scan_id == "s")
    assert got == [(0, [0.0, 1.0]), (1, [1.0, 9.0]), (2, [2.0, 1.0])]


def test_a_batch_reads_its_metadata_once(spark, monkeypatch):
    """Records and issues of all files, from one pass over the metadata; a batch without offsite files takes none."""
    schema = "file_path string, arrived_at timestamp, is_export_control boolean, send_offsite boolean"
    pi, name = fixed.CATALOGUE_KEYS[3], fixed.CATALOGUE_KEYS[7]
    meta = spark.createDataFrame(
        [("a", pi, "Ann"), ("a", name, "one_two"), ("a", "else", "x"), ("b", pi, "Bo"), ("b", pi, "Al"), ("z", name, "z"), (None, name, "none")],
        "scan_id string, key string, str_value string").withColumns({
            "num_value": F.lit(None).cast("double"), "str_list": F.lit(None).cast("array<string>"), "num_list": F.lit(None).cast("array<double>")})
    passes, one = [], catalogue.described
    monkeypatch.setattr(catalogue, "described", lambda rows, *more: passes.append(rows) or one(rows, *more))
    batches = [[("/global/x/a.h5", at(0), False, True), ("/global/y/a.h5", at(1), False, True), ("/global/x/b.h5", at(2), False, True), ("/global/x/c.h5", at(3), False, True)],
               [("/global/x/d.h5", at(4), False, False)]]
    flows = streams.intake_stream(staged(spark, batches, schema), {fixed.NEW_FILE_FLOW: True})
    where = streams.run_batches(flows, "i", lambda batch, folder: streams.write_intake(batch, folder, meta), 2)
    got = sorted((r.scan_id, r.source_folder, r.owner, r.dataset_name) for r in spark.read.parquet(f"{where}/datasets").collect())
    assert [(r[0], *r[2:]) for r in got] == [("a", "Ann", "one_two")] * 2 + [("b", "Bo", None), ("c", "Unknown", None)]
    issues = [(r.scan_id, r.severity, r.msg, r.exception) for r in spark.read.parquet(f"{where}/issues").collect()]
    keys, has = [*fixed.CATALOGUE_KEYS, *fixed.SCIENTIFIC_KEYS], {"a": {pi, name}, "b": {pi}, "c": set()}
    want = [(s, "warning", f"dataset not found {k}", None) for s in "aabc" for k in keys if k not in has[s]]
    want += [(s, "error", "no file name", None) for s in "bc"]
    assert sorted(map(str, issues)) == sorted(map(str, want))
    assert len(passes) >= 2 and passes[0].count() == 5 and not any(p.count() for p in passes[1:])


def test_late_new_files_are_taken_in(spark):
    schema = "file_path string, arrived_at timestamp, is_export_control boolean, send_offsite boolean"
    batches = [[("/g/x/a.h5", at(1_000_000), False, True)], [("/g/x/b.h5", at(2_000_000), False, True)], [("/g/x/late.h5", at(0), False, True)], [("/g/x/a.h5", at(5), False, True)]]
    flows = {f: True for f in (fixed.NEW_FILE_FLOW,)}
    out = streams.run_to_table(streams.intake_stream(staged(spark, batches, schema), flows), "i", 2).collect()
    assert sorted({r.file_path for r in out}) == ["/g/x/a.h5", "/g/x/b.h5", "/g/x/late.h5"]
    assert len({(r.file_path, r.flow) for r in out}) == len(out)
