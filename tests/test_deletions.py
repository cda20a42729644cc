"""The deletion plan against literal cases."""

import datetime as dt

from pyspark.sql import functions as F

from beamwright.plans import deletions

NOW = dt.datetime(2024, 6, 1)
OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 5, 30)
FILES = "rel_path string, type string, size long, last_modified timestamp"
HELD = "endpoint_key string, rel_path string, last_modified timestamp"
ROOTS = "endpoint_key string, root_path string"


def plan(spark, files, held, roots=(("spot832", "/spot/"), ("data832", "/data"))):
    df = deletions.deletion_plan(
        spark.createDataFrame(files, FILES), spark.createDataFrame(held, HELD), spark.createDataFrame(list(roots), ROOTS), "move", F.lit(NOW), 14)
    return {(r.endpoint_key, r.rel_path): r for r in df.collect()}


def test_verdict_due_time_and_path(spark):
    files = [(n, "file", 5, OLD) for n in ("a", "b", "c", "d")] + [("new", "file", 1, NEW), ("dir", "dir", 0, OLD), (None, "file", 1, OLD)]
    held = [("spot832", n, OLD) for n in "abcd"] + [("data832", "a", OLD), ("data832", "b", NEW), ("data832", "d", None), ("nersc832", "a", OLD)]
    got = plan(spark, files, held)
    assert {k[1] for k in got} == set("abcd") and len(got) == 8
    assert {k: r.verdict for k, r in got.items() if k[0] == "spot832"} == {
        ("spot832", "a"): "PRUNE", ("spot832", "b"): "TOO_NEW", ("spot832", "c"): "NO_SECOND_COPY", ("spot832", "d"): "TOO_NEW"}
    assert {r.verdict for k, r in got.items() if k[0] == "data832"} == {"PRUNE", "NO_SECOND_COPY", "SOURCE_MISSING"}
    assert all((r.action == "PRUNE") == (r.verdict == "PRUNE") for r in got.values())
    a = got["spot832", "a"]
    assert (a.path, a.due_at, a.run_name, a.size) == ("/spot/a", OLD + dt.timedelta(days=2), "delete spot832: a", 5)
    assert got["data832", "a"].due_at == OLD + dt.timedelta(days=3)


def test_a_place_without_root_is_kept(spark):
    got = plan(spark, [("a", "file", 5, OLD)], [("spot832", "a", OLD), ("data832", "a", OLD)], [("data832", "/data")])
    row = got["spot832", "a"]
    assert (row.path, row.verdict, row.action) == (None, "PRUNE", "KEEP")


def test_empty(spark):
    assert plan(spark, [], []) == {}
