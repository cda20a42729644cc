"""Directory expansion by nested intervals against the one by ancestors and a plain loop."""

import random

from beamwright.operators import intervals, inventory


def rows_of(df):
    return sorted((r.dir_path, r.rel_path, r.dest, r.dest_path) for r in df.collect())


def test_same_as_by_ancestors(spark):
    """Depth 30, nested and repeated requests, folders whose names sort around the slash, doubled and leading slashes, nulls."""
    rng = random.Random(4)
    names = ["a", "a-", "a.", "a0", "ab", "a b", "é", "日"]
    paths = ["/".join(rng.choice(names) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    paths += ["a/b", "a//b", "/a/b", "x/y/", "top", "a", "a0/b", "a-/b", paths[0], None]
    dirs = {p.rsplit("/", k)[0] for p in paths if p for k in (1, 2, 9, 29)} | {"a", "a/", "", "none", "a/a"}
    wanted = [(d, "/dest/") for d in sorted(dirs)] + [("a", "/other/"), ("a", "/dest/"), (None, "/dest/")]
    files = spark.createDataFrame([(p, 1) for p in paths], "rel_path string, dir_path int").repartition(5)
    requests = spark.createDataFrame(wanted, "dir_path string, dest string").repartition(3)
    got = rows_of(intervals.expand_directories(requests, files))
    assert got == rows_of(inventory.expand_directories(requests, files))
    plain = sorted((d, p, dest) for d, dest in wanted for p in paths if d is not None and p is not None and p.startswith(d + "/"))
    assert [r[:3] for r in got] == plain


def test_blocks(spark):
    """A request over more folders than a block holds."""
    files = spark.range(5000).selectExpr("concat('all/f', id, '/x') as rel_path")
    requests = spark.createDataFrame([("all", "/d/"), ("all/f17", "/d/")], "dir_path string, dest string")
    out = intervals.expand_directories(requests, files)
    assert {r.dir_path: r["count"] for r in out.groupBy("dir_path").count().collect()} == {"all": 5000, "all/f17": 1}


def test_empty(spark):
    files = spark.createDataFrame([("a/b",)], "rel_path string")
    requests = spark.createDataFrame([("a", "/d/")], "dir_path string, dest string")
    assert intervals.expand_directories(requests.limit(0), files).count() == 0
    assert intervals.expand_directories(requests, files.limit(0)).count() == 0
