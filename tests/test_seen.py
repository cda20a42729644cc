"""The durable set of seen keys, and ranks by sampled splitters."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_streams import staged

from beamwright import fixed
from beamwright.operators import frames, segments
from beamwright.session import scratch_dir, shared
from beamwright.streaming import seen


def keyed(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "key string, v long").repartition(3)


def test_filter_holds_all_its_keys_and_few_others(spark):
    mine, others = [f"/a/{i}" for i in range(3000)], [f"/b/{i}" for i in range(3000)]
    whole = seen.bloom(keyed(spark, mine), "key", 8)
    parts = seen.merged(*(seen.bloom(keyed(spark, mine[k::3]), "key", 8) for k in range(3)))
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, parts.select(whole.columns).collect()))
    assert seen.suspected(keyed(spark, mine), whole, "key", 8).filter("not _suspect").count() == 0
    assert seen.suspected(keyed(spark, others), whole, "key", 8).filter("_suspect").count() < 30
    assert seen.suspected(keyed(spark, others), whole.filter("false"), "key", 8).filter("_suspect").count() == 0


@pytest.mark.parametrize("depth", [1, 14])  # a filter that is full from the first batch on changes nothing
def test_batches_repeats_and_replays(spark, depth):
    folder, rng = scratch_dir(spark, "seen-test"), random.Random(4)
    batches = [[f"k{rng.randrange(400)}" for _ in range(n)] for n in (300, 1, 500)] + [[None, None, "k1"], [None, "fresh"], []]
    known, want = set(), []
    for names in batches:
        want.append(set(names) - known)
        known |= set(names)
    for number, names in enumerate(batches):
        for _ in range(2 if number in (0, 2, 4) else 1):  # a replay
            rows = seen.take_new(keyed(spark, names), folder, number, "key", depth).collect()
            assert len(rows) == len(want[number]) and {r.key for r in rows} == want[number]


def test_stream_goes_on_where_it_stopped(spark):
    where, got = scratch_dir(spark, "seen-run"), []
    arrivals = scratch_dir(spark, "seen-arrivals")
    write = lambda rows, folder: rows.write.mode("overwrite").parquet(folder.format(table="rows"))
    for names in (["a", "b", "a"], ["b", "c"], ["a", "c", "d"]):
        keyed(spark, names).coalesce(1).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema("key string, v long").parquet(arrivals)
        data = seen.run_once_per_key(stream, "t", "key", write, where=where)
        got.append({(r.key, r.batch) for r in spark.read.parquet(f"{data}/rows").select("key", "batch").collect()})
    assert got[-1] == {("a", 0), ("b", 0), ("c", 1), ("d", 2)}


def test_durable_intake_routes_once(spark):
    rows = lambda *names: [(f"/global/raw/{n}.h5", None, False, True) for n in names]
    files = staged(spark, [rows("a", "b"), rows("b", "c"), rows("a")], "file_path string, arrived_at timestamp, is_export_control boolean, send_offsite boolean")
    data = seen.durable_intake(files, {f: True for f in list(fixed.FLOW_PARAMETERS)[:2]})
    got = Counter(r.rel_path for r in spark.read.parquet(f"{data}/routes").select("rel_path", "flow").distinct().collect())
    assert len(got) == 3 and set(got.values()) == {2}
    assert spark.read.parquet(f"{data}/routes").groupBy("rel_path", "flow").count().filter("count > 1").count() == 0


def test_ranks_with_long_common_prefixes_and_a_hot_scan(spark):
    rng = random.Random(2)
    rows = [("hot", "x" * 200 + f"{rng.random()}") for _ in range(4000)] + [(f"s{i % 7}", f"p{i}") for i in range(70)] + [(None, "a"), (None, None), ("s1", None)]
    files = spark.createDataFrame(rows, "scan_id string, path string").repartition(5)
    want = []
    for scan in {s for s, _ in rows}:
        mine = sorted((p for s, p in rows if s == scan), key=lambda p: (p is not None, p or ""))
        want += [(scan, p, z) for z, p in enumerate(mine)]
    assert Counter(tuple(r) for r in frames.ordered_stack(files).collect()) == Counter(want)
    sizes = [r["count"] for r in segments.with_range_segment(files, ["scan_id"], ["path"]).groupBy("_range").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_scratch_folders_are_shared_or_refused():
    assert shared("local[8]", "/home/w") and shared("local", "file:/home/w") and shared("spark://host:7077", "hdfs://nn/w")
    assert not shared("spark://host:7077", "file:/home/w") and not shared("yarn", "/home/w") and not shared("local-cluster[3,2,1000]", "/home/w")
