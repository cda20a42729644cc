"""Bricks and boxes against a plain array."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from beamwright.session import scratch_dir
from beamwright.sources import bricks

LEVELS = "scan_id string, level int, z int, y int, values array<double>, cube string"
BOXES = "box_id string, scan_id string, level int, z0 int, z1 int, y0 int, y1 int, x0 int, x1 int"


def stored(spark, volumes, edge, **kw):
    rows = [(s, lv, z, y, v[z, y].tolist(), "clash") for (s, lv), v in volumes.items() for z in range(v.shape[0]) for y in range(v.shape[1])]
    where = scratch_dir(spark, "bricks-test")
    df = spark.createDataFrame(rows, LEVELS).repartition(4)
    bricks.write_bricks(df, where, edge, **kw)
    return where


def lines(df):
    out = {}
    for r in df.collect():
        for i, v in enumerate(r["values"]):
            key = (r.box_id, r.z, r.y, r.x0 + i)
            assert key not in out
            out[key] = v
    return out


@pytest.mark.parametrize("edge", [1, 4, 7, 100])
def test_boxes_are_cut_from_the_volume(spark, edge):
    rng = np.random.default_rng(edge)
    volumes = {("s", 0): rng.normal(size=(9, 11, 13)), ("s", 1): rng.normal(size=(5, 6, 7)), ("t", 0): rng.normal(size=(3, 4, 20))}
    where = stored(spark, volumes, edge)
    asked = [("a", "s", 0, 2, 7, 3, 9, 1, 12), ("b", "s", 0, 0, 99, 0, 99, 0, 99), ("c", "s", 1, -3, 2, 0, 6, 4, 5), ("d", "t", 0, 1, 2, 0, 1, 19, 40),
             ("empty", "s", 0, 3, 3, 0, 9, 0, 9), ("far", "s", 0, 50, 60, 0, 9, 0, 9), ("none", "u", 0, 0, 9, 0, 9, 0, 9), ("null", "s", 0, None, 9, 0, 9, 0, 9)]
    got = lines(bricks.read_boxes(spark, where, spark.createDataFrame(asked, BOXES)))
    want = {}
    for name, scan, level, z0, z1, y0, y1, x0, x1 in asked:
        v = volumes.get((scan, level))
        if v is not None and z0 is not None:
            for z, y, x in np.ndindex(v.shape):
                if z0 <= z < z1 and y0 <= y < y1 and x0 <= x < x1:
                    want[name, z, y, x] = v[z, y, x]
    assert got == want


def test_a_box_opens_only_files_with_its_bricks(spark):
    where = stored(spark, {("s", 0): np.zeros((32, 32, 32))}, 2)
    box = spark.createDataFrame([("a", "s", 0, 0, 3, 0, 3, 0, 3)], BOXES)
    held = spark.read.parquet(f"{where}/bricks")
    assert len(held.inputFiles()) > 1
    read = bricks.read_boxes(spark, where, box)
    assert len(bricks.files_of(spark, where, box)) == 1 and len(read.inputFiles()) == 1
    # one cube is one stretch of the curve in one file
    by_cube = spark.read.parquet(f"{where}/manifest").groupBy("cube").count()
    assert {r["count"] for r in by_cube.collect()} == {1}


def test_morton_order(spark):
    df = spark.range(64).selectExpr("id div 16 as z", "id div 4 % 4 as y", "id % 4 as x")
    got = df.select("z", "y", "x", bricks.morton(df.z, df.y, df.x).alias("m")).collect()
    want = {(r.z, r.y, r.x): sum(((r.x >> k) & 1) << 3 * k | ((r.y >> k) & 1) << 3 * k + 1 | ((r.z >> k) & 1) << 3 * k + 2 for k in range(2)) for r in got}
    assert all(r.m == want[r.z, r.y, r.x] for r in got) and sorted(r.m for r in got) == list(range(64))
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(bricks.morton(F.lit(2**20), F.lit(0), F.lit(0))).collect()


def test_rows_are_shuffled_once(spark):
    df = spark.createDataFrame([("s", 0, 0, 0, [1.0], "c")], LEVELS)
    plan = bricks.to_bricks(df, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_empty_and_odd_rows(spark):
    where = scratch_dir(spark, "bricks-test")
    odd = [("s", 0, None, 0, [1.0], "c"), ("s", 0, 0, None, [1.0], "c"), ("s", 0, 0, 0, [], "c"), ("s", 0, 0, 0, None, "c")]
    bricks.write_bricks(spark.createDataFrame(odd, LEVELS), where, 4)
    box = spark.createDataFrame([("a", "s", 0, 0, 3, 0, 3, 0, 3)], BOXES)
    out = bricks.read_boxes(spark, where, box)
    assert out.columns == ["box_id", "scan_id", "level", "z", "y", "x0", "values"] and out.count() == 0
    with pytest.raises(ValueError):
        bricks.to_bricks(spark.createDataFrame(odd, LEVELS), 0)
